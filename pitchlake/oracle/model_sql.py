"""DuckDB twins of the silver/gold models (registered as extra CTEs)."""

from __future__ import annotations

from pitchlake.oracle.bindings_sql import _cte, sround

# ----------------------------------------------------------------------------
# Scout codes and their column names, as in functions/expressions.py.
_SCOUT_COLS = (
    ("G", "scout_gol"), ("A", "scout_assistencia"), ("FT", "scout_finalizacao_trave"),
    ("FD", "scout_finalizacao_defendida"), ("FF", "scout_finalizacao_fora"),
    ("FS", "scout_falta_sofrida"), ("DS", "scout_desarme"), ("I", "scout_impedimento"),
    ("SG", "scout_saldo_gol"), ("DE", "scout_defesa"), ("DP", "scout_defesa_penalti"),
    ("GC", "scout_gol_contra"), ("CA", "scout_cartao_amarelo"), ("CV", "scout_cartao_vermelho"),
    ("FC", "scout_falta_cometida"), ("PS", "scout_passe_decisivo"), ("PC", "scout_passe_completo"),
    ("PP", "scout_pre_assistencia"), ("V", "scout_vitoria"), ("GS", "scout_gol_sofrido"),
)
# ----------------------------------------------------------------------------


def scouts_sql(col: str = "scout_json") -> str:
    return ",\n       ".join(
        f"coalesce(TRY_CAST(TRY_CAST(json_extract_string({col}, '$.{code}') AS DOUBLE) AS INTEGER), 0) AS {name}"
        for code, name in _SCOUT_COLS)


def result_sql(a: str, b: str) -> str:
    return (f"CASE WHEN {a} > {b} THEN 'V' WHEN {a} = {b} THEN 'E' "
            f"WHEN {a} < {b} THEN 'D' END")


def _fct_partidas(src: str) -> str:
    h, a = "placar_oficial_mandante", "placar_oficial_visitante"
    return f"""
SELECT partida_id, rodada_id, clube_casa_id, clube_visitante_id,
       {h} AS placar_mandante, {a} AS placar_visitante,
       {result_sql(h, a)} AS resultado_mandante,
       {result_sql(a, h)} AS resultado_visitante,
       coalesce({h}, 0) + coalesce({a}, 0) AS total_gols,
       partida_data AS partida_datetime, estadio, valida
FROM {src}"""


_cte("fct_partidas", _fct_partidas("pm"), "pm")
_cte("fct_partidas_prox", _fct_partidas("pm_null"), "pm_null")

_cte("fct_pre", """
SELECT m.atleta_id, m._rodada_captura AS rodada_id, m.clube_id, m.posicao_id, m.status_id,
       coalesce(p.pontuacao, CAST(m.pontos_num AS DOUBLE)) AS pontos_num,
       m.media_num, m.preco_num, m.variacao_num, m.jogos_num, m.entrou_em_campo,
       coalesce(p.scout_json, m.scout_json) AS scout_json, m._ingestao_timestamp
FROM market m LEFT JOIN scored p ON m.atleta_id = p.atleta_id AND m._rodada_captura = p.rodada_id""",
     "market", "scored")

_cte("fct", f"""
SELECT * EXCLUDE (scout_json), {scouts_sql()}
FROM fct_pre""", "fct_pre")

_cte("played", "SELECT * FROM fct WHERE entrou_em_campo", "fct")

_cte("status_seed", """
SELECT * FROM (VALUES (2, 'Dúvida', false), (3, 'Suspenso', false), (5, 'Contundido', false),
                      (6, 'Nulo', true), (7, 'Provável', true)) t(status_id, descricao, disponivel)""")

_cte("positions_seed", """
SELECT * FROM (VALUES (1, 'Goleiro', 'GOL'), (2, 'Lateral', 'LAT'), (3, 'Zagueiro', 'ZAG'),
                      (4, 'Meia', 'MEI'), (5, 'Atacante', 'ATA'), (6, 'Técnico', 'TEC'))
       t(posicao_id, nome, abreviacao)""")

_cte("dim_atletas", """
SELECT a.atleta_id, a.nome, a.apelido, a.posicao_id, a.clube_id, a.status_id,
       coalesce(s.descricao, 'Desconhecido') AS status_descricao,
       a._ingestao_timestamp AS _updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY atleta_id
                                   ORDER BY _ingestao_timestamp DESC, _rodada_captura DESC) AS rn
      FROM market) a
LEFT JOIN status_seed s ON a.status_id = s.status_id
WHERE a.rn = 1""", "market", "status_seed")

_cte("persp", """
SELECT partida_id, rodada_id, partida_datetime, clube_casa_id AS clube_id,
       clube_visitante_id AS adversario_id, placar_mandante AS gols_pro,
       placar_visitante AS gols_contra, resultado_mandante AS resultado, 'casa' AS mando_campo
FROM fct_partidas WHERE placar_mandante IS NOT NULL AND placar_visitante IS NOT NULL
UNION ALL
SELECT partida_id, rodada_id, partida_datetime, clube_visitante_id, clube_casa_id,
       placar_visitante, placar_mandante, resultado_visitante, 'fora'
FROM fct_partidas WHERE placar_mandante IS NOT NULL AND placar_visitante IS NOT NULL""",
     "fct_partidas")

_cte("round_totals", """
SELECT clube_id, rodada_id,
       CAST(sum(CASE resultado WHEN 'V' THEN 3 WHEN 'E' THEN 1 ELSE 0 END) AS BIGINT) AS pontos,
       count(*) AS jogos,
       CAST(sum(CASE WHEN resultado = 'V' THEN 1 ELSE 0 END) AS BIGINT) AS vitorias,
       CAST(sum(CASE WHEN resultado = 'E' THEN 1 ELSE 0 END) AS BIGINT) AS empates,
       CAST(sum(CASE WHEN resultado = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS derrotas,
       CAST(sum(gols_pro) AS BIGINT) AS gols_pro,
       CAST(sum(gols_contra) AS BIGINT) AS gols_contra
FROM persp GROUP BY clube_id, rodada_id""", "persp")


def finish_sql(src: str) -> str:
    return f"""
SELECT clube_id, rodada_id,
       CAST(rank() OVER (PARTITION BY rodada_id
                         ORDER BY pontos DESC, gols_pro - gols_contra DESC, gols_pro DESC) AS INTEGER) AS posicao,
       pontos, jogos, vitorias, empates, derrotas, gols_pro, gols_contra,
       gols_pro - gols_contra AS saldo_gols,
       CASE WHEN jogos > 0 THEN {sround("CAST(pontos AS DOUBLE) / (jogos * 3) * 100", 1)} END
           AS aproveitamento_percentual
FROM {src}"""


_cte("tabela", finish_sql("round_totals"), "round_totals")

_cte("grid", """
SELECT c.clube_id, CAST(unnest(generate_series(b.lo, b.hi)) AS INTEGER) AS rodada_id
FROM (SELECT DISTINCT clube_id FROM persp) c,
     (SELECT min(rodada_id) AS lo, max(rodada_id) AS hi FROM persp) b""", "persp")

_cte("cum_totals", """
SELECT g.clube_id, g.rodada_id,
       CAST(coalesce(sum(r.pontos) OVER w, 0) AS BIGINT) AS pontos,
       CAST(coalesce(sum(r.jogos) OVER w, 0) AS BIGINT) AS jogos,
       CAST(coalesce(sum(r.vitorias) OVER w, 0) AS BIGINT) AS vitorias,
       CAST(coalesce(sum(r.empates) OVER w, 0) AS BIGINT) AS empates,
       CAST(coalesce(sum(r.derrotas) OVER w, 0) AS BIGINT) AS derrotas,
       CAST(coalesce(sum(r.gols_pro) OVER w, 0) AS BIGINT) AS gols_pro,
       CAST(coalesce(sum(r.gols_contra) OVER w, 0) AS BIGINT) AS gols_contra
FROM grid g LEFT JOIN round_totals r ON g.clube_id = r.clube_id AND g.rodada_id = r.rodada_id
WINDOW w AS (PARTITION BY g.clube_id ORDER BY g.rodada_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "grid", "round_totals")

_cte("tabela_cum", finish_sql("cum_totals"), "cum_totals")

_cte("recent", """
SELECT atleta_id,
       round(sum(CASE WHEN rn <= 5 THEN pontos_num END), 2) / count(CASE WHEN rn <= 5 THEN pontos_num END)
           AS media_ultimas_5,
       max(CASE WHEN rn <= 5 THEN preco_num END) AS preco_atual,
       round(sum(CASE WHEN rn <= 3 THEN pontos_num END), 2) / count(CASE WHEN rn <= 3 THEN pontos_num END)
           AS media_ultimas_3
FROM (SELECT atleta_id, pontos_num, preco_num,
             row_number() OVER (PARTITION BY atleta_id ORDER BY rodada_id DESC) AS rn
      FROM played)
GROUP BY atleta_id""", "played")

_cte("totals", """
SELECT atleta_id, clube_id, posicao_id,
       count(*) AS total_jogos,
       round(sum(pontos_num), 2) AS total_pontos,
       round(sum(pontos_num), 2) / count(pontos_num) AS media_pontos,
       stddev_samp(pontos_num) AS desvio_padrao_pontos,
       max(pontos_num) AS max_pontos,
       min(pontos_num) AS min_pontos,
       quantile_cont(pontos_num, 0.5) AS mediana_pontos,
       CAST(sum(scout_gol) AS BIGINT) AS total_gols,
       CAST(sum(scout_assistencia) AS BIGINT) AS total_assistencias,
       CAST(sum(scout_desarme) AS BIGINT) AS total_desarmes,
       CAST(sum(scout_cartao_amarelo) AS BIGINT) AS total_cartoes_amarelos,
       CAST(sum(scout_cartao_vermelho) AS BIGINT) AS total_cartoes_vermelhos,
       CAST(sum(scout_saldo_gol) AS BIGINT) AS total_saldo_gol,
       CAST(sum(scout_defesa) AS BIGINT) AS total_defesas,
       CAST(sum(scout_finalizacao_trave) AS BIGINT) AS total_finalizacoes_trave,
       avg(CAST(entrou_em_campo AS INTEGER)) AS aproveitamento_campo,
       round(sum(variacao_num), 2) AS variacao_preco_acumulada
FROM played GROUP BY atleta_id, clube_id, posicao_id""", "played")

PER_GAME_SQL = """
       CASE WHEN total_jogos > 0 THEN total_gols / total_jogos ELSE 0 END AS gols_por_jogo,
       CASE WHEN total_jogos > 0 THEN total_assistencias / total_jogos ELSE 0 END AS assistencias_por_jogo,
       CASE WHEN total_jogos > 0 THEN (total_gols + total_assistencias) / total_jogos ELSE 0 END
           AS participacao_gols_por_jogo,
       CASE WHEN total_jogos > 0 THEN (total_cartoes_amarelos + total_cartoes_vermelhos) / total_jogos ELSE 0 END
           AS cartoes_por_jogo"""

CONSISTENCY_SQL = ("CASE WHEN media_pontos > 0 THEN 1 - coalesce(desvio_padrao_pontos, 0) / media_pontos "
                   "ELSE 0 END")

_cte("metricas_atleta", f"""
SELECT a.atleta_id, d.apelido, a.clube_id, a.posicao_id, 2024 AS temporada,
       a.total_jogos, a.total_pontos, a.media_pontos, a.desvio_padrao_pontos,
       a.max_pontos, a.min_pontos, a.mediana_pontos,
       a.total_gols, a.total_assistencias, a.total_desarmes,
       a.total_cartoes_amarelos, a.total_cartoes_vermelhos, a.total_saldo_gol,
       a.total_defesas, a.total_finalizacoes_trave,
       {PER_GAME_SQL},
       a.aproveitamento_campo,
       coalesce(m.preco_atual, 0) AS preco_atual,
       a.variacao_preco_acumulada,
       CASE WHEN a.media_pontos > 0 THEN coalesce(m.preco_atual, 0) / a.media_pontos END AS preco_por_ponto,
       coalesce(m.media_ultimas_5, a.media_pontos) AS media_ultimas_5,
       CASE WHEN coalesce(m.media_ultimas_5, a.media_pontos) > coalesce(m.media_ultimas_3, a.media_pontos) * 1.1
            THEN 'subindo'
            WHEN coalesce(m.media_ultimas_5, a.media_pontos) < coalesce(m.media_ultimas_3, a.media_pontos) * 0.9
            THEN 'caindo'
            ELSE 'estavel' END AS tendencia_pontos,
       CASE WHEN a.media_pontos > 0 THEN 1 - coalesce(a.desvio_padrao_pontos, 0) / a.media_pontos
            ELSE 0 END AS consistencia_score
FROM totals a
JOIN dim_atletas d ON a.atleta_id = d.atleta_id
LEFT JOIN recent m ON a.atleta_id = m.atleta_id""", "totals", "dim_atletas", "recent")

_cte("club_scores", """
SELECT clube_id, rodada_id, round(sum(pontos_num), 2) AS total_pontos_fantasy,
       round(sum(pontos_num), 2) / count(pontos_num) AS media_pontos_fantasy,
       count(DISTINCT atleta_id) AS atletas_pontuaram
FROM played GROUP BY clube_id, rodada_id""", "played")

_cte("club_results", f"""
SELECT clube_id, rodada_id, CAST(sum(gm) AS BIGINT) AS gols_marcados,
       CAST(sum(gs) AS BIGINT) AS gols_sofridos, {result_sql('sum(gm)', 'sum(gs)')} AS resultado
FROM (SELECT clube_casa_id AS clube_id, rodada_id, placar_mandante AS gm, placar_visitante AS gs
      FROM fct_partidas WHERE placar_mandante IS NOT NULL
      UNION ALL
      SELECT clube_visitante_id, rodada_id, placar_visitante, placar_mandante
      FROM fct_partidas WHERE placar_visitante IS NOT NULL)
GROUP BY clube_id, rodada_id""", "fct_partidas")

_cte("metricas_clube", """
SELECT c.clube_id, c.rodada_id, c.total_pontos_fantasy, c.media_pontos_fantasy,
       coalesce(r.gols_marcados, 0) AS total_gols_marcados,
       coalesce(r.gols_sofridos, 0) AS total_gols_sofridos,
       coalesce(r.gols_marcados, 0) - coalesce(r.gols_sofridos, 0) AS saldo_gols,
       r.resultado, t.posicao AS posicao_tabela, t.pontos AS pontos_campeonato,
       t.aproveitamento_percentual
FROM club_scores c
LEFT JOIN club_results r ON c.clube_id = r.clube_id AND c.rodada_id = r.rodada_id
LEFT JOIN tabela t ON c.clube_id = t.clube_id AND c.rodada_id = t.rodada_id""",
     "club_scores", "club_results", "tabela")

PHASE_SQL = ("CASE WHEN CAST({r} AS DOUBLE) / 38 <= CAST(1 AS DOUBLE) / 3 THEN 'inicio' "
             "WHEN CAST({r} AS DOUBLE) / 38 <= CAST(2 AS DOUBLE) / 3 THEN 'meio' ELSE 'fim' END")

_cte("fs_target", "SELECT max(rodada_id) + 1 AS rodada_alvo FROM fct", "fct")
_cte("fs_last3", """
SELECT atleta_id, round(sum(pontos_num), 2) / count(pontos_num) AS m3
FROM (SELECT atleta_id, pontos_num,
             row_number() OVER (PARTITION BY atleta_id ORDER BY rodada_id DESC) AS rn FROM fct)
WHERE rn <= 3 GROUP BY atleta_id""", "fct")
_cte("fs_slope", """
SELECT atleta_id, regr_slope(pontos_num, CAST(rodada_id AS DOUBLE)) AS tendencia_slope,
       count(*) AS n_rodadas
FROM (SELECT atleta_id, rodada_id, pontos_num,
             row_number() OVER (PARTITION BY atleta_id ORDER BY rodada_id DESC) AS rn FROM played)
WHERE rn <= 5 GROUP BY atleta_id""", "played")
_cte("fs_pick", """
SELECT CASE WHEN (SELECT max(rodada_id) FROM fct_partidas_prox) >= rodada_alvo THEN rodada_alvo
            ELSE (SELECT max(rodada_id) FROM fct_partidas_prox) END AS pick
FROM fs_target""", "fct_partidas_prox", "fs_target")
_cte("fs_adv", """
SELECT clube_id, mando_campo, adversario_id
FROM (SELECT *, row_number() OVER (PARTITION BY clube_id ORDER BY partida_id) AS rn
      FROM (SELECT partida_id, clube_casa_id AS clube_id, 'casa' AS mando_campo,
                   clube_visitante_id AS adversario_id
            FROM fct_partidas_prox, fs_pick WHERE rodada_id = pick
            UNION ALL
            SELECT partida_id, clube_visitante_id, 'fora', clube_casa_id
            FROM fct_partidas_prox, fs_pick WHERE rodada_id = pick))
WHERE rn = 1""", "fct_partidas_prox", "fs_pick")
_cte("fs_tab", """
SELECT clube_id, posicao, aproveitamento_percentual
FROM (SELECT *, row_number() OVER (PARTITION BY clube_id ORDER BY rodada_id DESC) AS rn FROM tabela)
WHERE rn = 1""", "tabela")
_cte("fs_mc", """
SELECT clube_id, media_pontos_fantasy FROM metricas_clube
WHERE rodada_id = (SELECT max(rodada_id) FROM metricas_clube)""", "metricas_clube")
_cte("fs_derby", """
SELECT DISTINCT least(clube_id_a, clube_id_b) AS lo, greatest(clube_id_a, clube_id_b) AS hi FROM cx""",
     "cx")

_cte("feature_store", f"""
SELECT m.atleta_id, t.rodada_alvo, m.media_pontos AS media_pontos_geral, m.media_ultimas_5,
       coalesce(l3.m3, m.media_pontos) AS media_ultimas_3,
       m.desvio_padrao_pontos, m.consistencia_score, m.total_jogos, m.aproveitamento_campo,
       m.preco_atual, m.variacao_preco_acumulada AS variacao_preco, m.posicao_id, m.clube_id,
       tc.posicao AS clube_posicao_tabela, tc.aproveitamento_percentual AS clube_aproveitamento,
       mc.media_pontos_fantasy AS clube_media_fantasy,
       a.adversario_id, ta.posicao AS adversario_posicao_tabela,
       mca.media_pontos_fantasy AS adversario_media_fantasy,
       a.mando_campo, d.lo IS NOT NULL AS eh_classico,
       t.rodada_alvo AS rodada_id_relativa,
       {PHASE_SQL.format(r='t.rodada_alvo')} AS fase_temporada,
       s.tendencia_slope,
       sc.pontuacao AS pontuacao_real
FROM metricas_atleta m
CROSS JOIN fs_target t
LEFT JOIN fs_last3 l3 ON m.atleta_id = l3.atleta_id
LEFT JOIN fs_slope s ON m.atleta_id = s.atleta_id
LEFT JOIN fs_adv a ON m.clube_id = a.clube_id
LEFT JOIN fs_tab tc ON m.clube_id = tc.clube_id
LEFT JOIN fs_tab ta ON a.adversario_id = ta.clube_id
LEFT JOIN fs_mc mc ON m.clube_id = mc.clube_id
LEFT JOIN fs_mc mca ON a.adversario_id = mca.clube_id
LEFT JOIN scored sc ON m.atleta_id = sc.atleta_id AND t.rodada_alvo = sc.rodada_id
LEFT JOIN fs_derby d ON least(m.clube_id, a.adversario_id) = d.lo
                    AND greatest(m.clube_id, a.adversario_id) = d.hi""",
     "metricas_atleta", "fs_target", "fs_last3", "fs_slope", "fs_adv", "fs_tab", "fs_mc",
     "scored", "fs_derby")
