"""Oracle SQL for pitchlake.plans.q_core."""

from pitchlake.oracle.model_sql import PER_GAME_SQL, PHASE_SQL, scouts_sql
from pitchlake.oracle.queries_sql import oracle

ATHLETE_DOUBLES = ("total_pontos", "media_pontos", "desvio_padrao_pontos", "max_pontos",
                   "min_pontos", "mediana_pontos", "aproveitamento_campo",
                   "variacao_preco_acumulada")

oracle("p01_staging_views", """
SELECT atleta_id, nome, apelido, foto AS foto_url, clube_id, posicao_id, status_id, rodada_id,
       pontos_num, media_num, preco_num, variacao_num, jogos_num, entrou_em_campo,
       _rodada_captura, _ingestao_timestamp, _batch_id
FROM market""", "market", doubles=("pontos_num", "media_num", "preco_num", "variacao_num"))

oracle("p02_match_result",
       "SELECT partida_id, resultado_mandante, resultado_visitante FROM fct_partidas_prox",
       "fct_partidas_prox")

oracle("p03_trend_label", """
SELECT atleta_id, rodada_id,
       CASE WHEN pontos_num > lag(pontos_num) OVER w * 1.1 THEN 'subindo'
            WHEN pontos_num < lag(pontos_num) OVER w * 0.9 THEN 'caindo'
            ELSE 'estavel' END AS tendencia
FROM market WINDOW w AS (PARTITION BY atleta_id ORDER BY rodada_id)""", "market")

oracle("p04_status_decode", """
SELECT event_id, CAST(user_id % 7 AS INTEGER) AS status_mercado,
       CASE CAST(user_id % 7 AS INTEGER) WHEN 1 THEN 'Aberto' WHEN 2 THEN 'Fechado'
            WHEN 4 THEN 'Em Manutenção' WHEN 6 THEN 'Fim de Rodada' ELSE 'Desconhecido' END
           AS status_descricao
FROM events""")

oracle("p05_points_from_result", """
SELECT partida_id, clube_id,
       CASE resultado WHEN 'V' THEN 3 WHEN 'E' THEN 1 ELSE 0 END AS pontos,
       CASE WHEN resultado = 'V' THEN 1 ELSE 0 END AS vitorias,
       CASE WHEN resultado = 'E' THEN 1 ELSE 0 END AS empates,
       CASE WHEN resultado = 'D' THEN 1 ELSE 0 END AS derrotas
FROM persp""", "persp")

oracle("p06_first_non_null", """
SELECT p_partkey, coalesce(nullif(p_type, 'ECONOMY'), nullif(p_brand, 'Brand#2'), p_name) AS primeiro
FROM part""")

oracle("p07_played_filter", "SELECT atleta_id, rodada_id, pontos_num FROM played", "played",
       doubles=("pontos_num",))

oracle("p08_incremental_predicate", """
SELECT atleta_id, rodada_id, pontos_num FROM fct
WHERE rodada_id >= (SELECT max(rodada_id) - 1 FROM fct
                    WHERE _ingestao_timestamp < TIMESTAMP '2024-01-26')
   OR (SELECT max(rodada_id) FROM fct WHERE _ingestao_timestamp < TIMESTAMP '2024-01-26') IS NULL""",
       "fct", doubles=("pontos_num",))

oracle("p14_total_goals", "SELECT partida_id, total_gols FROM fct_partidas_prox", "fct_partidas_prox")

oracle("u01_two_perspectives", """
SELECT partida_id, rodada_id, clube_id, adversario_id, mando_campo, gols_pro, gols_contra, resultado
FROM persp""", "persp")

oracle("a08_standings_round", "SELECT * FROM tabela", "tabela",
       doubles=("aproveitamento_percentual",))
oracle("w03_standings_rank", "SELECT clube_id, rodada_id, posicao FROM tabela", "tabela")
oracle("a09_standings_cumulative", "SELECT * FROM tabela_cum", "tabela_cum",
       doubles=("aproveitamento_percentual",))

oracle("w08_streaks", """
SELECT clube_id, rodada_id,
       CAST(i - max(CASE WHEN derrotas <> 0 THEN i ELSE 0 END) OVER w AS INTEGER) AS invicto_seq,
       CAST(i - max(CASE WHEN vitorias <> 0 THEN i ELSE 0 END) OVER w AS INTEGER) AS sem_vitoria_seq
FROM (SELECT *, row_number() OVER (PARTITION BY clube_id ORDER BY rodada_id) AS i FROM round_totals)
WINDOW w AS (PARTITION BY clube_id ORDER BY rodada_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
       "round_totals")

oracle("w10_last5_form", """
SELECT f.clube_id, f.rodada_id, h.h AS forma_ultimos5
FROM w10_firsts f JOIN w10_hist h ON f.clube_id = h.clube_id AND f.first_i = h.i""", "persp",
       extra=[("w10_seq", """
  SELECT clube_id, rodada_id, partida_id, lower(resultado) AS r,
         row_number() OVER (PARTITION BY clube_id ORDER BY rodada_id, partida_id) AS i
  FROM persp"""),
              ("w10_hist", """
  SELECT clube_id, i,
         coalesce(array_to_string(list(r) OVER (PARTITION BY clube_id ORDER BY i
                                                ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), ''), '') AS h
  FROM w10_seq"""),
              ("w10_firsts", "SELECT clube_id, rodada_id, min(i) AS first_i FROM w10_seq GROUP BY clube_id, rodada_id")])

oracle("w12_home_away_goals", """
SELECT clube_id, rodada_id,
       CAST(sum(gc) OVER w AS BIGINT) AS gols_casa_acum, CAST(sum(gf) OVER w AS BIGINT) AS gols_fora_acum,
       CAST(sum(sc) OVER w AS BIGINT) AS sofridos_casa_acum, CAST(sum(sf) OVER w AS BIGINT) AS sofridos_fora_acum
FROM (SELECT clube_id, rodada_id,
             sum(CASE WHEN mando_campo = 'casa' THEN gols_pro ELSE 0 END) AS gc,
             sum(CASE WHEN mando_campo = 'fora' THEN gols_pro ELSE 0 END) AS gf,
             sum(CASE WHEN mando_campo = 'casa' THEN gols_contra ELSE 0 END) AS sc,
             sum(CASE WHEN mando_campo = 'fora' THEN gols_contra ELSE 0 END) AS sf
      FROM persp GROUP BY clube_id, rodada_id)
WINDOW w AS (PARTITION BY clube_id ORDER BY rodada_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
       "persp")

oracle("a32_goals_for_against_means", """
SELECT clube_id, rodada_id,
       sum(gp) OVER w / sum(n) OVER w AS media_gols_marcados,
       sum(gc) OVER w / sum(n) OVER w AS media_gols_sofridos
FROM (SELECT clube_id, rodada_id, sum(gols_pro) AS gp, sum(gols_contra) AS gc, count(*) AS n
      FROM persp GROUP BY clube_id, rodada_id)
WINDOW w AS (PARTITION BY clube_id ORDER BY rodada_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
       "persp", doubles=("media_gols_marcados", "media_gols_sofridos"))

oracle("a30_home_away_analysis", """
SELECT mando_campo, count(*) AS jogos, avg(gols_pro) AS media_gols,
       avg(CASE WHEN resultado = 'V' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS taxa_vitoria,
       avg(CAST(CASE resultado WHEN 'V' THEN 3 WHEN 'E' THEN 1 ELSE 0 END AS DOUBLE)) AS media_pontos
FROM persp GROUP BY mando_campo""", "persp", doubles=("media_gols", "taxa_vitoria", "media_pontos"))

FACT_DOUBLES = ("pontos_num", "media_num", "preco_num", "variacao_num")
oracle("j01_enrich_with_scores", "SELECT * FROM fct", "fct", doubles=FACT_DOUBLES)

oracle("f01_parse_scouts", f"SELECT atleta_id, rodada_id, {scouts_sql()} FROM market", "market")

oracle("j02_status_lookup", "SELECT * FROM dim_atletas", "dim_atletas")

oracle("w01_latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""", doubles=("value",))

oracle("w02_qualify_filter", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
       doubles=("o_totalprice",))

oracle("a01_season_totals", "SELECT * FROM totals", "totals", doubles=ATHLETE_DOUBLES)
oracle("a02_last_n_mean", "SELECT * FROM recent", "recent",
       doubles=("media_ultimas_5", "preco_atual", "media_ultimas_3"))
oracle("a03_per_game_ratios", f"SELECT atleta_id, clube_id, posicao_id, {PER_GAME_SQL} FROM totals",
       "totals", doubles=("gols_por_jogo", "assistencias_por_jogo", "participacao_gols_por_jogo",
                          "cartoes_por_jogo"))
oracle("a04_consistency", """
SELECT atleta_id, clube_id, posicao_id,
       CASE WHEN media_pontos > 0 THEN 1 - coalesce(desvio_padrao_pontos, 0) / media_pontos ELSE 0 END
           AS consistencia_score
FROM totals""", "totals", doubles=("consistencia_score",))

METRICS_DOUBLES = ATHLETE_DOUBLES + ("gols_por_jogo", "assistencias_por_jogo",
                                     "participacao_gols_por_jogo", "cartoes_por_jogo",
                                     "preco_atual", "preco_por_ponto", "media_ultimas_5",
                                     "consistencia_score")
oracle("a05_price_per_point",
       "SELECT atleta_id, clube_id, preco_atual, preco_por_ponto FROM metricas_atleta",
       "metricas_atleta", doubles=("preco_atual", "preco_por_ponto"))
oracle("a06_athlete_profile", "SELECT * FROM metricas_atleta", "metricas_atleta",
       doubles=METRICS_DOUBLES)
oracle("a07_club_round_metrics", "SELECT * FROM club_scores", "club_scores",
       doubles=("total_pontos_fantasy", "media_pontos_fantasy"))
oracle("j10_club_result_join", "SELECT * FROM metricas_clube", "metricas_clube",
       doubles=("total_pontos_fantasy", "media_pontos_fantasy", "aproveitamento_percentual"))

oracle("w05_rolling_mean_3", """
SELECT atleta_id, rodada_id,
       coalesce(round(sum(pontos_num) OVER w, 2) / count(pontos_num) OVER w,
                round(sum(pontos_num) OVER (PARTITION BY atleta_id), 2)
                    / count(pontos_num) OVER (PARTITION BY atleta_id)) AS media_ultimas_3
FROM fct WINDOW w AS (PARTITION BY atleta_id ORDER BY rodada_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
       "fct", doubles=("media_ultimas_3",))
oracle("w05_rolling_mean_literal", """
SELECT atleta_id, rodada_id,
       coalesce(round(sum(pontos_num) OVER w, 2) / count(pontos_num) OVER w,
                round(sum(pontos_num) OVER (PARTITION BY atleta_id), 2)
                    / count(pontos_num) OVER (PARTITION BY atleta_id)) AS media_ultimas_3
FROM fct WINDOW w AS (PARTITION BY atleta_id ORDER BY rodada_id DESC ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
       "fct", doubles=("media_ultimas_3",))

oracle("w07_linear_trend_5", "SELECT * FROM fs_slope", "fs_slope", doubles=("tendencia_slope",))

oracle("w11_price_change_pct", """
SELECT atleta_id, preco_inicial, preco_final,
       CASE WHEN preco_inicial <> 0 THEN (preco_final - preco_inicial) / preco_inicial END AS valorizacao_pct
FROM (SELECT atleta_id, arg_min(preco_num, rodada_id) AS preco_inicial,
             arg_max(preco_num, rodada_id) AS preco_final
      FROM fct GROUP BY atleta_id)""", "fct",
       doubles=("preco_inicial", "preco_final", "valorizacao_pct"))

oracle("w13_season_phase",
       f"SELECT atleta_id, rodada_id, {PHASE_SQL.format(r='rodada_id')} AS fase FROM fct", "fct")

oracle("w15_tenure_games", """
SELECT atleta_id, rodada_id,
       CAST(sum(CAST(entrou_em_campo AS INTEGER)) OVER (PARTITION BY atleta_id ORDER BY rodada_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS jogos_como_titular
FROM fct""", "fct")

_W = (("G", 8.0), ("A", 5.0), ("SG", 5.0), ("DE", 3.0), ("DP", 7.0), ("DS", 1.5), ("FS", 0.5),
      ("FD", 1.0), ("FF", 0.8), ("FT", 3.0), ("PS", 0.8), ("PC", 0.3), ("PP", 0.3), ("V", 1.0),
      ("I", -0.1), ("FC", -0.5), ("CA", -2.0), ("CV", -5.0), ("GC", -5.0), ("GS", -2.0))
_SC = dict((c, n) for c, n in (
    ("G", "scout_gol"), ("A", "scout_assistencia"), ("FT", "scout_finalizacao_trave"),
    ("FD", "scout_finalizacao_defendida"), ("FF", "scout_finalizacao_fora"),
    ("FS", "scout_falta_sofrida"), ("DS", "scout_desarme"), ("I", "scout_impedimento"),
    ("SG", "scout_saldo_gol"), ("DE", "scout_defesa"), ("DP", "scout_defesa_penalti"),
    ("GC", "scout_gol_contra"), ("CA", "scout_cartao_amarelo"), ("CV", "scout_cartao_vermelho"),
    ("FC", "scout_falta_cometida"), ("PS", "scout_passe_decisivo"), ("PC", "scout_passe_completo"),
    ("PP", "scout_pre_assistencia"), ("V", "scout_vitoria"), ("GS", "scout_gol_sofrido")))
_ORDER = ("G", "A", "FT", "FD", "FF", "FS", "DS", "I", "SG", "DE", "DP", "GC", "CA", "CV",
          "FC", "PS", "PC", "PP", "V", "GS")
_WD = dict(_W)
oracle("a33_scout_points", "SELECT atleta_id, rodada_id, "
       + " + ".join(f"{_SC[c]} * CAST({_WD[c]} AS DOUBLE)" for c in _ORDER)
       + " AS pontos_scout FROM fct", "fct", doubles=("pontos_scout",))

oracle("w09_days_since_last", """
SELECT o_custkey, o_orderkey, o_orderdate,
       CAST(date_diff('day', CAST(lag(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER)
           AS dias_desde_ultimo
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")

FS_DOUBLES = ("media_pontos_geral", "media_ultimas_5", "media_ultimas_3", "desvio_padrao_pontos",
              "consistencia_score", "aproveitamento_campo", "preco_atual", "variacao_preco",
              "clube_aproveitamento", "clube_media_fantasy", "adversario_media_fantasy",
              "tendencia_slope", "pontuacao_real")
oracle("l00_feature_store", "SELECT * FROM feature_store", "feature_store", doubles=FS_DOUBLES)

oracle("j05_opponent_lookup", """
SELECT d.clube_id, d.atleta_id, a.mando_campo, a.adversario_id
FROM dim_atletas d LEFT JOIN fs_adv a ON d.clube_id = a.clube_id""", "dim_atletas", "fs_adv")

oracle("j06_cross_scalar", "SELECT atleta_id, rodada_alvo FROM dim_atletas CROSS JOIN fs_target",
       "dim_atletas", "fs_target")

oracle("j07_role_playing", """
SELECT atleta_id, clube_id, adversario_id, clube_posicao_tabela, adversario_posicao_tabela,
       clube_media_fantasy, adversario_media_fantasy FROM feature_store""", "feature_store",
       doubles=("clube_media_fantasy", "adversario_media_fantasy"))

oracle("j08_derby_exists", """
SELECT partida_id, clube_casa_id, clube_visitante_id,
       EXISTS (SELECT 1 FROM cx WHERE (cx.clube_id_a = m.clube_casa_id AND cx.clube_id_b = m.clube_visitante_id)
                                   OR (cx.clube_id_b = m.clube_casa_id AND cx.clube_id_a = m.clube_visitante_id))
           AS eh_classico
FROM fct_partidas m""", "fct_partidas", "cx")

oracle("j09_target_join", "SELECT atleta_id, rodada_alvo, pontuacao_real FROM feature_store",
       "feature_store", doubles=("pontuacao_real",))

oracle("u04_distinct_values", "SELECT DISTINCT rodada_id FROM fct", "fct")

oracle("s12_seed_csv", """
SELECT s.posicao_id, s.nome, s.abreviacao, c.atletas
FROM positions_seed s
LEFT JOIN (SELECT posicao_id, count(*) AS atletas FROM dim_atletas GROUP BY posicao_id) c
  ON s.posicao_id = c.posicao_id""", "positions_seed", "dim_atletas")

oracle("w06_recent_row_number", """
SELECT atleta_id, rodada_id, CAST(row_number() OVER (PARTITION BY atleta_id ORDER BY rodada_id DESC) AS INTEGER)
           AS rn_desc
FROM played""", "played")

oracle("j03_round_calendar", """
SELECT r.rodada_id, r.nome_rodada, r.data_inicio, r.data_fim,
       coalesce(s.temporada, CAST(year(r.data_inicio) AS INTEGER)) AS temporada
FROM (SELECT CAST(dayofmonth(ts) AS INTEGER) AS rodada_id,
             'Rodada ' || CAST(CAST(dayofmonth(ts) AS INTEGER) AS VARCHAR) AS nome_rodada,
             CAST(strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS data_inicio,
             CAST(strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS data_fim
      FROM events GROUP BY CAST(dayofmonth(ts) AS INTEGER)) r
LEFT JOIN (SELECT rodada_atual, temporada FROM (
             SELECT CAST(dayofmonth(ts) AS INTEGER) AS rodada_atual,
                    CASE WHEN CAST(dayofmonth(ts) AS INTEGER) % 5 = 0 THEN NULL ELSE 2024 END AS temporada,
                    max(ts) AS cap
             FROM events GROUP BY CAST(dayofmonth(ts) AS INTEGER), hour(ts))
           QUALIFY row_number() OVER (PARTITION BY rodada_atual ORDER BY cap DESC) = 1) s
  ON r.rodada_id = s.rodada_atual""")

oracle("f02_row_key", """
SELECT o_orderkey, sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
                                    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'))) AS row_key
FROM orders""")

oracle("f03_surrogate_key", """
SELECT o_orderkey, md5(concat_ws('-', coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(o_orderstatus, ''),
                                 coalesce(o_orderpriority, ''))) AS sk
FROM orders""")
