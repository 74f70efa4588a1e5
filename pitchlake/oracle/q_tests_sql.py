"""Oracle SQL for the reference's declared model tests (loaded after all model CTEs)."""

from pitchlake.oracle.queries_sql import oracle

# ------------------------------------------------------------------ declared model tests
from pitchlake.oracle.bindings_sql import _cte  # noqa: E402
from pitchlake.operators.quality import DECLARED_TESTS  # noqa: E402  (the reference's test list: fixed values)

_cte("m_dim_rodadas", """
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
_cte("m_mercado_status", """
SELECT r AS rodada_atual, CAST(r % 4 + 1 AS INTEGER) AS status_mercado,
       CASE CAST(r % 4 + 1 AS INTEGER) WHEN 1 THEN 'Aberto' WHEN 2 THEN 'Fechado' WHEN 4 THEN 'Em Manutenção'
            WHEN 6 THEN 'Fim de Rodada' ELSE 'Desconhecido' END AS status_descricao
FROM (SELECT DISTINCT CAST(dayofmonth(ts) AS INTEGER) AS r FROM events)""")
_cte("m_destaques", "SELECT DISTINCT CAST(dayofmonth(ts) AS INTEGER) AS rodada_id FROM events")

_MODEL_CTE = {"dim_clubes": "cl", "dim_posicoes": "positions_seed", "dim_atletas": "dim_atletas",
              "dim_rodadas": "m_dim_rodadas", "fct_atletas_rodada": "fct", "fct_partidas": "fct_partidas_prox",
              "fct_mercado_status": "m_mercado_status", "fct_destaques_rodada": "m_destaques",
              "metricas_atleta_acumulado": "metricas_atleta", "tabela_liga": "tabela",
              "metricas_clube_rodada": "metricas_clube", "feature_store_previsao": "feature_store",
              "previsao_final": "ranked"}


def _lit(v):
    return f"'{v}'" if isinstance(v, str) else str(v)


def _test_sql(m, c, t, arg):
    src = _MODEL_CTE[m]
    head = f"SELECT '{m}' AS modelo, '{c}' AS coluna, '{t}' AS teste, "
    if t == "not_null":
        return head + f"count(*) FILTER (WHERE {c} IS NULL) AS falhas FROM {src}"
    if t == "unique":
        return head + f"count(*) AS falhas FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    if t == "accepted_values":
        vals, where = arg
        cond = f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_lit(v) for v in vals)})"
        if where:
            cond += f" AND coalesce(({where}), FALSE)"
        return head + f"count(*) FILTER (WHERE {cond}) AS falhas FROM {src}"
    if t == "expression_is_true":
        return head + f"count(*) FILTER (WHERE NOT coalesce(({c} {arg}), TRUE)) AS falhas FROM {src}"
    if t == "relationships":
        parent, key = arg
        return head + (f"count(*) AS falhas FROM {src} WHERE {c} IS NOT NULL "
                       f"AND {c} NOT IN (SELECT {key} FROM {_MODEL_CTE[parent]} WHERE {key} IS NOT NULL)")
    raise ValueError(t)


_SINGULAR_SQL = [
    "SELECT 'fct_atletas_rodada' AS modelo, '*' AS coluna, 'assert_atleta_unicidade' AS teste, count(*) AS falhas "
    "FROM (SELECT atleta_id, rodada_id FROM fct GROUP BY atleta_id, rodada_id HAVING count(*) > 1)",
    "SELECT 'fct_partidas', '*', 'assert_placar_nao_negativo', count(*) FROM fct_partidas_prox "
    "WHERE (placar_mandante IS NOT NULL AND placar_mandante < 0) OR (placar_visitante IS NOT NULL AND placar_visitante < 0)",
    "SELECT 'fct_atletas_rodada', '*', 'assert_rodada_range', count(DISTINCT rodada_id) FROM fct "
    "WHERE rodada_id < 1 OR rodada_id > 38",
]

oracle("q11_declared_model_tests",
       "\nUNION ALL\n".join([_test_sql(*t) for t in DECLARED_TESTS] + _SINGULAR_SQL),
       *sorted(set(_MODEL_CTE.values())))
