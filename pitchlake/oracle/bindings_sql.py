"""DuckDB twins of ``pitchlake.sources.bindings`` (the oracle side).

Written independently in SQL over the same parquet tables so the oracle
re-derives every domain frame instead of trusting the Spark code.
``with_ctes(body, *names)`` prepends the named CTEs (and their dependencies)
to a query body.
"""

from __future__ import annotations

import re

_SCOUTS = (("G", "purchase"), ("A", "signup"), ("DS", "click"),
           ("FS", "view"), ("CA", "error"))


def _scout_json() -> str:
    parts = []
    for i, (code, et) in enumerate(_SCOUTS):
        lead = "{" if i == 0 else ","
        parts.append(f"'{lead}\"{code}\":' || CAST(sum(CASE WHEN event_type = '{et}' "
                     f"THEN 1 ELSE 0 END) AS BIGINT)")
    return " || ".join(parts) + " || '}'"


def sround(expr: str, digits: int) -> str:
    """HALF_UP rounding of a DOUBLE on its shortest decimal text.

    This is how Spark's ``round`` treats doubles; DuckDB's own ``round``
    multiplies in binary and can round an exact tie such as 2.0581875 down.
    """
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


_cte("ar", f"""
SELECT CAST(user_id AS INTEGER) AS atleta_id,
       CAST(dayofmonth(ts) AS INTEGER) AS rodada_id,
       CAST(user_id % 25 AS INTEGER) AS clube_id,
       CAST(user_id % 6 + 1 AS INTEGER) AS posicao_id,
       CAST(user_id % 8 AS INTEGER) AS status_id,
       round(sum(value), 2) AS pontos_num,
       round(sum(value), 2) / count(*) AS media_num,
       max(value) AS preco_num,
       max(value) - min(value) AS variacao_num,
       CAST(count(*) AS INTEGER) AS jogos_num,
       sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0 AS entrou_em_campo,
       {_scout_json()} AS scout_json,
       max(ts) AS _ingestao_timestamp
FROM events
GROUP BY user_id, dayofmonth(ts)""")

_cte("market", """
SELECT atleta_id, 'Atleta ' || CAST(atleta_id AS VARCHAR) AS nome,
       'A' || CAST(atleta_id AS VARCHAR) AS apelido,
       clube_id, posicao_id, status_id, rodada_id, pontos_num, media_num,
       preco_num, variacao_num, jogos_num, entrou_em_campo, scout_json,
       'https://img/atleta/' || CAST(atleta_id AS VARCHAR) AS foto,
       rodada_id AS _rodada_captura, _ingestao_timestamp,
       'r' || CAST(rodada_id AS VARCHAR) AS _batch_id
FROM ar""", "ar")

_cte("scored", """
SELECT atleta_id, rodada_id, clube_id, posicao_id, pontos_num + 1.0 AS pontuacao,
       substring(scout_json, 1, length(scout_json) - 1) || ',"V":1}' AS scout_json,
       entrou_em_campo
FROM ar WHERE entrou_em_campo""", "ar")

_cte("pm", """
SELECT CAST(rodada_id * 1000 + clube_casa_id * 30 + clube_visitante_id AS INTEGER) AS partida_id,
       rodada_id, clube_casa_id, clube_visitante_id,
       placar_oficial_mandante, placar_oficial_visitante, partida_data,
       'Estadio ' || CAST(clube_casa_id AS VARCHAR) AS estadio, TRUE AS valida
FROM (
  SELECT CAST((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) AS INTEGER) AS rodada_id,
         s_nationkey AS clube_casa_id, c_nationkey AS clube_visitante_id,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS placar_oficial_mandante,
         CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS INTEGER) AS placar_oficial_visitante,
         min(o_orderdate) AS partida_data
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
  WHERE s_nationkey <> c_nationkey
  GROUP BY 1, 2, 3)""")

_cte("pm_null", """
SELECT partida_id, rodada_id, clube_casa_id, clube_visitante_id, partida_data, estadio, valida,
       CASE WHEN rodada_id = (SELECT max(rodada_id) FROM pm) THEN NULL
            ELSE placar_oficial_mandante END AS placar_oficial_mandante,
       CASE WHEN rodada_id = (SELECT max(rodada_id) FROM pm) THEN NULL
            ELSE placar_oficial_visitante END AS placar_oficial_visitante
FROM pm""", "pm")

_cte("cl", """
SELECT CAST(n_nationkey AS INTEGER) AS clube_id, n_name AS nome,
       'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS abreviacao,
       lower(n_name) AS slug,
       CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'https://img/60/' || CAST(n_nationkey AS VARCHAR) END AS escudo_60x60,
       CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE 'https://img/45/' || CAST(n_nationkey AS VARCHAR) END AS escudo_45x45,
       'https://img/30/' || CAST(n_nationkey AS VARCHAR) AS escudo_30x30,
       r_name AS regiao
FROM nation JOIN region ON n_regionkey = r_regionkey""")

_cte("cx", """
SELECT DISTINCT CAST(least(a, b) AS INTEGER) AS clube_id_a, CAST(greatest(a, b) AS INTEGER) AS clube_id_b,
       CASE WHEN a < b THEN na || ' x ' || nb ELSE nb || ' x ' || na END AS nome_classico, r_name AS regiao
FROM (SELECT n_regionkey, n_nationkey AS a, n_name AS na,
             coalesce(lead(n_nationkey) OVER w, first_value(n_nationkey) OVER w) AS b,
             coalesce(lead(n_name) OVER w, first_value(n_name) OVER w) AS nb
      FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey))
JOIN region ON n_regionkey = r_regionkey
WHERE a <> b""")

_cte("px", """
SELECT o_custkey AS key_id, o_orderdate AS captured_at, o_orderkey AS capture_seq,
       o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price
FROM orders""")

_cte("mp_base", """
SELECT atleta_id, rodada_id, posicao_id, pontos_num, pontos_num / CAST(40 AS DOUBLE) AS real FROM ar""", "ar")

_cte("mp_pos", """
SELECT posicao_id, rodada_id,
       round(sum(s) OVER w, 2) / (CAST(40 AS DOUBLE) * sum(n) OVER w) AS p_poisson
FROM (SELECT posicao_id, rodada_id, round(sum(pontos_num), 2) AS s, count(pontos_num) AS n
      FROM mp_base GROUP BY posicao_id, rodada_id)
WINDOW w AS (PARTITION BY posicao_id ORDER BY rodada_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", "mp_base")

_cte("mp_wide", """
SELECT b.atleta_id, b.rodada_id AS rodada_alvo, b.posicao_id,
       CASE WHEN b.rodada_id = (SELECT max(rodada_id) FROM mp_base) THEN NULL ELSE b.real END AS pontuacao_real,
       round(sum(b.pontos_num) OVER w3, 2) / (CAST(40 AS DOUBLE) * count(b.pontos_num) OVER w3) AS p_xgboost,
       round(sum(b.pontos_num) OVER w5, 2) / (CAST(40 AS DOUBLE) * count(b.pontos_num) OVER w5) AS p_lightgbm,
       p.p_poisson
FROM mp_base b LEFT JOIN mp_pos p ON b.posicao_id = p.posicao_id AND b.rodada_id = p.rodada_id
WINDOW w3 AS (PARTITION BY b.atleta_id ORDER BY b.rodada_id RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING),
       w5 AS (PARTITION BY b.atleta_id ORDER BY b.rodada_id RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
     "mp_base", "mp_pos")

_cte("mp", """
SELECT * FROM (
  SELECT atleta_id, rodada_alvo, posicao_id, pontuacao_real, 'xgboost' AS modelo, p_xgboost AS pontuacao_prevista FROM mp_wide
  UNION ALL
  SELECT atleta_id, rodada_alvo, posicao_id, pontuacao_real, 'lightgbm', p_lightgbm FROM mp_wide
  UNION ALL
  SELECT atleta_id, rodada_alvo, posicao_id, pontuacao_real, 'poisson', p_poisson FROM mp_wide)
WHERE pontuacao_prevista IS NOT NULL""", "mp_wide")

_cte("rn", """
SELECT CAST(user_id % 20 AS INTEGER) AS job_id,
       'job_' || lpad(CAST(CAST(user_id % 20 AS INTEGER) AS VARCHAR), 2, '0') AS job_name,
       event_id AS run_id,
       CASE WHEN event_type = 'error' THEN 'FAILED'
            WHEN event_type = 'view' AND value > 200 THEN 'TIMED_OUT'
            ELSE 'SUCCESS' END AS result_state,
       ts AS start_time,
       ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS end_time,
       value AS duration_minutes,
       'user' || CAST(user_id AS VARCHAR) || '@example.com' AS user_name,
       event_type AS action_name,
       'wh_' || CAST(user_id % 4 AS VARCHAR) AS warehouse_id,
       'tbl_' || CAST(user_id % 7 AS VARCHAR) AS table_name,
       CAST(floor(value * 1000) AS BIGINT) AS bytes_read,
       user_id * 10 + 1 AS rows_read
FROM events""")

_cte("us", """
SELECT p_type AS sku_name, l_quantity AS usage_quantity, CAST(l_shipdate AS DATE) AS usage_date,
       l_suppkey AS cluster_id, CAST(l_suppkey % 20 AS INTEGER) AS job_id, n_name AS team
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey""")

_cte("prices", """
SELECT p_type AS sku_name, avg(p_retailprice) AS price FROM part GROUP BY p_type""")

_cte("cu", """
SELECT c_custkey AS customer_id, c_name AS name,
       lower(replace(c_name, '#', '')) || '@example.com' AS email,
       '555-' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' ||
       lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS phone,
       c_acctbal AS salary, r_name AS region, c_mktsegment AS segment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

_cte("or_target", "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'")
_cte("or_source", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")


def _resolve(names, out, seen):
    for n in names:
        if n in seen:
            continue
        sql, deps = CTES[n]
        _resolve(deps, out, seen)
        seen.add(n)
        out.append(n)


def with_ctes(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the named binding CTEs, dependencies first.

    ``extra`` is a list of (name, sql) CTEs appended after the bindings.
    """
    order: list[str] = []
    _resolve(names, order, set())
    parts = [f"{n} AS ({CTES[n][0]})" for n in order]
    parts += [f"{n} AS ({s})" for n, s in (extra or [])]
    if not parts:
        return body
    recursive = any(re.search(rf"\b{n}\b", CTES[n][0]) for n in order)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body
