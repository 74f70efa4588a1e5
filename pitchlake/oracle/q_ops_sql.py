"""Oracle SQL for pitchlake.plans.q_ops."""

from pitchlake.oracle.bindings_sql import sround
from pitchlake.oracle.queries_sql import oracle

ASOF = "TIMESTAMP '2024-01-31'"
MIN = "CAST(floor((epoch_us(end_time) - epoch_us(start_time)) / 60000000) AS BIGINT)"


def msum(c: str) -> str:
    return f"round(sum({c}), 2)"


def mavg(c: str) -> str:
    return f"round(sum({c}), 2) / count({c})"


oracle("a17_run_health", f"""
SELECT job_id, job_name, count(*) AS execucoes,
       count(CASE WHEN result_state = 'SUCCESS' THEN 1 END) AS sucessos,
       count(CASE WHEN result_state = 'FAILED' THEN 1 END) AS falhas,
       count(CASE WHEN result_state = 'TIMED_OUT' THEN 1 END) AS timeouts,
       avg({MIN}) AS minutos_medios,
       {sround("CAST(count(CASE WHEN result_state = 'SUCCESS' THEN 1 END) AS DOUBLE) * 100 / count(*)", 2)}
           AS taxa_sucesso
FROM rn WHERE start_time >= {ASOF} - INTERVAL 168 HOURS AND start_time < {ASOF}
GROUP BY job_id, job_name""", "rn", doubles=("minutos_medios", "taxa_sucesso"))

oracle("a18_failure_rate_having", f"""
SELECT * FROM (
  SELECT job_name, count(*) AS execucoes, count(CASE WHEN result_state = 'FAILED' THEN 1 END) AS falhas,
         {sround("CAST(count(CASE WHEN result_state = 'FAILED' THEN 1 END) AS DOUBLE) * 100 / count(*)", 2)}
             AS taxa_falha
  FROM rn GROUP BY job_name)
WHERE taxa_falha > 5""", "rn", doubles=("taxa_falha",))

oracle("a19_alert_collect", f"""
SELECT count(*) AS falhas, list_sort(list(DISTINCT job_name)) AS jobs_com_falha
FROM rn WHERE result_state = 'FAILED' AND start_time >= {ASOF} - INTERVAL 24 HOURS AND start_time < {ASOF}""",
       "rn")

oracle("a28_queue_stats", f"""
SELECT warehouse_id, count(*) AS consultas, {mavg('duration_minutes')} AS duracao_media,
       max(duration_minutes) AS duracao_max
FROM rn GROUP BY warehouse_id""", "rn", doubles=("duracao_media", "duracao_max"))

oracle("a29_access_counts_having", """
SELECT user_name, action_name, count(*) AS acessos FROM rn
GROUP BY user_name, action_name HAVING count(*) > 15""", "rn")

oracle("a34_scan_volume", f"""
SELECT table_name, CAST(sum(bytes_read) AS BIGINT) AS bytes_lidos, CAST(sum(rows_read) AS BIGINT) AS linhas_lidas,
       count(*) AS consultas
FROM rn WHERE start_time >= {ASOF} - INTERVAL 7 DAYS AND start_time < {ASOF}
GROUP BY table_name""", "rn")

oracle("t03_best_version", """
SELECT job_id, run_id, duration_minutes FROM rn
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY duration_minutes DESC, run_id DESC) = 1""", "rn",
       doubles=("duration_minutes",))

oracle("t05_slow_queries", f"""
SELECT run_id, job_name, user_name, duration_minutes, start_time FROM rn
WHERE duration_minutes > 100 AND start_time >= {ASOF} - INTERVAL 24 HOURS AND start_time < {ASOF}
ORDER BY duration_minutes DESC, run_id LIMIT 20""", "rn", doubles=("duration_minutes",))

oracle("p13_audit_predicates", f"""
SELECT run_id, user_name, action_name, result_state, start_time FROM rn
WHERE action_name IN ('error', 'view') AND user_name NOT IN ('user1@example.com')
  AND user_name LIKE '%1%' AND result_state <> 'SUCCESS' AND start_time >= {ASOF} - INTERVAL 7 DAYS""", "rn")

oracle("w14_run_anomalies", """
SELECT job_id, run_id, start_time, result_state, duration_minutes,
       (f = 1 AND len >= 3) AS in_failure_streak, duration_minutes > 2 * avg_d AS long_run
FROM (SELECT *, CASE WHEN f = 1 THEN count(*) OVER (PARTITION BY job_id, island) END AS len,
             avg(duration_minutes) OVER (PARTITION BY job_id) AS avg_d
      FROM (SELECT *, sum(chg) OVER (PARTITION BY job_id ORDER BY start_time, run_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
            FROM (SELECT job_id, run_id, start_time, result_state, duration_minutes,
                         CASE WHEN result_state = 'FAILED' THEN 1 ELSE 0 END AS f,
                         CASE WHEN lag(CASE WHEN result_state = 'FAILED' THEN 1 ELSE 0 END)
                                   OVER (PARTITION BY job_id ORDER BY start_time, run_id)
                                   IS DISTINCT FROM (CASE WHEN result_state = 'FAILED' THEN 1 ELSE 0 END)
                              THEN 1 ELSE 0 END AS chg
                  FROM rn)))
WHERE (f = 1 AND len >= 3) OR duration_minutes > 2 * avg_d""", "rn", doubles=("duration_minutes",))

oracle("l19_run_registry", """
SELECT job_id, metrica, arg_max(run_id, (valor, run_id)) AS melhor_run, max(valor) AS melhor_valor,
       count(*) AS execucoes
FROM (SELECT job_id, run_id, 'duration_minutes' AS metrica, duration_minutes AS valor FROM rn
      UNION ALL SELECT job_id, run_id, 'bytes_read', CAST(bytes_read AS DOUBLE) FROM rn
      UNION ALL SELECT job_id, run_id, 'rows_read', CAST(rows_read AS DOUBLE) FROM rn)
GROUP BY job_id, metrica""", "rn", doubles=("melhor_valor",))

oracle("l19_run_log", """
WITH m AS (
  SELECT 'job-' || job_id AS model, weekofyear(start_time)::INT AS version, run_id::VARCHAR AS run_id, metric, value,
         CASE WHEN metric = 'duration_minutes' THEN -value ELSE value END AS good
  FROM (SELECT *, 'duration_minutes' AS metric, duration_minutes::DOUBLE AS value FROM rn_q
        UNION ALL SELECT *, 'bytes_read', bytes_read::DOUBLE FROM rn_q UNION ALL SELECT *, 'rows_read', rows_read::DOUBLE FROM rn_q)
  WHERE value IS NOT NULL),
b AS (
  SELECT model, metric, version, count(*) AS runs, arg_min({'run_id': run_id, 'value': value}, (-good, run_id)) AS r, max(good) AS good
  FROM m GROUP BY ALL)
SELECT model, metric, version, runs, r.run_id AS run_id, r.value AS value,
       r.value - lag(r.value) OVER (PARTITION BY model, metric ORDER BY version) AS change,
       row_number() OVER (PARTITION BY model, metric ORDER BY good DESC, version DESC) = 1 AS is_best
FROM b""".replace("rn_q", "rn"), "rn", doubles=("value", "change"))

_ORDERS_REGION = """(SELECT o.*, r_name AS region FROM orders o JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

oracle("a20_daily_metrics", f"""
SELECT date_trunc('day', o_orderdate) AS dia, region, count(*) AS pedidos,
       {msum('o_totalprice')} AS receita, {mavg('o_totalprice')} AS ticket_medio
FROM {_ORDERS_REGION} GROUP BY date_trunc('day', o_orderdate), region""",
       doubles=("receita", "ticket_medio"))

oracle("a21_generic_rollup", """
SELECT date_trunc('day', ts) AS day_bucket, event_type, count(*) AS eventos,
       round(sum(value), 2) AS valor_total, count(DISTINCT user_id) AS usuarios
FROM events GROUP BY date_trunc('day', ts), event_type""", doubles=("valor_total",))

oracle("a22_daily_distinct", """
SELECT CAST(ts AS DATE) AS dia, count(*) AS eventos,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END), 2) AS receita,
       count(DISTINCT user_id) AS usuarios
FROM events GROUP BY CAST(ts AS DATE)""", doubles=("receita",))

oracle("a23_customer_features", f"""
SELECT o_custkey, count(*) AS pedidos, {mavg('o_totalprice')} AS ticket_medio,
       {msum('o_totalprice')} AS valor_total, min(o_orderdate) AS primeiro_pedido,
       max(o_orderdate) AS ultimo_pedido,
       CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-12-31') AS INTEGER) AS recencia_dias,
       CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '2001-12-31') AS INTEGER) AS tempo_cliente_dias
FROM orders GROUP BY o_custkey""", doubles=("ticket_medio", "valor_total"))

oracle("a24_user_features", f"""
SELECT user_id, count(*) AS eventos, {mavg('value')} AS valor_medio, max(ts) AS ultimo_evento,
       count(DISTINCT event_type) AS tipos_distintos,
       CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-31') AS INTEGER) AS dias_desde_ultimo
FROM events GROUP BY user_id""", doubles=("valor_medio",))

oracle("a25_conditional_summary", """
SELECT o_custkey, count(*) AS pedidos, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS pedidos_finalizados,
       round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END), 2) AS valor_finalizado,
       min(o_orderdate) AS primeiro_pedido, max(o_orderdate) AS ultimo_pedido
FROM orders GROUP BY o_custkey""", doubles=("valor_finalizado",))

oracle("a26_sanity_profile", """
SELECT count(*) AS linhas, count(DISTINCT event_id) AS ids_distintos,
       count(CASE WHEN value IS NULL THEN 1 END) AS valores_nulos, min(ts) AS primeiro, max(ts) AS ultimo
FROM events""")

_COST = """(SELECT {dims}, sum(q * coalesce(price, 0.0)) AS custo
   FROM (SELECT sku_name, {dims}, sum(usage_quantity) AS q FROM us_w GROUP BY sku_name, {dims}) u
   LEFT JOIN prices USING (sku_name) GROUP BY {dims})"""
_US_W = ("us_w", "SELECT *, date_trunc('week', usage_date) AS semana FROM us")

oracle("a27_cost_rollups", f"""
SELECT 'cluster' AS dimensao, CAST(cluster_id AS VARCHAR) AS chave, {sround('custo', 2)} AS custo
FROM {_COST.format(dims='cluster_id')}
UNION ALL
SELECT 'time', team, {sround('custo', 2)} FROM {_COST.format(dims='team')}
UNION ALL
SELECT 'semana_sku', strftime(semana, '%Y-%m-%d') || '|' || sku_name, {sround('custo', 2)}
FROM {_COST.format(dims='semana, sku_name')}""", "us", "prices", extra=[_US_W], doubles=("custo",))

oracle("t01_top_n", f"""
SELECT cluster_id, {sround('custo', 2)} AS custo FROM {_COST.format(dims='cluster_id')}
ORDER BY {sround('custo', 2)} DESC, cluster_id LIMIT 10""", "us", "prices", extra=[_US_W], doubles=("custo",))

oracle("j14_price_lookup_join", f"""
SELECT sku_name, {sround('q * coalesce(price, 0.0)', 2)} AS custo, q AS quantidade
FROM (SELECT sku_name, sum(usage_quantity) AS q FROM us GROUP BY sku_name) LEFT JOIN prices USING (sku_name)""",
       "us", "prices",
       doubles=("custo", "quantidade"))

oracle("j15_four_way_run_cost", f"""
SELECT r.job_id, r.job_name, r.execucoes, r.minutos_medios,
       {sround('coalesce(c.custo, 0.0)', 2)} AS custo
FROM (SELECT job_id, job_name, count(DISTINCT run_id) AS execucoes, {mavg('duration_minutes')} AS minutos_medios
      FROM rn GROUP BY job_id, job_name) r
LEFT JOIN {_COST.format(dims='job_id')} c ON r.job_id = c.job_id""", "rn", "us", "prices",
       extra=[_US_W], doubles=("minutos_medios", "custo"))

oracle("j13_agg_then_left", """
SELECT c_custkey, c_name, coalesce(pedidos, 0) AS pedidos, coalesce(valor_total, 0.0) AS valor_total,
       primeiro_pedido, ultimo_pedido
FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS pedidos,
                                round(sum(o_totalprice), 2) AS valor_total,
                                min(o_orderdate) AS primeiro_pedido, max(o_orderdate) AS ultimo_pedido
                         FROM orders GROUP BY o_custkey) USING (c_custkey)""", doubles=("valor_total",))

oracle("j16_size_based_broadcast", """
SELECT o_custkey, o_orderkey, o_totalprice, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""", doubles=("o_totalprice",))

oracle("j17_skew_join", """
SELECT e.user_id, e.event_id, e.value, u.eventos
FROM events e JOIN (SELECT user_id, count(*) AS eventos FROM events GROUP BY user_id) u
  ON e.user_id = u.user_id""", doubles=("value",))

oracle("p09_tier_label", """
SELECT o_orderkey, CASE WHEN o_totalprice / 100 >= 1000 THEN 'high' WHEN o_totalprice / 100 >= 100 THEN 'medium'
                        ELSE 'low' END AS faixa
FROM orders""")

oracle("p10_cents_to_units", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {sround('l_extendedprice / CAST(100 AS DOUBLE)', 2)} AS valor
FROM lineitem""", doubles=("valor",))

oracle("p11_recent_days_filter", """
SELECT event_id, ts, user_id FROM events
WHERE CAST(ts AS DATE) > DATE '2024-01-31' - 7 AND CAST(ts AS DATE) <= DATE '2024-01-31'""")

oracle("p12_cleanse_projection", """
SELECT event_id, lower(trim('  User' || CAST(user_id AS VARCHAR) || '@Example.COM ')) AS email, ts,
       CAST(value AS DECIMAL(12,2)) AS valor,
       sha256(lower(trim('  User' || CAST(user_id AS VARCHAR) || '@Example.COM '))) AS email_hash
FROM events WHERE event_id IS NOT NULL""")

oracle("r01_table_profile", """
SELECT 'orders' AS tabela, count(*) AS linhas, 6 AS colunas,
       CAST(sum((o_orderkey IS NULL)::INT + (o_custkey IS NULL)::INT + (o_orderstatus IS NULL)::INT
                + (o_totalprice IS NULL)::INT + (o_orderdate IS NULL)::INT + (o_orderpriority IS NULL)::INT)
            AS BIGINT) AS nulos
FROM orders
UNION ALL
SELECT 'events', count(*), 6,
       CAST(sum((event_id IS NULL)::INT + (ts IS NULL)::INT + (user_id IS NULL)::INT + (event_type IS NULL)::INT
                + (value IS NULL)::INT + (props IS NULL)::INT) AS BIGINT)
FROM events
UNION ALL
SELECT 'lineitem', count(*), 11,
       CAST(sum((l_orderkey IS NULL)::INT + (l_partkey IS NULL)::INT + (l_suppkey IS NULL)::INT
                + (l_linenumber IS NULL)::INT + (l_quantity IS NULL)::INT + (l_extendedprice IS NULL)::INT
                + (l_discount IS NULL)::INT + (l_tax IS NULL)::INT + (l_returnflag IS NULL)::INT
                + (l_linestatus IS NULL)::INT + (l_shipdate IS NULL)::INT) AS BIGINT)
FROM lineitem""")

oracle("u03_layer_counts", """
SELECT 'bronze' AS camada, count(*) AS linhas FROM market
UNION ALL SELECT 'silver', count(*) FROM fct
UNION ALL SELECT 'gold', count(*) FROM metricas_atleta""", "market", "fct", "metricas_atleta")

# ------------------------------------------------------------------ governance
_EMAIL = r"^[^@\s]+@[^@\s]+\.[A-Za-z]+$"
_PHONE = r"^\d{3}-\d{3,4}-\d{4}$"
_AUD = ("aud", """SELECT run_id, user_name, action_name, start_time FROM rn""")


def _tags() -> str:
    parts = []
    for tab, src, cols in (("clientes", "cu", ("name", "email", "phone", "region", "segment")),
                           ("eventos", "events", ("event_type",)),
                           ("auditoria", "aud", ("user_name", "action_name"))):
        for c in cols:
            for kind, pat in (("email", _EMAIL), ("phone", _PHONE)):
                parts.append(f"SELECT '{tab}' AS tabela, '{c}' AS coluna, 'pii' AS tag, '{kind}' AS valor "
                             f"FROM {src} HAVING max(CAST(regexp_matches({c}, '{pat}') AS INTEGER)) = 1")
    return "\nUNION ALL\n".join(parts)


oracle("g01_tagged_tables", "SELECT DISTINCT tabela FROM tags WHERE tag = 'pii' AND valor = 'email'",
       "cu", "rn", extra=[_AUD, ("tags", _tags())])
oracle("g01_mask_report", """
SELECT t.tabela, coalesce(c.n, 0) AS colunas_mascaradas
FROM (VALUES ('clientes'), ('eventos'), ('auditoria')) t(tabela)
LEFT JOIN (SELECT tabela, count(DISTINCT coluna) AS n FROM tags WHERE tag = 'pii' GROUP BY tabela) c
  ON t.tabela = c.tabela""", "cu", "rn", extra=[_AUD, ("tags", _tags())])

oracle("g02_erase_subject", """
SELECT 'clientes' AS tabela, 'customer_id' AS coluna,
       count(CASE WHEN customer_id = 7 THEN 1 END) AS linhas_afetadas,
       count(CASE WHEN customer_id <> 7 OR customer_id IS NULL THEN 1 END) AS linhas_mantidas,
       'WOULD_DELETE' AS acao FROM cu
UNION ALL
SELECT 'eventos', 'user_id', count(CASE WHEN user_id = 7 THEN 1 END),
       count(CASE WHEN user_id <> 7 OR user_id IS NULL THEN 1 END), 'WOULD_DELETE' FROM events""", "cu")

oracle("g03_retention", """
SELECT 'eventos' AS tabela, 'event_date' AS coluna_data, 1095 AS dias,
       count(CASE WHEN CAST(CAST(ts AS DATE) AS TIMESTAMP) < TIMESTAMP '2001-12-31' - INTERVAL 1095 DAYS THEN 1 END)
           AS linhas_expiradas,
       count(CASE WHEN NOT (CAST(CAST(ts AS DATE) AS TIMESTAMP) < TIMESTAMP '2001-12-31' - INTERVAL 1095 DAYS)
                  OR ts IS NULL THEN 1 END) AS linhas_mantidas
FROM events
UNION ALL
SELECT 'pedidos', 'order_date', 1095,
       count(CASE WHEN o_orderdate < TIMESTAMP '2001-12-31' - INTERVAL 1095 DAYS THEN 1 END),
       count(CASE WHEN NOT (o_orderdate < TIMESTAMP '2001-12-31' - INTERVAL 1095 DAYS) OR o_orderdate IS NULL
                  THEN 1 END)
FROM orders""")

oracle("g04_mask_columns", r"""
SELECT customer_id,
       concat(left(name, 1), repeat('*', greatest(length(name) - 1, 0))) AS name,
       concat(left(email, 1), '***@', split_part(email, '@', -1)) AS email,
       concat('***-***-', right(phone, 4)) AS phone,
       CAST(NULL AS DOUBLE) AS salary, region, segment,
       concat(substring(email, 1, 1), '***@***.', regexp_replace(email, '.*\.(\w+)$', '\1')) AS email2,
       regexp_replace(email, '(.).*@', '\1***@') AS email3,
       regexp_replace(phone, '(\d{3})-(\d{4})$', '***-****') AS phone2,
       sha256(CAST(customer_id AS VARCHAR) || '') AS id_hash,
       '[REDACTED]' AS segmento
FROM cu""", "cu")

oracle("g05_row_filter", """
SELECT customer_id, name, region FROM cu WHERE region IN ('ASIA')""", "cu")

oracle("g06_subject_export", """
SELECT 'clientes' AS tabela,
       '{"customer_id":' || CAST(customer_id AS VARCHAR) || ',"name":"' || name || '","email":"' || email
       || '","region":"' || region || '"}' AS dados
FROM cu WHERE customer_id = 7
UNION ALL
SELECT 'eventos', '{"event_id":' || CAST(event_id AS VARCHAR) || ',"user_id":' || CAST(user_id AS VARCHAR)
       || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","event_type":"' || event_type || '"}'
FROM events WHERE user_id = 7""", "cu")
