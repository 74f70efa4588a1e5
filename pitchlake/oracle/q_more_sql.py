"""Oracle SQL for pitchlake.plans.q_more."""

from pitchlake.oracle.queries_sql import oracle

ORD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

oracle("m01_merge_upsert", f"""
SELECT {ORD} FROM or_source
UNION ALL
SELECT {ORD} FROM or_target t WHERE NOT EXISTS (SELECT 1 FROM or_source s WHERE s.o_orderkey = t.o_orderkey)""",
       "or_source", "or_target", doubles=("o_totalprice",))

oracle("m02_merge_insert_only", f"""
SELECT {ORD} FROM or_target
UNION ALL
SELECT {ORD} FROM or_source s WHERE NOT EXISTS (SELECT 1 FROM or_target t WHERE s.o_orderkey = t.o_orderkey)""",
       "or_source", "or_target", doubles=("o_totalprice",))

oracle("m03_incremental_model", """
SELECT * FROM fct""", "fct",
       doubles=("pontos_num", "media_num", "preco_num", "variacao_num"))

oracle("m04_merge_selected_columns", f"""
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderdate, t.o_orderpriority
FROM or_target t LEFT JOIN or_source s ON t.o_orderkey = s.o_orderkey
UNION ALL
SELECT {ORD} FROM or_source s WHERE NOT EXISTS (SELECT 1 FROM or_target t WHERE s.o_orderkey = t.o_orderkey)""",
       "or_source", "or_target", doubles=("o_totalprice",))

oracle("m05_delete_insert", f"""
SELECT {ORD} FROM or_target t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM or_source)
UNION ALL
SELECT {ORD} FROM or_source""", "or_source", "or_target", doubles=("o_totalprice",))

oracle("m06_insert_overwrite", """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 2 THEN value + 1.0 ELSE value END
           AS value,
       props, CAST(ts AS DATE) AS event_date
FROM events""", doubles=("value",))

_SCD_BUILD = """
SELECT key_id, capture_seq, status, priority, captured_at AS valid_from,
       lead(captured_at) OVER (PARTITION BY key_id ORDER BY captured_at, capture_seq) AS valid_to,
       lead(captured_at) OVER (PARTITION BY key_id ORDER BY captured_at, capture_seq) IS NULL AS is_current
FROM (SELECT *, lag(status) OVER w AS ps, lag(priority) OVER w AS pp, row_number() OVER w AS rn
      FROM {src} WINDOW w AS (PARTITION BY key_id ORDER BY captured_at, capture_seq))
WHERE rn = 1 OR status IS DISTINCT FROM ps OR priority IS DISTINCT FROM pp"""

oracle("m08_scd2_from_history", _SCD_BUILD.format(src="px"), "px")

oracle("m07_scd2_check", """
SELECT key_id, capture_seq, status, priority, valid_from, valid_to, is_current FROM m07_snap WHERE NOT is_current
UNION ALL
SELECT ck, c_seq, c_status, c_priority, c_from,
       CASE WHEN chg THEN TIMESTAMP '2001-12-31' END, NOT chg FROM m07_j WHERE ck IS NOT NULL
UNION ALL
SELECT nk, n_seq, n_status, n_priority, TIMESTAMP '2001-12-31', CAST(NULL AS TIMESTAMP), TRUE
FROM m07_j WHERE ck IS NULL OR chg""", "px", extra=[
    ("m07_snap", _SCD_BUILD.format(src="(SELECT * FROM px WHERE captured_at < TIMESTAMP '1999-01-01')")),
    ("m07_latest", """SELECT key_id, capture_seq, status, priority FROM px
        QUALIFY row_number() OVER (PARTITION BY key_id ORDER BY captured_at DESC, capture_seq DESC) = 1"""),
    ("m07_j", """SELECT c.key_id AS ck, c.capture_seq AS c_seq, c.status AS c_status, c.priority AS c_priority,
                        c.valid_from AS c_from, n.key_id AS nk, n.capture_seq AS n_seq, n.status AS n_status,
                        n.priority AS n_priority,
                        (c.key_id IS NOT NULL AND n.key_id IS NOT NULL
                         AND (c.status IS DISTINCT FROM n.status OR c.priority IS DISTINCT FROM n.priority)) AS chg
                 FROM (SELECT * FROM m07_snap WHERE is_current) c
                 FULL OUTER JOIN m07_latest n ON c.key_id = n.key_id""")])

oracle("m09_change_feed", """
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_custkey ELSE n.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderdate ELSE n.o_orderdate END AS o_orderdate,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderpriority ELSE n.o_orderpriority END AS o_orderpriority,
       CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete'
            ELSE 'update_postimage' END AS _change_type
FROM or_target o FULL OUTER JOIN or_source n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
   OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
   OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderdate IS DISTINCT FROM n.o_orderdate
   OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority""", "or_target", "or_source",
       doubles=("o_totalprice",))

oracle("m11_merge_source_guard", """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS dia
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
       doubles=("value",))

oracle("m11_duplicate_source_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS qtd FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")

oracle("st6_late_data", "SELECT atleta_id, rodada_id, pontos_num FROM fct", "fct", doubles=("pontos_num",))

oracle("q01_not_null", "SELECT partida_id, rodada_id FROM fct_partidas_prox WHERE placar_mandante IS NULL",
       "fct_partidas_prox")
oracle("q02_unique", "SELECT o_custkey, count(*) AS qtd FROM orders GROUP BY o_custkey HAVING count(*) > 1")
oracle("q03_accepted_values", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""")
oracle("q04_relationships", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IS NOT NULL
  AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
oracle("q05_expression_true", """
SELECT * FROM tabela
WHERE NOT coalesce(aproveitamento_percentual >= 0 AND aproveitamento_percentual <= 100, FALSE)""",
       "tabela", doubles=("aproveitamento_percentual",))
oracle("q06_composite_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS qtd FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
oracle("q07_range_check", "SELECT DISTINCT rodada_id FROM fct WHERE rodada_id < 1 OR rodada_id > 38", "fct")
oracle("q08_non_negative", """
SELECT partida_id, rodada_id, placar_mandante, placar_visitante FROM fct_partidas
WHERE (placar_mandante IS NOT NULL AND placar_mandante < 0)
   OR (placar_visitante IS NOT NULL AND placar_visitante < 0)""", "fct_partidas")

_RULES = (("valor_positivo", "value > 0"),
          ("tipo_conhecido", "event_type IN ('view', 'click', 'purchase', 'signup')"),
          ("valor_plausivel", "value < 400"))
oracle("q09_expect_or_drop", " UNION ALL ".join(
    f"SELECT '{n}' AS regra, CAST(sum(CASE WHEN coalesce({r}, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS descartadas "
    f"FROM events" for n, r in _RULES))
oracle("q09_expect_or_drop_kept", "SELECT event_id, user_id, event_type, value FROM events WHERE "
       + " AND ".join(f"coalesce({r}, FALSE)" for _, r in _RULES), doubles=("value",))

oracle("q10_freshness_recency", """
SELECT max_ts, idade_horas, linhas_recentes,
       CASE WHEN idade_horas > 24 THEN 'error' WHEN idade_horas > 12 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(ts) AS max_ts,
             (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9 AS idade_horas,
             CAST(sum(CASE WHEN ts >= TIMESTAMP '2024-01-31' - INTERVAL 12 HOURS THEN 1 ELSE 0 END) AS BIGINT)
                 AS linhas_recentes
      FROM events)""", doubles=("idade_horas",))

oracle("q11_suite_runner", """
SELECT 'not_null_o_orderkey' AS regra, CAST(sum(CASE WHEN o_orderkey IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS falhas FROM orders
UNION ALL SELECT 'accepted_o_orderstatus', CAST(sum(CASE WHEN coalesce(o_orderstatus IN ('F', 'O', 'P'), FALSE) THEN 0 ELSE 1 END) AS BIGINT) FROM orders
UNION ALL SELECT 'non_negative_o_totalprice', CAST(sum(CASE WHEN coalesce(o_totalprice >= 0, FALSE) THEN 0 ELSE 1 END) AS BIGINT) FROM orders
UNION ALL SELECT 'accepted_o_orderpriority', CAST(sum(CASE WHEN coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'), FALSE) THEN 0 ELSE 1 END) AS BIGINT) FROM orders
UNION ALL SELECT 'unique_o_orderkey', CAST(coalesce(sum(q), 0) AS BIGINT) FROM (SELECT count(*) AS q FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'relationships_o_custkey', count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)""")

oracle("q12_validate_copy", """
SELECT n AS linhas_origem, n AS linhas_copia, TRUE AS colunas_iguais, TRUE AS contagem_igual, TRUE AS conteudo_igual,
       h AS hash_origem, h AS hash_copia
FROM (SELECT count(*) AS n, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
             o_orderstatus, o_orderpriority)), 1, 8) AS BIGINT)) AS BIGINT) AS h FROM orders)""")

oracle("j18_orphan_anti", """
SELECT l_orderkey, count(*) AS linhas_orfas FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
GROUP BY l_orderkey""")


oracle("m08_price_snapshot", """
SELECT atleta_id, _rodada_captura, preco_num, clube_id, status_id, posicao_id, media_num, variacao_num, ts AS valid_from,
       lead(ts) OVER k AS valid_to, lead(ts) OVER k IS NULL AS is_current
FROM (SELECT *, rodada_id AS _rodada_captura, _ingestao_timestamp AS ts, lag(rodada_id) OVER w IS NULL OR preco_num IS DISTINCT FROM lag(preco_num) OVER w
             OR clube_id IS DISTINCT FROM lag(clube_id) OVER w OR status_id IS DISTINCT FROM lag(status_id) OVER w AS changed
      FROM ar WINDOW w AS (PARTITION BY atleta_id ORDER BY _ingestao_timestamp, rodada_id))
WHERE changed WINDOW k AS (PARTITION BY atleta_id ORDER BY ts, _rodada_captura)""", "ar", doubles=("preco_num", "media_num", "variacao_num"))
