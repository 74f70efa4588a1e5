"""Oracle SQL for the streaming operators (batch twins and stream results)."""

from pitchlake.oracle.queries_sql import oracle

oracle("st1_bronze_stream", "SELECT event_id, ts, user_id, event_type, value FROM events", doubles=("value",))

oracle("st2_silver_stream", """
SELECT event_id, ts, user_id, lower(trim(event_type)) AS event_type, value FROM events
WHERE event_id IS NOT NULL AND coalesce(value > 0, FALSE)
  AND coalesce(event_type IN ('view', 'click', 'purchase', 'signup', 'error'), FALSE)""", doubles=("value",))

oracle("st3_stream_merge", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""", doubles=("value",))

oracle("st4_gold_stream", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS inicio, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS fim,
       count(*) AS eventos,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END), 2) AS receita,
       count(DISTINCT user_id) AS usuarios
FROM events GROUP BY time_bucket(INTERVAL 1 DAY, ts)""", doubles=("receita",))

oracle("st5_cadence_15min", """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS inicio,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS fim,
       count(*) AS capturas, arg_max(event_type, (ts, event_id)) AS ultimo_status
FROM events GROUP BY time_bucket(INTERVAL 15 MINUTE, ts)""")
