"""Queries: ops/business reports, join strategies and governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchlake.functions import expressions as X
from pitchlake.operators import governance as G
from pitchlake.operators import joins as J
from pitchlake.operators import registry as REG
from pitchlake.operators import reports as R
from pitchlake.operators.windows import run_anomalies
from pitchlake.plans.queries import query
from pitchlake.sources import bindings as B
from pitchlake.streaming.pipeline import scratch

RUNS_ASOF = "2024-01-31"
ORDERS_ASOF = "2001-12-31"
SUBJECT_ID = 7


def _runs(p):
    return B.job_runs(p.t)


def _orders_region(p):
    c = p.t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = p.t.nation.select("n_nationkey", "n_regionkey")
    r = p.t.region.select("r_regionkey", F.col("r_name").alias("region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey) \
        .select("o_custkey", "region")


# ------------------------------------------------------------------ runs / ops
@query("a17_run_health")
def _(p):
    return R.run_health(_runs(p), RUNS_ASOF, 24 * 7)


@query("a18_failure_rate_having")
def _(p):
    return R.failure_rate(_runs(p), 5.0)


@query("a19_alert_collect")
def _(p):
    return R.failure_alert(_runs(p), RUNS_ASOF, 24)


@query("a28_queue_stats")
def _(p):
    return R.queue_stats(_runs(p))


@query("a29_access_counts_having")
def _(p):
    return R.heavy_access(_runs(p), 15)


@query("a34_scan_volume")
def _(p):
    return R.scan_stats(_runs(p), RUNS_ASOF, 7)


@query("t03_best_version")
def _(p):
    return R.best_run(_runs(p), "job_id", "duration_minutes", "run_id")


@query("t05_slow_queries")
def _(p):
    return R.slow_queries(_runs(p), RUNS_ASOF, 100.0, 20, 24)


@query("p13_audit_predicates")
def _(p):
    return R.audit(_runs(p), RUNS_ASOF, 7, ["error", "view"], ["user1@example.com"], "%1%")


@query("w14_run_anomalies")
def _(p):
    return run_anomalies(_runs(p))


@query("l19_run_registry")
def _(p):
    """Runs as a long (run, metric, value) registry; best run per job and metric."""
    r = _runs(p)
    reg = r.select("job_id", "run_id", F.expr(
        "stack(3, 'duration_minutes', duration_minutes, 'bytes_read', CAST(bytes_read AS DOUBLE), "
        "'rows_read', CAST(rows_read AS DOUBLE)) as (metrica, valor)"))
    g = reg.groupBy("job_id", "metrica").agg(
        F.max_by(F.col("run_id"), F.struct(F.col("valor"), F.col("run_id"))).alias("melhor_run"),
        F.max("valor").alias("melhor_valor"), F.count(F.lit(1)).alias("execucoes"))
    return g


@query("l19_run_log")
def _(p):
    """Job runs logged (twice, as a retried job would) and their versions compared.

    A job's runs of one week are one version; each run logs three metrics.
    """
    runs = _runs(p).select(
        F.concat(F.lit("job-"), F.col("job_id").cast("string")).alias("model"),
        F.weekofyear("start_time").alias("version"), F.col("run_id").cast("string").alias("run_id"),
        F.col("start_time").cast("timestamp_ntz").alias("logged_at"), "duration_minutes", "bytes_read", "rows_read")
    rows = REG.long_metrics(runs, ["duration_minutes", "bytes_read", "rows_read"])
    base = f"{scratch(p.spark, 'l19')}/registry"
    REG.log_run(base, rows)
    return REG.compare_runs(REG.log_run(base, rows))


# ------------------------------------------------------------------ business
@query("a20_daily_metrics")
def _(p):
    return R.daily_metrics(p.t.orders, _orders_region(p))


@query("a21_generic_rollup")
def _(p):
    return R.aggregate_to_gold(p.t.events, ["event_type"],
                               {"eventos": "count(*)", "valor_total": "round(sum(value), 2)",
                                "usuarios": "count(distinct user_id)"}, grain="day", ts="ts")


@query("a22_daily_distinct")
def _(p):
    return R.daily_summary(p.t.events)


@query("a23_customer_features")
def _(p):
    return R.customer_features(p.t.orders, ORDERS_ASOF)


@query("a24_user_features")
def _(p):
    return R.user_features(p.t.events, RUNS_ASOF)


@query("a25_conditional_summary")
def _(p):
    return R.conditional_summary(p.t.orders)


@query("a26_sanity_profile")
def _(p):
    return R.sanity_profile(p.t.events, "event_id", "value", "ts")


@query("a27_cost_rollups")
def _(p):
    # Monday of the week, computed on the date itself (no time-zone round trip)
    u = B.usage(p.t, B.list_prices(p.t)).withColumn("semana", F.date_sub("usage_date", (F.dayofweek("usage_date") + 5) % 7))
    return R.cost_rollups(u)


@query("t01_top_n")
def _(p):
    c = R.cost_by(B.usage(p.t), B.list_prices(p.t), ["cluster_id"]).withColumn("custo", F.round("custo", 2))
    return R.top_n(c, "custo", 10, "cluster_id")


@query("j14_price_lookup_join")
def _(p):
    # quantity is summed per SKU before the price lookup: a hot SKU is combined
    # map-side instead of reaching the join as one skewed key
    q = B.usage(p.t).groupBy("sku_name").agg(F.sum("usage_quantity").alias("quantidade"))
    j = q.join(B.list_prices(p.t), "sku_name", "left")
    return j.select("sku_name", F.round(F.col("quantidade") * F.coalesce(F.col("price"), F.lit(0.0)), 2)
                    .alias("custo"), "quantidade")


@query("j15_four_way_run_cost")
def _(p):
    cost = R.cost_by(B.usage(p.t), B.list_prices(p.t), ["job_id"])   # pre-aggregated per job
    r = _runs(p).groupBy("job_id", "job_name").agg(
        F.countDistinct("run_id").alias("execucoes"), R.money_avg("duration_minutes").alias("minutos_medios"))
    return r.join(cost, "job_id", "left").select("job_id", "job_name", "execucoes", "minutos_medios",
                                                F.round(F.coalesce(F.col("custo"), F.lit(0.0)), 2).alias("custo"))


@query("j13_agg_then_left")
def _(p):
    return J.customer_summary(p.t.customer, p.t.orders)


@query("j16_size_based_broadcast")
def _(p):
    return J.smart_join(p.t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
                        p.t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
                        "o_custkey")


@query("j17_skew_join")
def _(p):
    ev = p.t.events.select("event_id", "user_id", "value")
    users = R.user_features(p.t.events, RUNS_ASOF).select("user_id", "eventos")
    return J.salted_join(ev, users, "user_id", rows_per_salt=100)


# ------------------------------------------------------------------ predicates / columns
@query("p09_tier_label")
def _(p):
    return p.t.orders.select("o_orderkey", X.tier_label(F.col("o_totalprice") / 100).alias("faixa"))


@query("p10_cents_to_units")
def _(p):
    return p.t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                               X.cents_to_units(F.col("l_extendedprice"), 2).alias("valor"))


@query("p11_recent_days_filter")
def _(p):
    return R.last_days(p.t.events, "ts", 7, RUNS_ASOF).select("event_id", "ts", "user_id")


@query("p12_cleanse_projection")
def _(p):
    ev = p.t.events.select("event_id", "ts", "value",
                           F.concat(F.lit("  User"), F.col("user_id").cast("string"),
                                    F.lit("@Example.COM ")).alias("email"))
    return R.clean(ev, "event_id", "email", "ts", "value")


# ------------------------------------------------------------------ profiles
@query("r01_table_profile")
def _(p):
    return R.profile_tables({"orders": p.t.orders, "events": p.t.events, "lineitem": p.t.lineitem})


@query("u03_layer_counts")
def _(p):
    return R.layer_counts({"bronze": p.raw_atletas_mercado, "silver": p.fct_atletas_rodada,
                           "gold": p.metricas_atleta})


# ------------------------------------------------------------------ governance
def _pii_tables(p):
    cu = B.customers_pii(p.t)
    ev = p.t.events.select("event_id", "user_id", "ts", "event_type", "value")
    runs = _runs(p).select("run_id", "user_name", "action_name", "start_time")
    return {"clientes": cu, "eventos": ev, "auditoria": runs}


@query("g01_tagged_tables")
def _(p):
    return G.by_tag(G.discover_tags(_pii_tables(p)), "pii", "email")


@query("g01_mask_report")
def _(p):
    tabs = _pii_tables(p)
    names = p.spark.createDataFrame([(n,) for n in tabs], "tabela string")
    return G.mask_report(names, G.discover_tags(tabs))


@query("g02_erase_subject")
def _(p):
    tabs = {"clientes": B.customers_pii(p.t),
            "eventos": p.t.events.select("event_id", "user_id", "ts")}
    audit, _ = G.erase_subject(tabs, SUBJECT_ID, dry_run=True)
    return audit


@query("g03_retention")
def _(p):
    ev = p.t.events.select("event_id", F.to_date("ts").alias("event_date"))
    o = p.t.orders.select("o_orderkey", F.col("o_orderdate").alias("order_date"))
    report, _ = G.retention({"eventos": ev, "pedidos": o}, 365 * 3, ORDERS_ASOF)
    return report


@query("g04_mask_columns")
def _(p):
    cu = B.customers_pii(p.t)
    cu = cu.withColumn("email2", F.col("email")).withColumn("email3", F.col("email")) \
        .withColumn("phone2", F.col("phone")).withColumn("id_hash", F.col("customer_id")) \
        .withColumn("segmento", F.col("segment"))
    return G.mask_columns(cu, {"email": "email", "email2": "email_tld", "email3": "email_local",
                               "phone": "phone", "phone2": "phone_tail", "name": "name",
                               "id_hash": "hash", "segmento": "redact", "salary": "null"})


@query("g05_row_filter")
def _(p):
    regions = p.t.region.select(F.concat(F.lit("analyst_"), F.lower("r_name")).alias("usuario"),
                                F.col("r_name").alias("regiao"))
    return G.row_filter(B.customers_pii(p.t), regions, "analyst_asia", is_admin=False) \
        .select("customer_id", "name", "region")


@query("g06_subject_export")
def _(p):
    tabs = {"clientes": B.customers_pii(p.t).select("customer_id", "name", "email", "region"),
            "eventos": p.t.events.select("event_id", "user_id", "ts", "event_type")}
    return G.export_subject(tabs, SUBJECT_ID)
