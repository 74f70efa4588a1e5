"""Operational and business reports (run health, costs, features, profiles).

All of them are single-pass aggregates with conditional sums; joins to
small lookup tables happen after pre-aggregation so they never fan out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _asof(asof: str) -> Column:
    return F.lit(asof).cast("timestamp_ntz")


def money_sum(c: str) -> Column:
    """Sum of 2-decimal amounts, exact: rounding removes the float noise that
    depends on the order a distributed sum adds its terms."""
    return F.round(F.sum(c), 2)


def money_avg(c: str) -> Column:
    return money_sum(c) / F.count(c)


def _minutes(start: str, end: str) -> Column:
    """Whole minutes between two wall-clock timestamps (no time-zone shifts)."""
    from pitchlake.functions.expressions import ntz_epoch_micros
    return F.floor((ntz_epoch_micros(F.col(end)) - ntz_epoch_micros(F.col(start))) / 60000000)


def run_health(runs: DataFrame, asof: str, hours: int) -> DataFrame:
    """Per job, runs by state, success rate % and mean minutes in the
    last ``hours`` before ``asof``."""
    a = _asof(asof)
    r = runs.filter((F.col("start_time") >= a - F.expr(f"INTERVAL {hours} HOURS"))
                    & (F.col("start_time") < a))
    s = F.col("result_state")
    g = r.groupBy("job_id", "job_name").agg(
        F.count(F.lit(1)).alias("execucoes"),
        F.count(F.when(s == "SUCCESS", 1)).alias("sucessos"),
        F.count(F.when(s == "FAILED", 1)).alias("falhas"),
        F.count(F.when(s == "TIMED_OUT", 1)).alias("timeouts"),
        F.avg(_minutes("start_time", "end_time")).alias("minutos_medios"))
    return g.withColumn("taxa_sucesso", F.round(F.col("sucessos") * 100.0 / F.col("execucoes"), 2))


def failure_rate(runs: DataFrame, min_pct: float = 5.0) -> DataFrame:
    """Failures / runs per job, kept when the rate exceeds ``min_pct``."""
    g = runs.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("execucoes"),
        F.count(F.when(F.col("result_state") == "FAILED", 1)).alias("falhas"))
    g = g.withColumn("taxa_falha", F.round(F.col("falhas") * 100.0 / F.col("execucoes"), 2))
    return g.filter(F.col("taxa_falha") > min_pct)


def failure_alert(runs: DataFrame, asof: str, hours: int = 24) -> DataFrame:
    """Failures in the window and the sorted distinct list of failed jobs
    (bounded by the number of jobs)."""
    a = _asof(asof)
    f = runs.filter((F.col("result_state") == "FAILED")
                    & (F.col("start_time") >= a - F.expr(f"INTERVAL {hours} HOURS"))
                    & (F.col("start_time") < a))
    return f.agg(F.count(F.lit(1)).alias("falhas"),
                 F.sort_array(F.collect_set("job_name")).alias("jobs_com_falha"))


def daily_metrics(orders: DataFrame, region: DataFrame) -> DataFrame:
    """Orders per day and region: count, sum and mean amount.

    Orders are first aggregated per (day, customer) -- combined map-side, so
    a customer with a third of all orders never reaches the join as a hot
    key -- then joined to the customer's region and rolled up.
    """
    from pitchlake.functions.expressions import ntz_day
    day = ntz_day(F.col("o_orderdate"))          # wall-clock day (date_trunc would go through the session zone)
    pre = orders.groupBy(day.alias("dia"), "o_custkey").agg(
        F.count(F.lit(1)).alias("_n"), F.round(F.sum("o_totalprice"), 2).alias("_s"))
    g = pre.join(region, "o_custkey").groupBy("dia", "region").agg(
        F.sum("_n").alias("pedidos"), F.round(F.sum("_s"), 2).alias("receita"))
    return g.withColumn("ticket_medio", F.col("receita") / F.col("pedidos"))


def aggregate_to_gold(df: DataFrame, groups: list[str], aggs: dict[str, str],
                      grain: str | None = None, ts: str | None = None) -> DataFrame:
    """Generic roll-up: group columns (+ time grain) and named SQL
    aggregate expressions (parsed by Spark's ``expr``; no Python eval)."""
    keys = [F.col(g) for g in groups]
    if grain and ts:
        from pitchlake.functions.expressions import ntz_day
        b = ntz_day(F.col(ts)) if grain == "day" else F.date_trunc(grain, F.col(ts)).cast("timestamp_ntz")
        keys = [b.alias(f"{grain}_bucket")] + keys
    return df.groupBy(*keys).agg(*[F.expr(e).alias(name) for name, e in aggs.items()])


def daily_summary(events: DataFrame) -> DataFrame:
    """Per day: events, purchase revenue and distinct users."""
    return events.groupBy(F.to_date("ts").alias("dia")).agg(
        F.count(F.lit(1)).alias("eventos"),
        F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)), 2)
         .alias("receita"),
        F.countDistinct("user_id").alias("usuarios"))


def customer_features(orders: DataFrame, asof: str) -> DataFrame:
    """Order count, mean, total, first/last date, recency and tenure days."""
    a = F.to_date(F.lit(asof))
    g = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("pedidos"), money_avg("o_totalprice").alias("ticket_medio"),
        money_sum("o_totalprice").alias("valor_total"),
        F.min("o_orderdate").alias("primeiro_pedido"), F.max("o_orderdate").alias("ultimo_pedido"))
    return g.select("*", F.datediff(a, F.to_date("ultimo_pedido")).alias("recencia_dias"),
                    F.datediff(a, F.to_date("primeiro_pedido")).alias("tempo_cliente_dias"))


def user_features(events: DataFrame, asof: str) -> DataFrame:
    """Per user: events, mean value, last event, distinct types, days since."""
    g = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("eventos"), money_avg("value").alias("valor_medio"),
        F.max("ts").alias("ultimo_evento"), F.countDistinct("event_type").alias("tipos_distintos"))
    return g.withColumn("dias_desde_ultimo", F.datediff(F.to_date(F.lit(asof)), F.to_date("ultimo_evento")))


def conditional_summary(orders: DataFrame) -> DataFrame:
    """Per customer: orders, finished orders, finished amount, first/last date."""
    fin = F.col("o_orderstatus") == "F"
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("pedidos"),
        F.count(F.when(fin, 1)).alias("pedidos_finalizados"),
        F.round(F.sum(F.when(fin, F.col("o_totalprice")).otherwise(0.0)), 2).alias("valor_finalizado"),
        F.min("o_orderdate").alias("primeiro_pedido"), F.max("o_orderdate").alias("ultimo_pedido"))


def sanity_profile(df: DataFrame, id_col: str, amount: str, ts: str) -> DataFrame:
    """Rows, distinct ids, NULL amounts, first and last timestamp."""
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.countDistinct(id_col).alias("ids_distintos"),
                  F.count(F.when(F.col(amount).isNull(), 1)).alias("valores_nulos"),
                  F.min(ts).alias("primeiro"), F.max(ts).alias("ultimo"))


def usage_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """J14 building block: usage rows with their list price and cost."""
    return usage.join(prices, "sku_name", "left").withColumn(
        "custo", F.col("usage_quantity") * F.coalesce(F.col("price"), F.lit(0.0)))


def cost_by(usage: DataFrame, prices: DataFrame, dims: list[str]) -> DataFrame:
    """Total cost by the given dimensions.

    Usage is pre-aggregated to (sku, dims) before the price join, so the
    join sees one row per group instead of every usage record.
    """
    pre = usage.groupBy(*dict.fromkeys(["sku_name", *dims])).agg(F.sum("usage_quantity").alias("_q"))
    j = pre.join(prices, "sku_name", "left")
    return j.groupBy(*dims).agg(
        F.sum(F.col("_q") * F.coalesce(F.col("price"), F.lit(0.0))).alias("custo"))


def cost_rollups(usage: DataFrame) -> DataFrame:
    """Cost by cluster, by team and by week and SKU, from one pass over priced usage records.

    A record is priced where it is read and counts in three groups at once, so
    tasks hold the roll-ups' own groups (clusters, teams, weeks x SKUs) and
    never the records' finest grain, which grows with the records.
    """
    cost = F.col("usage_quantity") * F.coalesce(F.col("price"), F.lit(0.0))
    dims = ("cluster_id", "team", "semana", "sku_name")
    sums = usage.select(*dims, cost.alias("custo")).groupingSets(
        [["cluster_id"], ["team"], ["semana", "sku_name"]], *dims).agg(
        F.grouping("cluster_id").alias("_c"), F.grouping("team").alias("_t"), F.sum("custo").alias("custo"))
    dimension = F.when(F.col("_c") == 0, "cluster").when(F.col("_t") == 0, "time").otherwise("semana_sku")
    key = (F.when(F.col("_c") == 0, F.col("cluster_id").cast("string")).when(F.col("_t") == 0, F.col("team"))
           .otherwise(F.concat(F.col("semana").cast("string"), F.lit("|"), F.col("sku_name"))))
    # groups whose key is null (no week, or no SKU) are one row
    return (sums.select(dimension.alias("dimensao"), key.alias("chave"), "custo").groupBy("dimensao", "chave")
            .agg(F.round(F.sum("custo"), 2).alias("custo")))


def queue_stats(runs: DataFrame) -> DataFrame:
    """Per warehouse: queries, mean and max duration."""
    return runs.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("consultas"), money_avg("duration_minutes").alias("duracao_media"),
        F.max("duration_minutes").alias("duracao_max"))


def heavy_access(log: DataFrame, n: int) -> DataFrame:
    """(user, action) pairs with more than ``n`` events."""
    return log.groupBy("user_name", "action_name").agg(F.count(F.lit(1)).alias("acessos")) \
        .filter(F.col("acessos") > n)


def scan_stats(q: DataFrame, asof: str, days: int = 7) -> DataFrame:
    """Bytes, rows and queries per table over the last ``days``, largest first."""
    a = _asof(asof)
    r = q.filter((F.col("start_time") >= a - F.expr(f"INTERVAL {days} DAYS")) & (F.col("start_time") < a))
    return r.groupBy("table_name").agg(
        F.sum("bytes_read").alias("bytes_lidos"), F.sum("rows_read").alias("linhas_lidas"),
        F.count(F.lit(1)).alias("consultas"))


def top_n(df: DataFrame, metric: str, n: int, tie: str) -> DataFrame:
    """ORDER BY metric DESC LIMIT n with a tie-break (TakeOrderedAndProject)."""
    return df.orderBy(F.col(metric).desc(), F.col(tie)).limit(n)


def best_run(runs: DataFrame, group: str, metric: str, tie: str) -> DataFrame:
    """The row with the highest metric per group (max_by, combined map-side)."""
    g = runs.groupBy(group).agg(F.max_by(F.struct(F.col(tie), F.col(metric)),
                                         F.struct(F.col(metric), F.col(tie))).alias("_b"))
    return g.select(group, F.col(f"_b.{tie}").alias(tie), F.col(f"_b.{metric}").alias(metric))


def slow_queries(q: DataFrame, asof: str, min_minutes: float, n: int, hours: int = 24) -> DataFrame:
    """Runs above a duration threshold in the last ``hours``, top ``n``."""
    a = _asof(asof)
    r = q.filter((F.col("duration_minutes") > min_minutes)
                 & (F.col("start_time") >= a - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("start_time") < a))
    return r.orderBy(F.col("duration_minutes").desc(), F.col("run_id")).limit(n) \
        .select("run_id", "job_name", "user_name", "duration_minutes", "start_time")


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and NULL cells per table (one aggregate per table)."""
    out = None
    for name, df in tables.items():
        nulls = None
        for c in df.columns:
            x = F.sum(F.when(F.col(c).isNull(), 1).otherwise(0))
            nulls = x if nulls is None else nulls + x
        a = df.agg(F.count(F.lit(1)).alias("linhas"), nulls.cast("long").alias("nulos")).select(
            F.lit(name).alias("tabela"), "linhas", F.lit(len(df.columns)).alias("colunas"), "nulos")
        out = a if out is None else out.unionByName(a)
    return out


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """('layer', count) rows, one aggregate per table, UNION ALL."""
    out = None
    for name, df in layers.items():
        a = df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("camada"), "linhas")
        out = a if out is None else out.unionByName(a)
    return out


def audit(log: DataFrame, asof: str, days: int, actions, exclude_users, like: str) -> DataFrame:
    """Audit-log predicates: IN, NOT IN, LIKE, != and a relative window."""
    a = _asof(asof)
    return log.filter(F.col("action_name").isin(list(actions))
                      & ~F.col("user_name").isin(list(exclude_users))
                      & F.col("user_name").like(like)
                      & (F.col("result_state") != "SUCCESS")
                      & (F.col("start_time") >= a - F.expr(f"INTERVAL {days} DAYS"))) \
        .select("run_id", "user_name", "action_name", "result_state", "start_time")


def last_days(df: DataFrame, col: str, n: int, asof: str) -> DataFrame:
    """Rows of the last ``n`` days before ``asof`` (inclusive of asof day)."""
    a = F.to_date(F.lit(asof))
    return df.filter((F.to_date(F.col(col)) > F.date_sub(a, n)) & (F.to_date(F.col(col)) <= a))


def clean(df: DataFrame, key: str, email: str, ts: str, amount: str) -> DataFrame:
    """trim/lower e-mail, typed timestamp, decimal amount, e-mail hash,
    NULL keys dropped, one row per key (newest timestamp, then highest key)."""
    from pitchlake.operators.windows import latest_per_key
    c = df.filter(F.col(key).isNotNull()).select(
        F.col(key), F.lower(F.trim(F.col(email))).alias("email"),
        F.to_timestamp_ntz(F.col(ts).cast("string")).alias("ts"),
        F.col(amount).cast("decimal(12,2)").alias("valor"))
    c = c.withColumn("email_hash", F.sha2(F.col("email"), 256))
    return latest_per_key(c, [key], ["ts"])
