"""Window-based operators (latest row per key, islands, gaps, rolling frames)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys, order, newest: bool = True) -> DataFrame:
    """The newest (or oldest) row of each key.

    Same result as ``row_number() over (partition by keys order by ...) = 1``
    (Spark has no QUALIFY), but written as a ``max_by`` / ``min_by``
    aggregate over the row struct: it is combined map-side, so a key that
    holds a third of the rows is reduced inside every input task instead of
    being sorted in one.  ``order`` lists the ordering columns, most
    significant first, and must end in a tie-break so the pick is
    deterministic.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    row = F.struct(*[F.col(c) for c in others])
    pick = F.max_by(row, by) if newest else F.min_by(row, by)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


#: Rows of one key that a window takes before the key is split into more time slices.
ROWS_PER_SLICE = 1_000_000


def time_slices(df: DataFrame, key: str, ts: str, rows_per_slice: int = ROWS_PER_SLICE,
                name: str = "_slice") -> DataFrame:
    """Add a slice number per row, rising with ``ts`` inside each key.

    A key gets as many slices of its own time span as its number of rows asks
    for, so a key with a third of all rows is spread over many tasks at any
    size; small keys stay whole.  The counts are one aggregate with map-side
    sums, joined back on the key.
    """
    from pitchlake.functions.expressions import ntz_epoch_micros
    at = ntz_epoch_micros(F.col(ts).cast("timestamp_ntz")).cast("double")
    stats = df.groupBy(F.col(key).alias("_sk")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_slice)).alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    share = (at - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1)
    return (df.join(stats, df[key].eqNullSafe(stats["_sk"]), "left")
            .withColumn(name, F.coalesce(F.floor(share * F.col("_n")), F.lit(-1))).drop("_sk", "_n", "_lo", "_hi"))


#: Cut points that a group's values may be split at (its rows decide how many are used).
MAX_SLICES = 1024


def rank_in_groups(df: DataFrame, groups: list[str], value: str, name: str, values_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``rank()`` of ``value`` (largest first, null last) in each group, without a window over a group.

    Equal values of a group are counted first, map-side, so a value with very
    many rows is one.  The distinct values of a large group are split at
    approximate quantiles into slices of about ``values_per_slice``; a window
    adds up the counts inside a slice, a second one over the slices' sums.  A
    value's rank is one more than the rows above it, so ties across an edge
    cannot differ.  Ranks are joined back on group and value; a hot value is
    split by the join.  Results do not depend on the slicing.
    """
    v = F.col(value)
    rows = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    sizes = rows.groupBy(*groups).agg(
        F.least(F.ceil(F.count(F.lit(1)) / F.lit(values_per_slice)), F.lit(MAX_SLICES)).cast("int").alias("_k"),
        F.percentile_approx(v.cast("double"), [i / MAX_SLICES for i in range(1, MAX_SLICES)], MAX_SLICES * 10).alias("_cuts"))
    sizes = sizes.filter("_k > 1").select(*groups, F.transform(
        F.sequence(F.lit(1), F.col("_k") - 1), lambda i: F.get("_cuts", (i * MAX_SLICES / F.col("_k")).cast("int") - 1)).alias("_cuts"))
    a, b = rows.alias("a"), sizes.alias("b")
    rows = a.join(b, [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups], "left").select(
        *[F.col(f"a.{g}").alias(g) for g in groups], F.col(f"a.{value}").alias(value), "_n",
        F.when(v.isNull(), F.lit(MAX_SLICES)).otherwise(
            F.coalesce(F.size(F.filter("_cuts", lambda c: c > v.cast("double"))), F.lit(0))).alias("_slice"))
    inside = Window.partitionBy(*groups, "_slice").orderBy(v.desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*groups, "_slice").agg(F.sum("_n").alias("_s"))
    sums = sums.select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_slice").alias("_g_slice"), F.sum("_s").over(above).alias("_above"))
    ranked = rows.withColumn("_in", F.sum("_n").over(inside))
    ranked = ranked.join(sums, [*[F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups], F.col("_slice") == F.col("_g_slice")]).select(
        *[F.col(g).alias(f"_r_{g}") for g in groups], F.col(value).alias("_r_value"),
        (F.coalesce("_in", F.lit(0)) + F.coalesce("_above", F.lit(0)) + 1).cast("int").alias(name))
    back = [*[df[g].eqNullSafe(ranked[f"_r_{g}"]) for g in groups], df[value].eqNullSafe(ranked["_r_value"])]
    return df.join(ranked, back).select(*df.columns, name)


def previous_in_sequence(df: DataFrame, key: str, order: list[str], cols: list[str],
                         bucket: Column) -> DataFrame:
    """``lag`` of ``cols`` per key in ``order``, without one task per key.

    Rows are windowed per (key, bucket) where ``bucket`` is a coarse,
    order-monotonic slice of the ordering (e.g. the day of a timestamp).
    The first row of a bucket takes the last row of the key's previous
    non-empty bucket from a one-row-per-bucket summary, so only that small
    summary is windowed per key.  Adds ``_prev_<col>`` for every column.
    """
    st = F.struct(*[F.col(c) for c in cols])
    h = df.withColumn("_b", bucket)
    wb = Window.partitionBy(key, "_b").orderBy(*order)
    h = h.select("*", F.lag(st).over(wb).alias("_pin"), F.row_number().over(wb).alias("_rn"))
    last = h.groupBy(key, "_b").agg(F.max_by(st, F.struct(*order)).alias("_last"))
    last = last.select(key, "_b", F.lag("_last").over(Window.partitionBy(key).orderBy("_b")).alias("_pb"))
    h = h.join(last, [key, "_b"], "left")
    prev = F.when(F.col("_rn") == 1, F.col("_pb")).otherwise(F.col("_pin"))
    return h.select(*df.columns, *[prev[c].alias(f"_prev_{c}") for c in cols])


def rest_days(df: DataFrame, key: str, ts: str, tie: str, bucket: Column | None = None) -> DataFrame:
    """Days since the previous event of the same key (NULL for the first)."""
    if bucket is None:
        df, bucket = time_slices(df, key, ts), F.col("_slice")
    x = previous_in_sequence(df, key, [ts, tie], [ts], bucket)
    return x.withColumn("dias_desde_ultimo", F.datediff(F.col(ts), F.col(f"_prev_{ts}"))) \
        .drop(f"_prev_{ts}", "_slice")


def run_anomalies(runs: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Runs inside a streak of >= 3 consecutive failures of the same job,
    and runs longer than twice their job's average duration.

    A failed run is in a streak of length >= 3 exactly when one of the three
    3-run windows around it (i-2..i, i-1..i+1, i..i+2) is all failures, so
    only the two neighbours on each side are needed.  They come from a window
    per (job, time slice), where a job has as many slices as its runs ask for;
    the first/last two runs of a slice take their neighbours from the adjacent
    slices' edge rows (at most 2 per slice, windowed per job over slices).
    """
    if bucket is None:
        runs, bucket = time_slices(runs, "job_id", "start_time"), F.col("_slice")
    b = bucket
    failed = (F.col("result_state") == "FAILED").cast("int")
    x = runs.select("job_id", "run_id", "start_time", "result_state", "duration_minutes",
                    failed.alias("_f"), b.alias("_b"))
    w = Window.partitionBy("job_id", "_b").orderBy("start_time", "run_id")
    x = x.select("*", F.lag("_f", 1).over(w).alias("_l1"), F.lag("_f", 2).over(w).alias("_l2"),
                 F.lead("_f", 1).over(w).alias("_d1"), F.lead("_f", 2).over(w).alias("_d2"),
                 F.row_number().over(w).alias("_i"),
                 F.count(F.lit(1)).over(Window.partitionBy("job_id", "_b")).alias("_n"))
    # edge rows of each day: first two and last two flags (<= 4 rows per group)
    edge = (x.filter((F.col("_i") <= 2) | (F.col("_i") > F.col("_n") - 2))
            .groupBy("job_id", "_b")
            .agg(F.array_sort(F.collect_list(F.struct("_i", "_f", "_n"))).alias("_e")))
    edge = edge.select("job_id", "_b",
                       F.transform(F.filter("_e", lambda e: e["_i"] <= 2), lambda e: e["_f"]).alias("_head"),
                       F.transform(F.filter("_e", lambda e: e["_i"] > e["_n"] - 2), lambda e: e["_f"])
                       .alias("_tail"))
    wd = Window.partitionBy("job_id").orderBy("_b")
    edge = edge.select("job_id", "_b",
                       F.flatten(F.collect_list("_tail").over(wd.rowsBetween(-2, -1))).alias("_prev"),
                       F.flatten(F.collect_list("_head").over(wd.rowsBetween(1, 2))).alias("_next"))
    x = x.join(edge, ["job_id", "_b"], "left")
    p1, p2 = F.try_element_at("_prev", F.lit(-1)), F.try_element_at("_prev", F.lit(-2))
    n1, n2 = F.try_element_at("_next", F.lit(1)), F.try_element_at("_next", F.lit(2))
    i, n = F.col("_i"), F.col("_n")
    l1 = F.when(i >= 2, F.col("_l1")).otherwise(p1)
    l2 = F.when(i >= 3, F.col("_l2")).when(i == 2, p1).otherwise(p2)
    d1 = F.when(i <= n - 1, F.col("_d1")).otherwise(n1)
    d2 = F.when(i <= n - 2, F.col("_d2")).when(i == n - 1, n1).otherwise(n2)

    def one(c):
        return F.coalesce(c, F.lit(0)) == 1
    streak = (F.col("_f") == 1) & ((one(l2) & one(l1)) | (one(l1) & one(d1)) | (one(d1) & one(d2)))
    avg = runs.groupBy("job_id").agg(F.avg("duration_minutes").alias("_avg"))
    x = x.join(avg, "job_id")
    return x.select(
        "job_id", "run_id", "start_time", "result_state", "duration_minutes",
        streak.alias("in_failure_streak"),
        (F.col("duration_minutes") > 2 * F.col("_avg")).alias("long_run"),
    ).filter(F.col("in_failure_streak") | F.col("long_run"))
