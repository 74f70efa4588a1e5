"""Slowly-changing history (SCD type 2).

``scd2_build`` turns a capture history into validity intervals without
putting a whole key into one task: rows are windowed per (key, time
bucket), and the only per-key windows run over one-row-per-bucket
summaries.  A key that holds a third of all captures is therefore spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.operators.windows import time_slices


def _changed(cur: list[str], prev_prefix: str) -> Column:
    diff = None
    for c in cur:
        d = ~F.col(c).eqNullSafe(F.col(f"{prev_prefix}{c}"))
        diff = d if diff is None else (diff | d)
    return diff


def scd2_build(history: DataFrame, key: str, check_cols: list[str], ts: str, tie: str,
               bucket: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per version of ``check_cols`` per key.

    A capture opens a version when it is the key's first capture or any
    tracked column differs (null-safe) from the previous capture, ordered by
    (``ts``, ``tie``).  ``valid_to`` is the next version's ``valid_from``;
    the open version has ``valid_to`` NULL and ``is_current`` true.
    ``bucket`` (default: as many time slices per key as its rows ask for) only
    decides how the work is split; results do not depend on it.
    """
    keep = keep or []
    if bucket is None:
        history, bucket = time_slices(history, key, ts), F.col("_slice")
    cols = [key, ts, tie, *check_cols, *[c for c in keep if c not in check_cols]]
    h = history.withColumn("_b", bucket).select(*cols, "_b")
    order = F.struct(F.col(ts), F.col(tie))
    tracked = F.struct(*[F.col(c) for c in check_cols])

    # 1. previous capture inside the same (key, bucket)
    wb = Window.partitionBy(key, "_b").orderBy(F.col(ts), F.col(tie))
    h = h.select("*", F.lag(tracked).over(wb).alias("_prev_in_b"),
                 F.row_number().over(wb).alias("_rn"))

    # 2. last capture of the previous non-empty bucket (bucket-level summary)
    last = h.groupBy(key, "_b").agg(F.max_by(tracked, order).alias("_last"))
    wk = Window.partitionBy(key).orderBy("_b")
    last = last.select(key, "_b", F.lag("_last").over(wk).alias("_prev_b"))
    h = h.join(last, [key, "_b"], "left")
    prev = F.when(F.col("_rn") == 1, F.col("_prev_b")).otherwise(F.col("_prev_in_b"))
    h = h.withColumn("_prev", prev)
    for c in check_cols:
        h = h.withColumn(f"_p_{c}", F.col(f"_prev.{c}"))
    is_change = F.col("_prev").isNull() | _changed(check_cols, "_p_")
    v = h.filter(is_change).select(key, ts, tie, "_b", *check_cols,
                                   *[c for c in keep if c not in check_cols])

    # 3. next version start: inside the bucket, else first version of a later bucket
    v = v.withColumn("_next_in_b", F.lead(ts).over(
        Window.partitionBy(key, "_b").orderBy(F.col(ts), F.col(tie))))
    firsts = v.groupBy(key, "_b").agg(F.min(ts).alias("_first_ts"))
    firsts = firsts.select(key, "_b", F.lead("_first_ts").over(wk).alias("_next_b"))
    v = v.join(firsts, [key, "_b"], "left")
    valid_to = F.coalesce(F.col("_next_in_b"), F.col("_next_b"))
    return v.select(key, tie, *check_cols, *[c for c in keep if c not in check_cols],
                    F.col(ts).alias("valid_from"), valid_to.alias("valid_to"),
                    valid_to.isNull().alias("is_current"))


def scd2_apply(snapshot: DataFrame, latest: DataFrame, key: str, check_cols: list[str],
               asof: Column, tie: str | None = None) -> DataFrame:
    """Apply one new capture per key to an SCD-2 table (check strategy).

    Changed keys: the current version is closed at ``asof`` and a new
    current version opens at ``asof``; new keys open a version; unchanged
    and absent keys, and all closed versions, are kept as they are.

    One pass: the whole snapshot is full-outer-joined to the new captures on
    the key, matching only current versions; each joined row emits one or
    two versions.
    """
    cols = ([tie] if tie else []) + list(check_cols)
    at = asof.cast("timestamp_ntz")
    s = snapshot.select(key, *cols, "valid_from", "valid_to", "is_current")
    n = latest.select(F.col(key).alias("_nk"), *[F.col(c).alias(f"_n_{c}") for c in cols])
    j = s.join(n, (F.col(key) == F.col("_nk")) & F.col("is_current"), "full_outer")
    has_s, has_n = F.col("is_current").isNotNull(), F.col("_nk").isNotNull()
    diff = None
    for c in check_cols:
        d = ~F.col(c).eqNullSafe(F.col(f"_n_{c}"))
        diff = d if diff is None else (diff | d)
    chg = has_s & has_n & diff
    old = F.struct(F.col(key).alias(key), *[F.col(c).alias(c) for c in cols], F.col("valid_from"),
                   F.when(chg, at).otherwise(F.col("valid_to")).alias("valid_to"),
                   F.when(chg, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"))
    new = F.struct(F.col("_nk").alias(key), *[F.col(f"_n_{c}").alias(c) for c in cols], at.alias("valid_from"),
                   F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    rows = F.when(chg, F.array(old, new)).when(has_s, F.array(old)).otherwise(F.array(new))
    return j.select(F.explode(rows).alias("_r")).select("_r.*")
