"""Keyed merges and incremental loads as DataFrame algebra.

Parquet tables have no MERGE/DELETE, so each merge strategy is written as
joins and unions on the key; the caller writes the result to a new
version folder (or with dynamic partition overwrite, touching only the
partitions present in the result).  All joins are equi-joins on the key,
so they shuffle once per side on the key and never fan out: the source is
de-duplicated first (M11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.operators.windows import latest_per_key
from pitchlake.sources import io as IO


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def dedupe_source(source: DataFrame, keys, order: list | None = None) -> DataFrame:
    """Keep one row per key (newest by the ``order`` columns) before a merge."""
    keys = _keys(keys)
    if not order:
        return source.dropDuplicates(keys)
    return latest_per_key(source, keys, order)


def duplicate_keys(source: DataFrame, keys) -> DataFrame:
    """M11 (fail mode): keys that occur more than once in the source."""
    keys = _keys(keys)
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("qtd")).filter(F.col("qtd") > 1)


def merge_upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Matched -> source row; unmatched source -> insert; rest untouched.

    ``source  UNION ALL  (target LEFT ANTI source)`` -- re-running the same
    source is a no-op.
    """
    keys = _keys(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return source.unionByName(kept, allowMissingColumns=True).select(*target.columns)


def merge_insert_only(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Insert source rows whose key is absent; never update."""
    keys = _keys(keys)
    new = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def merge_update_columns(target: DataFrame, source: DataFrame, keys, cols) -> DataFrame:
    """On match update only ``cols``; insert unmatched source rows."""
    keys = _keys(keys)
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols]) \
        .withColumn("_matched", F.lit(True))
    j = target.join(s, keys, "left")
    out = []
    for c in target.columns:
        if c in cols:
            out.append(F.when(F.col("_matched"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    updated = j.select(*out)
    new = source.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    return updated.unionByName(new)


def delete_insert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Drop every target row whose key is in the source, add all source rows."""
    keys = _keys(keys)
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def incremental(source: DataFrame, target: DataFrame | None, col: str,
                lookback: int = 0, strict: bool = False) -> DataFrame:
    """Rows of ``source`` at/after ``max(target.col) - lookback`` (or
    strictly after with ``strict``); empty/absent target -> all rows.

    The bound is a scalar subquery (evaluated once, before the scan of the
    source); on a table partitioned by ``col`` the filter prunes partitions.
    """
    if target is None:
        return source
    bound = target.agg(F.max(col) - F.lit(lookback)).scalar()
    if strict:
        return source.filter(bound.isNull() | (F.col(col) > bound))
    # one comparison with one-row subqueries, so that partitions can be pruned; empty target: the least value
    return source.filter(F.col(col) >= F.coalesce(bound, source.agg(F.min(col)).scalar()))


def run_incremental(build, target: DataFrame | None, keys, col: str,
                    lookback: int = 0, strict: bool = False) -> DataFrame:
    """Predicate (P08) + transform + merge (M01); first run = full build.

    ``build`` maps the filtered input to new rows; it is given the source
    predicate as a function so it can push it down to its own inputs.
    """
    new_rows = build(lambda df: incremental(df, target, col, lookback, strict))
    if target is None:
        return new_rows
    return merge_upsert(target, new_rows, keys)


def change_feed(old: DataFrame, new: DataFrame, keys, compare=None) -> DataFrame:
    """Row-level insert / update / delete between two versions.

    Full outer join on the key; a row is an update when any compared column
    differs null-safely.  Unchanged rows are not emitted.
    """
    keys = _keys(keys)
    cols = compare or [c for c in new.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols]).withColumn("_in_old", F.lit(True))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols]).withColumn("_in_new", F.lit(True))
    j = o.join(n, keys, "full_outer")
    changed = None
    for c in cols:
        d = ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))
        changed = d if changed is None else (changed | d)
    kind = (F.when(F.col("_in_old").isNull(), "insert")
            .when(F.col("_in_new").isNull(), "delete")
            .when(changed, "update_postimage"))
    out = j.select(*keys, *[F.coalesce(F.col(f"_n_{c}"), F.when(F.col("_in_new").isNull(),
                                                                F.col(f"_o_{c}"))).alias(c)
                            for c in cols],
                   kind.alias("_change_type"))
    return out.filter(F.col("_change_type").isNotNull())


def overwrite_recent(path: str, fresh: DataFrame, part_col: str, n: int) -> DataFrame:
    """Rebuild the newest ``n`` daily partitions of the table at ``path`` from ``fresh``.

    A dynamic partition overwrite: partitions that ``fresh`` has rows for are
    replaced, the files of all others stay.  The newest day comes from the
    partition values alone, and the bound prunes ``fresh`` where it is read.
    Running it again leaves the same table.
    """
    spark = fresh.sparkSession
    lo = spark.read.parquet(path).agg(F.date_sub(F.max(F.col(part_col).cast("date")), n - 1)).first()[0]
    IO.replace_partitions(fresh.filter(F.col(part_col) >= F.lit(lo)), path, [part_col])
    return spark.read.parquet(path)
