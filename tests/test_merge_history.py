"""Merges, incremental predicate, SCD-2 and change feed."""

import datetime as dt

from pyspark.sql import functions as F

from pitchlake.operators import history as H
from pitchlake.operators import merge as M

SCHEMA = "k int, v string, ts int"


def test_merge_upsert_update_insert_untouched_and_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    src = spark.createDataFrame([(2, "B", 2), (3, "c", 2), (3, "c2", 3)], SCHEMA)
    src = M.dedupe_source(src, ["k"], ["ts"])                    # duplicate source key -> newest
    once = M.merge_upsert(tgt, src, "k")
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1), (2, "B", 2), (3, "c2", 3)]
    twice = M.merge_upsert(once, src, "k")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_insert_only_update_columns_delete_insert(spark):
    tgt = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    src = spark.createDataFrame([(2, "B", 9), (3, "c", 9)], SCHEMA)
    assert sorted(map(tuple, M.merge_insert_only(tgt, src, "k").collect())) == [(1, "a", 1), (2, "b", 1), (3, "c", 9)]
    assert sorted(map(tuple, M.merge_update_columns(tgt, src, "k", ["v"]).collect())) == \
        [(1, "a", 1), (2, "B", 1), (3, "c", 9)]
    assert sorted(map(tuple, M.delete_insert(tgt, src, "k").collect())) == [(1, "a", 1), (2, "B", 9), (3, "c", 9)]


def test_incremental_lookback_and_empty_target(spark):
    src = spark.createDataFrame([(i, "x", i) for i in range(1, 6)], SCHEMA)
    tgt = src.filter("ts <= 3")
    assert sorted(r.ts for r in M.incremental(src, tgt, "ts", lookback=1).collect()) == [2, 3, 4, 5]
    assert sorted(r.ts for r in M.incremental(src, tgt, "ts", strict=True).collect()) == [4, 5]
    empty = src.filter("ts > 100")
    assert M.incremental(src, empty, "ts").count() == 5


def _hist(spark, rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, d), s, p, st) for k, d, s, p, st in rows],
                                 "key_id int, captured_at timestamp_ntz, capture_seq int, price double, status string")


def test_scd2_build_unchanged_changed_new(spark):
    h = _hist(spark, [(1, 1, 1, 10.0, "A"), (1, 2, 2, 10.0, "A"), (1, 3, 3, 11.0, "A"),
                      (2, 5, 4, 5.0, "B"), (1, 20, 5, 11.0, "A"), (1, 25, 6, 10.0, "A")])
    # buckets of one day force the carry across buckets to be exercised
    v = H.scd2_build(h, "key_id", ["price", "status"], "captured_at", "capture_seq",
                     bucket=F.date_trunc("day", F.col("captured_at")))
    got = sorted((r.key_id, r.price, r.valid_from.day, r.valid_to.day if r.valid_to else None, r.is_current)
                 for r in v.collect())
    assert got == [(1, 10.0, 1, 3, False), (1, 10.0, 25, None, True), (1, 11.0, 3, 25, False), (2, 5.0, 5, None, True)]


def test_scd2_apply_check_strategy(spark):
    snap = spark.createDataFrame(
        [(1, 10.0, dt.datetime(2024, 1, 1), None, True), (2, 5.0, dt.datetime(2024, 1, 1), None, True)],
        "key_id int, price double, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    latest = spark.createDataFrame([(1, 10.0), (2, 6.0), (3, 1.0)], "key_id int, price double")
    out = H.scd2_apply(snap, latest, "key_id", ["price"], F.lit("2024-02-01").cast("timestamp_ntz"))
    got = sorted((r.key_id, r.price, r.is_current) for r in out.collect())
    assert got == [(1, 10.0, True), (2, 5.0, False), (2, 6.0, True), (3, 1.0, True)]


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    new = spark.createDataFrame([(2, "B", 1), (3, "c", 1)], SCHEMA)
    got = sorted((r.k, r._change_type) for r in M.change_feed(old, new, "k").collect())
    assert got == [(1, "delete"), (2, "update_postimage"), (3, "insert")]


def test_time_slices_split_a_hot_key_and_keep_results(spark):
    from pyspark.sql import functions as F
    from pitchlake.operators import windows as W
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("seq"),
                                 F.timestamp_add("HOUR", (F.col("id") * 7).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"))
    cut = W.time_slices(df, "k", "ts", rows_per_slice=50)
    sizes = [r["count"] for r in cut.groupBy("k", "_slice").count().collect()]
    assert max(sizes) <= 100 and cut.count() == 900
    whole = W.rest_days(df, "k", "ts", "seq", bucket=F.lit(0))
    split = W.previous_in_sequence(cut, "k", ["ts", "seq"], ["ts"], F.col("_slice"))
    split = split.withColumn("dias_desde_ultimo", F.datediff("ts", "_prev_ts")).select(*whole.columns)
    assert whole.exceptAll(split).count() == 0
