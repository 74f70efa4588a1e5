"""Run registry, executed partition overwrite, ranks without groups, salted joins of equal rows."""

import glob
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchlake.operators import joins as J
from pitchlake.operators import merge as M
from pitchlake.operators import registry as REG
from pitchlake.operators.windows import rank_in_groups
from pitchlake.sources import io as IO


def _runs(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], "model string, version int, run_id string, metric string, value double, logged_at string")


def test_a_run_logged_twice_is_one(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "registry")
    rows = _runs(spark, [("007", 1, "a", "rmse", 2.0), ("007", 1, "a", "rmse", 2.0), ("007", 1, "b", "rmse", 1.5), ("007", 2, "c", "rmse", 1.8),
                         ("m", 1, "a", "coverage", 0.4), ("m", 2, "z", "coverage", 0.6), (None, 1, "x", "rmse", 1.0)])
    assert REG.log_run(base, rows).count() == 5
    assert REG.log_run(base, rows).count() == 5
    more = _runs(spark, [("007", 3, "a", "rmse", 0.1), ("007", 3, "d", "rmse", 1.1)])      # run a is logged already
    reg = REG.log_run(base, more)
    assert reg.count() == 6 and reg.filter("model = '007'").count() == 4
    got = {(r.model, r.version): (r.run_id, r.value, r.runs, r.is_best) for r in REG.compare_runs(reg).collect()}
    assert got == {("007", 1): ("b", 1.5, 2, False), ("007", 2): ("c", 1.8, 1, False), ("007", 3): ("d", 1.1, 1, True),
                   ("m", 1): ("a", 0.4, 1, False), ("m", 2): ("z", 0.6, 1, True)}
    assert [tuple(r) for r in REG.best_version(reg, "rmse").collect()] == [("007", 3, "d", 1.1)]
    assert REG.registry(spark, base + "-none") is None


def test_overwrite_leaves_the_files_of_other_partitions(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "days")
    days = spark.range(100).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day"))
    IO.replace_partitions(days, path, ["day"])
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/day=*/*.parquet")}
    before = files()
    got = M.overwrite_recent(path, days.withColumn("id", -F.col("id")), "day", 3)
    after = files()
    old = {f for f in before if any(f"day=2024-01-{d:02d}" in f for d in range(1, 8))}
    assert len(old) >= 7 and all(after.get(f) == before[f] for f in old)
    assert not (set(before) - old) & set(after)
    want = days.withColumn("id", F.when(F.col("day") >= "2024-01-08", -F.col("id")).otherwise(F.col("id")))
    assert sorted(map(tuple, got.select("id", "day").collect())) == sorted(map(tuple, want.collect()))
    again = M.overwrite_recent(path, days.withColumn("id", -F.col("id")), "day", 3)
    assert sorted(map(tuple, again.select("id", "day").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("per_slice", [2, 7, 1_000_000])
def test_rank_equals_the_window(spark, per_slice):
    """Ties, nulls, null groups and a group with most rows; a value that half of it share."""
    rows = [(1, float(i % 37) if i % 2 else 5.0, i) for i in range(400)] + [(2, float(i), i) for i in range(9)]
    rows += [(None, 1.0, 0), (None, None, 1), (3, None, 2), (3, 4.0, 3), (3, None, 4)]
    df = spark.createDataFrame(rows, "g int, v double, x int").repartition(4)
    got = rank_in_groups(df, ["g"], "v", "r", values_per_slice=per_slice)
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    empty = rank_in_groups(df.limit(0), ["g"], "v", "r", values_per_slice=per_slice)
    assert empty.count() == 0


def test_no_window_holds_a_large_group(spark):
    """One group has all rows: no window partition has more than a few slices' values."""
    df = spark.range(20_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    got = rank_in_groups(df, ["g"], "v", "r", values_per_slice=1000)
    assert got.agg(F.min("r"), F.max("r"), F.countDistinct("r")).first() == (1, 20_000, 20_000)
    wide = [p for p in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Window [sum" in p]
    assert wide and any("_slice" in p for p in wide)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_equal_hot_rows_are_dealt_evenly(spark, tmpdir_path, how):
    path = os.path.join(tmpdir_path, "big")
    spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.lit("same").alias("x")) \
        .repartition(6).write.parquet(path)
    big = spark.read.parquet(path)
    small = spark.createDataFrame([(1, "one"), (3, "three"), (-1, "none")], "k long, y string")
    got, want = J.salted_join(big, small, "k", rows_per_salt=400, how=how), big.join(small, "k", how)
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    hot = {r.k: r._salts for r in J.hot_keys(big, "k", 400).collect()}
    assert set(hot) == {1} and hot[1] >= 10
    salts = big.withColumn("n", F.monotonically_increasing_id()).filter("k = 1").groupBy(F.pmod("n", F.lit(hot[1]))).count()
    sizes = sorted(r["count"] for r in salts.collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
