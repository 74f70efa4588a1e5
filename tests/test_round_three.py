"""Steps whose time or memory grew faster than their input."""

import datetime as dt
import math
from types import SimpleNamespace

from pyspark.sql import functions as F

from pitchlake.operators import ensemble as EN
from pitchlake.operators import reports as R
from pitchlake.sources.tables import Tables


def negbin_quantile(p, m, r):
    k, pmf = 0, math.exp(r * math.log(r / (r + m)))
    cdf = pmf
    while cdf < p:
        k += 1
        pmf *= (r + k - 1) / k * (m / (r + m))
        cdf += pmf
    return k


def test_short_sums_are_not_interpreted_per_row(spark):
    """Few terms are summed for a whole batch; rows without a size get null, without a mean the least one."""
    rows = [(0.0, 3.0), (7.5, 0.4), (12.0, 1e6), (31.25, 2.5), (220.0, 40.0), (None, 2.0), (3.0, None)]
    x = spark.createDataFrame(rows, "mu double, r double")
    low, high = EN.negbin_quantile(F.col("mu"), F.col("r"))
    out = x.select("mu", "r", low.alias("low"), high.alias("high"))
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()
    for mu, r, got_low, got_high in out.collect():
        m = max(mu or 0.0, 0.01)
        want = (None, None) if r is None else (negbin_quantile(0.1, m, r), negbin_quantile(0.9, m, r))
        assert (got_low, got_high) == want, (mu, r)


def test_cost_rollups_hold_their_own_groups_only(spark):
    """No aggregate by cluster and SKU at once; groups without a week, a SKU or a team are rows of their own."""
    monday, sunday = dt.date(2024, 1, 1), None
    rows = [(1, "a", monday, "x", 2.0, 1.5), (1, "b", monday, "x", 1.0, 1.5), (2, "a", monday, "y", 4.0, None),
            (2, None, sunday, "x", 3.0, 1.5), (None, "a", monday, None, 5.0, 2.0), (3, "c", monday, "y", None, 1.0)]
    u = spark.createDataFrame(rows, "cluster_id long, team string, semana date, sku_name string, usage_quantity double, price double")
    out = R.cost_rollups(u)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    by_cluster = [x for x in plan.splitlines() if "Aggregate [" in x and "cluster_id" in x]
    assert by_cluster and all("spark_grouping_id" in x for x in by_cluster)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        ("cluster", "1", 4.5), ("cluster", "2", 4.5), ("cluster", "3", None), ("cluster", None, 10.0),
        ("time", "a", 13.0), ("time", "b", 1.5), ("time", "c", None), ("time", None, 4.5),
        ("semana_sku", "2024-01-01|x", 4.5), ("semana_sku", "2024-01-01|y", 0.0), ("semana_sku", None, 14.5)], key=str)


def test_design_matrix_is_written_once(spark, monkeypatch):
    """Fits and counts read the written matrix, not the windows above it."""
    from pitchlake.operators import models as MD
    from pitchlake.plans import q_ml
    features = spark.range(4).withColumn("x", F.col("id") * 2)
    monkeypatch.setattr(MD, "design_matrix", lambda df: df)
    p = SimpleNamespace(t=Tables(spark, "", share=True), training_features=features)
    matrix = q_ml._dm(p)
    assert matrix.inputFiles() and q_ml._dm(p) is matrix
    assert sorted(map(tuple, matrix.collect())) == [(i, 2 * i) for i in range(4)]


def test_patience_of_one_tree_is_one_fit(spark, monkeypatch):
    """Spark's own early stop ends where the growing batches end, after a single fit."""
    from pyspark.ml.linalg import Vectors
    from pitchlake.operators import search as SR
    rows = [(Vectors.dense([float(i % 17), float(i * 7 % 31)]), float(i % 17 + (i * 13) % 11), i // 60) for i in range(240)]
    x = spark.createDataFrame(rows, ["features", "y", "r"]).cache()
    train, valid = x.filter("r < 3"), x.filter("r = 3")
    fits, plain = [], SR.booster
    monkeypatch.setattr(SR, "booster", lambda *a: fits.append(a[1]) or plain(*a))
    for rate, depth in ((0.05, 2), (0.9, 5)):
        params = {"learning_rate": rate, "max_depth": depth, "min_child_weight": 1, "subsample": 0.7, "colsample": 1.0}
        fits.clear()
        trees, rmse = SR.boost(train, valid, params, "y", max_trees=5, patience=1)
        assert fits == [5]
        errors = plain(params, 5, "y").fit(train).evaluateEachIteration(valid, "squared")
        want = SR.stop_at(errors, 1) or errors.index(min(errors)) + 1
        assert trees == want and abs(rmse - math.sqrt(errors[want - 1])) < 1e-9
