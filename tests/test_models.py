"""Spark ML predictors on the training features (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import count_quantiles as CQ
from pitchlake.operators import ensemble as EN
from pitchlake.operators import glm as GLM
from pitchlake.operators import models as MD
from pitchlake.operators import search as SR
from pitchlake.plans.pipeline import Pipeline

from sf_paths import SF_SMALL


def test_design_matrix_has_no_nulls(spark):
    dm = MD.design_matrix(Pipeline(spark, SF_SMALL).training_features)
    assert all(c in dm.columns for c in MD.FEATURES)
    nulls = dm.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in MD.FEATURES]).collect()[0]
    assert all(v == 0 for v in nulls)


def test_boosters_and_glm_score_every_row(spark):
    dm = MD.design_matrix(Pipeline(spark, SF_SMALL).training_features)
    train, rows = MD.split(dm)
    n = rows.count()
    a = MD.score(MD.fit_gbt(train, max_iter=5, max_depth=3), rows, name="xgboost")
    assert a.count() == n and a.filter("pontuacao_prevista < 0").count() == 0
    b = MD.score_categorical(MD.fit_gbt_categorical(train, max_iter=5, max_depth=4), rows)
    assert b.count() == n
    glm, priors = MD.fit_poisson(train)
    x = MD.assemble(MD.poisson_inputs(rows, priors), MD.POISSON_COLS)
    assert glm.transform(x).filter("prediction < 0").count() == 0


def test_search_stops_early_prunes_and_ranks(spark):
    """A signal that a slow learner cannot reach in time: the search prefers the fast one, and stops where a plain loop does."""
    import math
    rows = [(r, float(i % 7), float((i * 37 + r) % 11), 5.0 * (i % 7) + (i * 37 + r) % 3) for r in range(1, 13) for i in range(40)]
    df = spark.createDataFrame(rows, f"rodada_alvo int, good double, noise double, {MD.TARGET} double").repartition(2)
    x = MD.assemble(df, ("good", "noise"))
    base = {"max_depth": 3, "min_child_weight": 1, "subsample": 1.0, "colsample": 1.0}
    trials = [{**base, "learning_rate": v} for v in (0.01, 0.3, 0.05)]
    table = SR.search(x, trials, MD.TARGET, n_splits=2, max_trees=8, patience=2, keep=3, finalists=1).orderBy("trial").collect()
    assert [r.state for r in table] == ["pruned", "complete", "pruned"]
    assert [(r.folds_run, r["rank"]) for r in table] == [(1, None), (2, 1), (1, None)]
    (before, after), _ = SR.fold_rounds(x, "rodada_alvo", 2)
    assert max(before) < min(after)
    train, valid = x.filter(F.col("rodada_alvo").isin(before)), x.filter(F.col("rodada_alvo").isin(after))
    errors = [SR.booster(trials[0], n, MD.TARGET).fit(train).transform(valid)
              .agg(F.avg((F.col("prediction") - F.col(MD.TARGET)) ** 2)).first()[0] for n in (1, 2, 8)]
    found, rmse = SR.boost(train, valid, trials[0], MD.TARGET, max_trees=8, patience=2)
    assert found == 8 and math.isclose(rmse, math.sqrt(errors[2]), rel_tol=1e-9)
    assert found == table[0].trees and math.isclose(rmse, table[0].rmse)
    assert SR.best(spark.createDataFrame(table, "trial int, learning_rate double, max_depth int, min_child_weight int, subsample double, "
                                         "colsample double, folds_run int, rmse double, trees int, state string, rank int"))["learning_rate"] == 0.3


def test_search_reads_a_fold_once_for_all_its_fits(spark):
    """However many settings and trees are tried, the training and the validation rows of a fold are read once each, and none stay cached."""
    made = spark.sparkContext.accumulator(0)

    def count(x):
        made.add(1)
        return x

    rows = [(r, float(i % 7), 5.0 * (i % 7) + (i * 37 + r) % 3) for r in range(1, 10) for i in range(20)]
    df = spark.createDataFrame(rows, f"rodada_alvo int, good double, {MD.TARGET} double").repartition(2)
    x = MD.assemble(df.withColumn("good", F.udf(count, "double")("good")), ("good",))
    trials = [{"max_depth": 2, "min_child_weight": 1, "subsample": 1.0, "colsample": 1.0, "learning_rate": v} for v in (0.1, 0.2, 0.3)]
    left = spark.sparkContext._jsc.getPersistentRDDs().size()
    table = SR.search(x, trials, MD.TARGET, n_splits=2, max_trees=3, patience=1, keep=1, finalists=3)
    assert table.filter("folds_run = 2").count() == 3
    assert made.value <= 2 * 2 * len(rows)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= left


def test_early_stop_waits_for_patience():
    assert SR.stop_at([5, 4, 3, 3.5, 3.2], 2) == 3
    assert SR.stop_at([5, 4, 3, 3.5], 2) is None
    assert SR.stop_at([5, 6, 4, 5, 5], 2) == 3
    assert SR.stop_at([1, 2, 3], 2) == 1


def test_settings_are_seeded_and_in_range():
    drawn = SR.settings()
    assert len(drawn) == 50 and drawn == SR.settings() and drawn != SR.settings(seed="other")
    for one in drawn:
        assert all(lo <= one[n] <= hi for n, (_, lo, hi) in SR.SPACE.items())
    assert len({one["max_depth"] for one in drawn}) == 8


def test_second_booster_boosts(spark):
    from pyspark.ml.regression import GBTRegressionModel
    dm = MD.design_matrix(Pipeline(spark, SF_SMALL).training_features)
    model = MD.fit_gbt_categorical(MD.split(dm)[0], max_iter=3, max_depth=3)
    assert isinstance(model.stages[-1], GBTRegressionModel) and model.stages[-1].getNumTrees == 3


def test_dag_picks_come_from_fitted_models(spark, tmpdir_path, monkeypatch):
    import os
    from pitchlake.plans import pipeline as P
    from pitchlake.plans.run import run_dag
    calls = []
    real = MD.predict_all
    monkeypatch.setattr(MD, "predict_all", lambda train, rows, max_iter=30, **more: calls.append(1) or real(train, rows, 4))
    monkeypatch.setattr(P.TrainedPipeline, "n_splits", 1)
    paths = run_dag(spark, SF_SMALL, os.path.join(tmpdir_path, "dag"))
    assert len(calls) == 2                                # one fold and the rows to predict
    hist, picks = (spark.read.parquet(paths[n]) for n in ("history", "previsao_final_ranked"))
    assert {r.modelo for r in hist.select("modelo").distinct().collect()} == {"xgboost", "lightgbm", "poisson"}
    assert picks.count() > 0 and hist.filter("pontuacao_prevista < 0").count() == 0
    base = P.Pipeline(spark, SF_SMALL).mp_long
    same = hist.join(base, ["atleta_id", "rodada_alvo", "modelo", "pontuacao_prevista"])
    assert same.count() < 0.2 * hist.count()             # not the rolling means


def test_intervals_without_a_shuffle(spark):
    df = spark.createDataFrame([(3.0, 5.0), (3e9, 5.0), (590.0, 2.0), (610.0, 2.0), (0.0, 1.0), (601.0, 1.0), (1000.0, 5.0), (None, None)], "mu double, r double")
    q = EN.with_poisson_interval(df, "mu")
    assert "Exchange" not in q._jdf.queryExecution().executedPlan().toString()
    rows = {r.mu: (r.q10, r.q90) for r in q.collect()}
    assert rows[3.0] == (1, 5) and abs(rows[3e9][0] - (3e9 - 1.2815516 * 3e9 ** 0.5)) < 2
    assert rows[590.0] == (559, 621) and rows[610.0][0] - rows[590.0][0] in (19, 20)
    low, high = EN.negbin_quantile(F.col("mu"), F.col("r"))
    rows = {r.mu: (r.low, r.high) for r in df.select("mu", low.alias("low"), high.alias("high")).collect()}
    assert rows[601.0] == (63, 1385) and rows[1000.0] == (485, 1600)
    assert all(0 <= a <= b for m, (a, b) in rows.items() if m is not None)


def _summed(log_pmf, p):
    """Smallest k with CDF(k) >= p by summing every probability."""
    import numpy as np
    return int(np.searchsorted(np.cumsum(np.exp(log_pmf)), p))


@pytest.mark.parametrize("p", [0.1, 0.9])
def test_quantiles_at_any_mean_equal_the_summed_cdf(p):
    import math
    import random

    import numpy as np
    rng = random.Random(7)
    pairs = [(10 ** rng.uniform(-2, 6), 10 ** rng.uniform(-1, 6)) for _ in range(150)] + [(1e6, 1e6), (1e6, 30.0), (0.01, 0.1), (600.0, 1.0)]
    pairs = [(m, r) for m, r in pairs if m + 12 * math.sqrt(m + m * m / r) < 3e6]
    mean, size = (np.array(x) for x in zip(*pairs, strict=True))
    got = CQ.quantile(p, mean, size)
    for g, m, r in zip(got, mean, size, strict=True):
        k = np.arange(int(m + 12 * math.sqrt(m + m * m / r) + 50))
        ratio = np.log((r + k[:-1]) / (k[:-1] + 1) * (m / (r + m)))
        assert g == _summed(np.append(0, np.cumsum(ratio)) + r * math.log(r / (r + m)), p), (m, r)
    for g, m in zip(CQ.quantile(p, mean), mean, strict=True):
        k = np.arange(int(m + 12 * math.sqrt(m) + 50))
        logs = k * math.log(m) - m - np.append(0, np.cumsum(np.log(k[1:])))
        assert g == _summed(logs, p), m


def test_both_quantile_paths_agree(spark, monkeypatch):
    df = spark.createDataFrame([(0.01 * 1.5 ** i, 0.2 * 1.7 ** (i % 20)) for i in range(28)], "mu double, r double")
    cols = lambda: [c.alias(f"c{i}") for i, c in enumerate([*EN.poisson_quantile(F.col("mu")), *EN.negbin_quantile(F.col("mu"), F.col("r"))])]
    summed = df.select("mu", *cols()).collect()
    monkeypatch.setattr(EN, "MAX_TERMS", 0)
    assert sorted(summed) == sorted(df.select("mu", *cols()).collect())


def test_elastic_net_is_optimal_and_does_not_depend_on_partitions(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) * [1, 5, 0.2, 1]
    y = rng.poisson(np.exp(0.6 + 0.5 * x[:, 0] - 0.05 * x[:, 1])).astype(float)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)] + [(None, 0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double")
    fits = [GLM.fit(df.repartition(n), ("a", "b", "c", "d"), "y") for n in (1, 5)]
    assert np.allclose(fits[0].coefs, fits[1].coefs, atol=1e-8)
    m = fits[0]
    assert max(m.residuals()) < 1e-7 and m.coefs[3] == 0 and m.coefs[1] > 0.2

    def objective(b):
        eta = b[0] + x @ b[1:]
        return (np.exp(eta) - y * eta).mean() + 0.1 * (0.25 * (b @ b) + 0.5 * np.abs(b).sum())
    best = objective(np.array(m.coefs))
    assert abs(best - m.objective) < 1e-9
    assert all(objective(np.array(m.coefs) + 1e-3 * rng.normal(size=5)) > best for _ in range(50))
    heavy = GLM.fit(df, ("a", "b", "c", "d"), "y", alpha=100.0)
    assert heavy.coefs == (0.0,) * 5
    assert GLM.fit(df.limit(0), ("a",), "y").coefs == (0.0, 0.0)


def test_shuffling_an_informative_feature_costs_most(spark):
    rows = [(i, 1, float(i % 7), 0.1 * (i * 37 % 11), float(i % 7) * 3) for i in range(300)]
    df = spark.createDataFrame(rows, f"atleta_id int, rodada_alvo int, good double, noise double, {MD.TARGET} double")
    model = MD.gbt(max_iter=5, max_depth=3).fit(MD.assemble(df, ("good", "noise")))
    out = {r.feature: r.aumento_rmse for r in MD.permutation_importance(model, df, ("good", "noise")).collect()}
    assert out["good"] > 2 and abs(out["noise"]) < 0.1


def test_fits_run_side_by_side(spark, monkeypatch):
    """Each fit waits until all have begun: those of all folds, and the three models of a fold."""
    import threading
    matrix = spark.createDataFrame([(a, r, 1.0 if r < 6 else None) for a in range(3) for r in range(1, 7)],
                                   f"atleta_id int, rodada_alvo int, {MD.TARGET} double")
    real = MD.predict_all
    folds = threading.Barrier(3, timeout=60)
    monkeypatch.setattr(MD, "predict_all", lambda train, rows, max_iter=30: folds.wait() >= 0 and rows)
    out = MD.out_of_fold(matrix, n_splits=2)
    tests = [r for f in SR.fold_rounds(matrix.filter(f"{MD.TARGET} IS NOT NULL"), "rodada_alvo", 2) for r in f[1]]
    assert sorted(r.rodada_alvo for r in out.collect()) == sorted([6, *tests] * 3)
    models = threading.Barrier(3, timeout=60)
    for fit in ("fit_gbt", "fit_gbt_categorical", "fit_poisson"):
        monkeypatch.setattr(MD, fit, lambda train, *a, n=fit, **b: models.wait() >= 0 and n)
    monkeypatch.setattr(MD, "score", lambda model, rows, name: rows.withColumn("modelo", F.lit(name)))
    monkeypatch.setattr(MD, "score_categorical", lambda model, rows: rows.withColumn("modelo", F.lit("lightgbm")))
    monkeypatch.setattr(MD, "score_poisson", lambda model, rows: rows.withColumn("modelo", F.lit("poisson")))
    got = real(matrix, matrix.limit(1)).collect()
    assert [r.modelo for r in got] == ["xgboost", "lightgbm", "poisson"]
