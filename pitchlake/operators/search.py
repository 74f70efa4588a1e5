"""Seeded parameter search for the boosters, pruned over time folds, with early stopping.

- Settings are drawn from ``SPACE`` by a hash of (seed, trial, name), so a
  trial is the same in every run and engine.
- A fit stops by its validation rounds (:func:`boost`): trees are added until
  the validation error has not fallen for ``patience`` trees.  With a patience
  of one Spark ends the fit itself, after one tree too many.  With more, trees
  come in growing batches; with one seed the first trees of a longer fit are
  those of the shorter one, so the stop is where a tree-by-tree fit would stop.
- Folds expand over time (L08).  All trials meet the first fold, the smallest;
  of those the best ``1 / keep`` go on to the next (with a ``keep`` of one all
  of them), and at least ``finalists`` see every fold.  Rank 1 is the complete
  trial with the least mean error.

Every fit is a distributed Spark job over the written design matrix; fits of
one fold run side by side from a pool of driver threads.  A fit passes its rows
some six times before its trees have their own copy, so a fold's rows are kept
on the executors (on disk where memory is short) while its fits run.  The driver holds the
settings, the fold's rounds and one error per tree, nothing of the data.
"""

from __future__ import annotations

import hashlib
import math
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.operators.ensemble import time_folds

# ----------------------------------------------------------------------------
# Ranges and grid of the two boosters.  (Leaf penalties have no
# counterpart in Spark's trees and are not drawn.)
SPACE = {
    "learning_rate": ("log", 0.01, 0.3),
    "max_depth": ("int", 3, 10),
    "min_child_weight": ("int", 1, 10),
    "subsample": ("uniform", 0.6, 1.0),
    "colsample": ("uniform", 0.6, 1.0),
}
GRID_B = (
    {"num_leaves": 31, "learning_rate": 0.05, "min_child_weight": 20, "subsample": 0.8},
    {"num_leaves": 63, "learning_rate": 0.03, "min_child_weight": 30, "subsample": 0.7},
    {"num_leaves": 127, "learning_rate": 0.01, "min_child_weight": 50, "subsample": 0.9},
)
MAX_TREES, PATIENCE, TRIALS, FOLDS = 500, 30, 50, 5
# ----------------------------------------------------------------------------
PARAMS = tuple(SPACE)


def draw(seed: str, trial: int, name: str) -> float:
    """Uniform draw in (0, 1) of a hash: 52 bits of the md5 of seed/trial/name."""
    return (int(hashlib.md5(f"{seed}/{trial}/{name}".encode()).hexdigest()[:13], 16) + 0.5) / float(1 << 52)


def settings(trials: int = TRIALS, seed: str = "l09", space: dict = SPACE) -> list[dict]:
    """The drawn settings, one per trial."""
    out = []
    for t in range(trials):
        one = {}
        for name, (kind, lo, hi) in space.items():
            u = draw(seed, t, name)
            if kind == "log":
                one[name] = round(math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))), 6)
            elif kind == "int":
                one[name] = math.floor(lo + u * (hi - lo) + 0.5)
            else:
                one[name] = round(lo + u * (hi - lo), 6)
        out.append(one)
    return out


def grid_b() -> list[dict]:
    """The second booster's grid; a tree of so many leaves is as deep as their logarithm."""
    return [{"learning_rate": g["learning_rate"], "max_depth": math.ceil(math.log2(g["num_leaves"])),
             "min_child_weight": g["min_child_weight"], "subsample": g["subsample"], "colsample": 1.0} for g in GRID_B]


def booster(params: dict, trees: int, label: str, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, maxIter=trees, seed=seed, stepSize=params["learning_rate"],
                        maxDepth=params["max_depth"], minInstancesPerNode=params["min_child_weight"],
                        subsamplingRate=params["subsample"], featureSubsetStrategy=f"{params['colsample']:.6f}")


def stop_at(errors: list[float], patience: int) -> int | None:
    """Number of trees with the least error so far when ``patience`` more did not lower it (None: not yet)."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1
    return None


def batch_after(errors: list[float], patience: int) -> int:
    """Trees of the next fit: enough to end at the least error so far, and half of that error's trees more."""
    best = errors.index(min(errors)) + 1
    return best + patience + 1 + best // 2


def boost(train: DataFrame, valid: DataFrame, params: dict, label: str, max_trees: int = MAX_TREES,
          patience: int = PATIENCE) -> tuple[int, float]:
    """(trees, validation RMSE) at the early stop."""
    if patience == 1:
        return boost_once(train, valid, params, label, max_trees)
    trees = min(max_trees, patience + 1)
    while True:
        model = booster(params, trees, label).fit(train)
        errors = model.evaluateEachIteration(valid, "squared")
        best = stop_at(errors, patience)
        if best is None and trees == max_trees:
            best = errors.index(min(errors)) + 1
        if best is not None:
            return best, math.sqrt(errors[best - 1])
        trees = min(max_trees, batch_after(errors, patience))


#: Least rise of the validation error that ends a fit, relative to it: any, and none at all.
NO_GAIN = 1e-300


def boost_once(train: DataFrame, valid: DataFrame, params: dict, label: str, max_trees: int = MAX_TREES) -> tuple[int, float]:
    """:func:`boost` with a patience of one tree, by one fit that Spark ends itself.

    Spark's own early stop adds trees until one does not lower the validation
    error, and keeps those before it.
    """
    rows = train.withColumn("_valid", F.lit(False)).unionByName(valid.withColumn("_valid", F.lit(True)))
    model = booster(params, max_trees, label).setParams(validationIndicatorCol="_valid", validationTol=NO_GAIN).fit(rows)
    return model.getNumTrees, math.sqrt(model.evaluateEachIteration(valid, "squared")[-1])


def fold_rounds(matrix: DataFrame, by: str, n_splits: int) -> list[tuple[list, list]]:
    """(training rounds, validation rounds) of each fold that has both."""
    out: dict[int, dict[str, list]] = {}
    for r in time_folds(matrix, by, n_splits).collect():            # one row per fold and round
        out.setdefault(r["fold"], {}).setdefault(r["papel"], []).append(r[by])
    return [(out[f]["train"], out[f]["test"]) for f in sorted(out) if len(out[f]) == 2]


def search(matrix: DataFrame, trials: list[dict], label: str, by: str = "rodada_alvo", n_splits: int = FOLDS,
           max_trees: int = MAX_TREES, patience: int = PATIENCE, keep: int = 3, finalists: int = 2, threads: int = 8) -> DataFrame:
    """The trial table: trial, the settings, folds_run, rmse (mean over them), trees (their mean, rounded up), state, rank.

    ``matrix`` has ``features``, ``label`` and ``by``; it should be a written table.
    """
    spark = matrix.sparkSession
    folds = fold_rounds(matrix, by, n_splits)
    seen: dict[int, list[tuple[int, float]]] = {t: [] for t in range(len(trials))}
    alive = list(seen)
    x = matrix.select("features", label, by)
    for k, (before, after) in enumerate(folds):
        train, valid = (x.filter(F.col(by).isin(rounds)).select("features", label).persist() for rounds in (before, after))
        try:
            train.count(), valid.count()                # filled before the fits, which would wait for each other's parts
            one = inheritable_thread_target(spark)(lambda t, a=train, b=valid: boost(a, b, trials[t], label, max_trees, patience))
            deep_first = sorted(alive, key=lambda t: -trials[t]["max_depth"])       # the longest fits do not come last
            with ThreadPool(min(threads, len(alive))) as pool:
                for t, result in zip(deep_first, pool.map(one, deep_first, chunksize=1), strict=True):
                    seen[t].append(result)
        finally:
            train.unpersist(), valid.unpersist()
        if k + 1 < len(folds):
            alive.sort(key=lambda t: (_mean(seen[t]), t))
            alive = alive[:max(finalists, -(-len(alive) // keep))]
    order = sorted(alive, key=lambda t: (_mean(seen[t]), t))
    rows = [(t, *[trials[t][p] for p in PARAMS], len(seen[t]), _mean(seen[t]),
             math.ceil(sum(n for n, _ in seen[t]) / len(seen[t])) if seen[t] else None,
             "complete" if t in order else "pruned", order.index(t) + 1 if t in order else None) for t in seen]
    return spark.createDataFrame(rows, "trial int, learning_rate double, max_depth int, min_child_weight int, subsample double, "
                                       "colsample double, folds_run int, rmse double, trees int, state string, rank int")


def _mean(results: list[tuple[int, float]]) -> float | None:
    return sum(e for _, e in results) / len(results) if results else None


def best(table: DataFrame) -> dict:
    """Settings and trees of the first rank."""
    r = table.filter("rank = 1").first()
    return {**{p: r[p] for p in PARAMS}, "trees": r["trees"]}


def plan(matrix: DataFrame, trials: list[dict], by: str = "rodada_alvo", n_splits: int = FOLDS) -> DataFrame:
    """Every trial on every fold, with its settings and the rows that it trains on and is validated on."""
    folds = matrix.groupBy(by).agg(F.count(F.lit(1)).alias("n")).join(time_folds(matrix, by, n_splits), by)
    sized = folds.groupBy("fold").agg(*[F.sum(F.when(F.col("papel") == role, F.col("n")).otherwise(0)).alias(name)
                                        for role, name in (("train", "n_train"), ("test", "n_valid"))])
    spark = matrix.sparkSession
    drawn = spark.createDataFrame([(t, *[one[p] for p in PARAMS]) for t, one in enumerate(trials)],
                                  "trial int, learning_rate double, max_depth int, min_child_weight int, subsample double, colsample double")
    return sized.crossJoin(F.broadcast(drawn))            # folds x trials, both bounded by parameters

