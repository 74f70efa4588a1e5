"""Spark ML versions of the three base predictors.

The reference pulls the feature store to the driver (``toPandas``) and
trains single-machine boosters.  Here training and scoring stay on the
cluster: ``VectorAssembler`` + Spark ML estimators, time-ordered folds over
distinct rounds (L08), and ``model.transform`` for batch scoring.  Loops
run over a handful of parameter settings and folds, never over data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline as MLPipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.operators import glm as GLM
from pitchlake.operators import search as SR
from pitchlake.operators.ensemble import time_folds

# ----------------------------------------------------------------------------
# The model inputs of the reference notebooks (13 numeric
# features, the home flag and the derby flag).
NUMERIC_FEATURES = (
    "media_pontos_geral", "media_ultimas_5", "media_ultimas_3", "desvio_padrao_pontos",
    "consistencia_score", "total_jogos", "aproveitamento_campo", "preco_atual", "variacao_preco",
    "clube_posicao_tabela", "clube_aproveitamento", "adversario_posicao_tabela", "posicao_id",
)
FLAG_FEATURES = ("mando_casa", "classico")
FEATURES = NUMERIC_FEATURES + FLAG_FEATURES
TARGET = "pontuacao_real"
SEED = 42
# ----------------------------------------------------------------------------


def design_matrix(df: DataFrame, cols=FEATURES) -> DataFrame:
    """Encoded features (F04 flags) with NULL -> 0, before vector assembly."""
    x = df.withColumn("mando_casa", F.when(F.col("mando_campo") == "casa", 1).otherwise(0)) \
          .withColumn("classico", F.coalesce(F.col("eh_classico").cast("int"), F.lit(0)))
    return x.select("atleta_id", "rodada_alvo", "mando_campo", TARGET,
                    *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])


def assemble(df: DataFrame, cols=FEATURES, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a target train, rows without one are scored."""
    return df.filter(F.col(TARGET).isNotNull()), df.filter(F.col(TARGET).isNull())


def gbt(max_iter: int = 30, max_depth: int = 4, step: float = 0.1) -> GBTRegressor:
    """Squared-error gradient-boosted trees."""
    return GBTRegressor(featuresCol="features", labelCol=TARGET, maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step, seed=SEED)


def fit_gbt(train: DataFrame, searched: dict | None = None, **params):
    """L03; ``searched`` are the settings of L09."""
    booster = SR.booster(searched, searched["trees"], TARGET, SEED) if searched else gbt(**params)
    return booster.fit(assemble(train))


CATEGORIES = ("posicao_id", "mando_campo", "classico")


def _with_categories(df: DataFrame) -> DataFrame:
    return df.withColumn("mando_campo", F.coalesce("mando_campo", F.lit("sem_jogo")))


def categorical_stages() -> list:
    """Encoding of the second booster: native categoricals (position, side, derby),
    indexed with ``handleInvalid='keep'`` (unseen level -> extra index) and
    marked categorical by ``VectorIndexer``."""
    idx = StringIndexer(inputCols=list(CATEGORIES), outputCols=[f"{c}_idx" for c in CATEGORIES],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    nums = [c for c in NUMERIC_FEATURES if c != "posicao_id"]
    va = VectorAssembler(inputCols=nums + [f"{c}_idx" for c in CATEGORIES], outputCol="raw", handleInvalid="keep")
    vi = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=8, handleInvalid="keep")
    return [idx, va, vi]


def categorical_features(train: DataFrame) -> DataFrame:
    x = _with_categories(train)
    return MLPipeline(stages=categorical_stages()).fit(x).transform(x)


def fit_gbt_categorical(train: DataFrame, max_iter: int = 30, max_depth: int = 5, params: dict | None = None):
    """Second booster; ``params`` are searched ones (L09).  Row sampling per
    tree makes it a differently-biased member of the ensemble."""
    gbt_b = (SR.booster(params, params["trees"], TARGET, SEED) if params else
             GBTRegressor(featuresCol="features", labelCol=TARGET, maxIter=max_iter, maxDepth=max_depth,
                          stepSize=0.1, subsamplingRate=0.7, seed=SEED))
    return MLPipeline(stages=[*categorical_stages(), gbt_b]).fit(_with_categories(train))


def score_categorical(model, df: DataFrame, name: str = "lightgbm") -> DataFrame:
    return model.transform(_with_categories(df)).select(
        "atleta_id", "rodada_alvo", F.greatest(F.col("prediction"), F.lit(0.0)).alias("pontuacao_prevista"),
        F.lit(name).alias("modelo"))


def score_poisson(fitted, df: DataFrame, name: str = "poisson") -> DataFrame:
    model, priors = fitted
    return score(model, poisson_inputs(df, priors), name=name)


def _side_by_side(df: DataFrame, calls: list[Callable[[], DataFrame]]) -> DataFrame:
    """The results of ``calls``, each run by a driver thread of its own, stacked in their order."""
    one = inheritable_thread_target(df.sparkSession)(lambda call: call())
    with ThreadPool(len(calls)) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, calls, chunksize=1))


def predict_all(train: DataFrame, rows: DataFrame, max_iter: int = 30, searched: tuple[dict, dict] | None = None) -> DataFrame:
    """L03 + L04 + L05 fitted on ``train`` side by side, their predictions of ``rows`` stacked.

    ``searched``: the settings that L09 found for the two boosters.
    """
    one, two = searched or (None, None)
    return _side_by_side(train, [
        lambda: score(fit_gbt(train, one, **({} if one else {"max_iter": max_iter, "max_depth": 4})), rows, name="xgboost"),
        lambda: score_categorical(fit_gbt_categorical(train, max_iter=max_iter, params=two), rows),
        lambda: score_poisson(fit_poisson(train), rows)])


def out_of_fold(matrix: DataFrame, n_splits: int = 2, max_iter: int = 30, searched: tuple[dict, dict] | None = None) -> DataFrame:
    """Every model's predictions of rounds that it was not fitted on.

    Past rounds are predicted by fits on the earlier rounds of expanding folds
    (L08), rows without a target by fits on all past rounds.  Every fit and
    score is a distributed job.  A fit is hundreds of short jobs one after the
    other, so the fits of all folds (a handful) run side by side.
    """
    train, rows = split(matrix)
    folds = time_folds(train, "rodada_alvo", n_splits)
    rounds = {}
    for r in folds.collect():                       # one row per fold, round and role
        rounds.setdefault(r["fold"], {}).setdefault(r["papel"], []).append(r["rodada_alvo"])
    more = {"searched": searched} if searched else {}
    parts = [(train, rows)]
    for f in sorted(rounds):
        parts.append(tuple(train.filter(F.col("rodada_alvo").isin(rounds[f].get(role, []))) for role in ("train", "test")))
    return _side_by_side(train, [lambda past=past, test=test: predict_all(past, test, max_iter, **more) for past, test in parts])


def position_priors(train: DataFrame) -> DataFrame:
    """A10 for the GLM: mean and std of the realised score per position."""
    return train.groupBy("posicao_id").agg(F.avg(TARGET).alias("prior_media"),
                                           F.stddev_samp(TARGET).alias("prior_std"))


def poisson_inputs(df: DataFrame, priors: DataFrame) -> DataFrame:
    """GLM design: features + position prior + position one-hots (first dropped)."""
    from pitchlake.functions.expressions import one_hot
    x = df.join(F.broadcast(priors.select("posicao_id", "prior_media")), "posicao_id", "left") \
        .fillna({"prior_media": 0.0})
    return x.select("*", *one_hot(F.col("posicao_id"), [1, 2, 3, 4, 5, 6], "pos", drop_first=True))


POISSON_COLS = ("media_pontos_geral", "media_ultimas_5", "media_ultimas_3", "desvio_padrao_pontos",
                "total_jogos", "aproveitamento_campo", "clube_posicao_tabela", "adversario_posicao_tabela",
                "prior_media", "mando_casa", "classico", "pos_2", "pos_3", "pos_4", "pos_5", "pos_6")


def fit_poisson(train: DataFrame, alpha: float = GLM.ALPHA, l1: float = GLM.L1):
    """Log-link Poisson GLM on clip(y, 0) with an elastic net."""
    priors = position_priors(train)
    return GLM.fit(poisson_inputs(train, priors), POISSON_COLS, TARGET, alpha, l1), priors


def score(model, df: DataFrame, cols=FEATURES, name: str = "modelo") -> DataFrame:
    """Distributed batch scoring, predictions clipped at 0."""
    x = df if "features" in df.columns or isinstance(model, GLM.PoissonModel) else assemble(df, cols)
    return model.transform(x).select("atleta_id", "rodada_alvo",
                                     F.greatest(F.col("prediction"), F.lit(0.0)).alias("pontuacao_prevista"),
                                     F.lit(name).alias("modelo"))


def feature_importance(model, cols=FEATURES) -> DataFrame:
    """Tree feature importances, largest first."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(c, float(v)) for c, v in zip(cols, imp)], "feature string, importancia double")
    return df.orderBy(F.col("importancia").desc(), "feature")


#: Rows among which a feature is shuffled (a window each).
SHUFFLE_ROWS = 50_000


def permutation_importance(model, df: DataFrame, cols=FEATURES, seed: str = "l10") -> DataFrame:
    """Rise of the RMSE when one feature is shuffled among the rows.

    A row takes the feature of the next row in the order of a seeded hash, in
    blocks of about ``SHUFFLE_ROWS`` rows (the last takes the first one's).
    All features are scored in one pass: each row appears once as it is and
    once per shuffled feature.
    """
    keys = ("atleta_id", "rodada_alvo")
    n_blocks = max(1, df.count() // SHUFFLE_ROWS)
    x = df.select(*keys, TARGET, *cols).withColumn("_b", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(n_blocks)))
    for c in cols:
        w = Window.partitionBy("_b").orderBy(F.xxhash64(*keys, F.lit(f"{seed}/{c}")), *keys)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        x = x.withColumn(f"_s_{c}", F.coalesce(F.lead(c).over(w), F.first(c).over(whole)))
    variants = F.array(*[F.struct(F.lit(v).alias("feature"), *[F.col(f"_s_{c}" if c == v else c).alias(c) for c in cols])
                         for v in ("", *cols)])
    rows = x.select(TARGET, F.inline(variants))
    scored = model.transform(assemble(rows, cols)).groupBy("feature").agg(
        F.sqrt(F.avg((F.col("prediction") - F.col(TARGET)) ** 2)).alias("rmse"))
    base = scored.filter("feature = ''").select("rmse").scalar()
    return (scored.filter("feature <> ''").select("feature", "rmse", (F.col("rmse") - base).alias("aumento_rmse"))
            .orderBy(F.desc("aumento_rmse"), "feature"))
