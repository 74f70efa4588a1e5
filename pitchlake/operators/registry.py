"""Run registry - metrics of model runs, logged once and compared by version.

The registry is a table of (model, version, run_id, metric, value, logged_at),
partitioned by model and metric.  A run's metric is logged once: rows whose
(model, run_id, metric) is there already, or stands twice in one call, are not
added again, so a retried job leaves one row.  The check reads the three key
columns; rows are appended, and nothing is rewritten.

Comparison needs no window over all runs of a model: every version is first
reduced to its best run, and versions are what the windows run over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.sources import io as IO

KEYS = ["model", "run_id", "metric"]
COLUMNS = ["model", "version", "run_id", "metric", "value", "logged_at"]
SCHEMA = "model string, version int, run_id string, metric string, value double, logged_at timestamp_ntz"
#: Metrics of which less is better; of all others more is.
LESS_IS_BETTER = ("rmse", "mae", "deviance", "duration_minutes")


def long_metrics(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """Runs with one column per metric -> one row per run and metric (nulls left out)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    keep = [c for c in runs.columns if c not in metrics]
    return runs.select(*keep, pairs.alias("_p")).select(*keep, "_p.*").filter("value IS NOT NULL")


def log_run(base: str, rows: DataFrame) -> DataFrame:
    """Append the metrics of ``rows`` (``COLUMNS``) that are not logged yet; returns the registry."""
    spark = rows.sparkSession
    new = rows.select(*[F.col(c).cast(k).alias(c) for c, k in (x.split() for x in SCHEMA.split(", "))])
    new = new.filter("model IS NOT NULL AND run_id IS NOT NULL AND metric IS NOT NULL")
    new = new.groupBy(*KEYS).agg(F.min_by(F.struct("version", "value", "logged_at"), F.struct("logged_at", "version", "value")).alias("_r")) \
        .select(*KEYS, "_r.*").select(*COLUMNS)
    old = registry(spark, base)
    if old is not None:
        new = new.join(old.select(*KEYS), KEYS, "left_anti")
    IO.append(new, base, ["model", "metric"])
    return registry(spark, base)


def registry(spark: SparkSession, base: str) -> DataFrame | None:
    """The registry at ``base`` (None before the first run)."""
    # with its schema: names of models such as 007 are no numbers
    return None if IO.read_if_exists(spark, base) is None else spark.read.schema(SCHEMA).parquet(base).select(*COLUMNS)


def _goodness() -> Column:
    return F.when(F.col("metric").isin(*LESS_IS_BETTER), -F.col("value")).otherwise(F.col("value"))


def compare_runs(reg: DataFrame) -> DataFrame:
    """One row per model, metric and version: its best run, the change against the version before, and whether it is the best.

    Ties go to the lower run_id within a version, and to the newer version.
    """
    order = F.struct((-_goodness()).alias("g"), F.col("run_id"))
    best = reg.groupBy("model", "metric", "version").agg(
        F.count(F.lit(1)).alias("runs"), F.min_by(F.struct("run_id", "value"), order).alias("_b")).select(
        "model", "metric", "version", "runs", "_b.run_id", "_b.value")
    w = Window.partitionBy("model", "metric")
    first = F.row_number().over(w.orderBy(_goodness().desc(), F.col("version").desc())) == 1
    return best.select("*", (F.col("value") - F.lag("value").over(w.orderBy("version"))).alias("change"), first.alias("is_best"))


def best_version(reg: DataFrame, metric: str) -> DataFrame:
    """The version of each model that a deployment takes: the best by ``metric``."""
    return compare_runs(reg.filter(F.col("metric") == metric)).filter("is_best").select("model", "version", "run_id", "value")
