"""Registry of the operator queries (``queries()`` of the driver contract).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
Double columns are rounded to 6 digits at the very end so results compare
exactly with the DuckDB oracle regardless of summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from pitchlake.plans.pipeline import Pipeline

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BUILDERS: dict[str, Callable] = {}     # key -> fn(Pipeline) (unwrapped, for plan studies)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column to ``digits`` (final projection only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


#: Plans that would scan the raw tables more than six times (the shared inputs feed many
#: branches); ``Tables.shared`` writes those inputs once.  All other plans are lazy scans.
SHARED = frozenset("""
    a09_standings_cumulative a12_coverage_by_position a13_interval_coverage a15_coverage_pivot a16_model_distribution
    a31_model_comparison f04_binary_encode j05_opponent_lookup j07_role_playing j09_target_join j10_club_result_join
    j12_three_way_left l00_feature_store l02_design_matrix l03_boosted_trees_a l04_boosted_trees_b l05_poisson_glm l05_glm_coefficients
    l07_overdispersed_interval l09_param_search l09_param_search_b l09_trial_plan l10_feature_importance l11_batch_score l12_prediction_table
    l13_select_model l14_ensemble_predict l15_ensemble_coverage_col l16_final_pick_table l18_backtest p02_match_result
    p14_total_goals q11_declared_model_tests t02_top_per_position t04_top20_value u02_label_concat u03_layer_counts
    w04_rank_in_position""".split())


def query(key: str, digits: int | None = 6):
    """Register ``fn(p: Pipeline) -> DataFrame`` under ``key``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Pipeline(spark, sf_dir, share=key in SHARED))
            return round_doubles(df, digits) if digits is not None else df
        BUILDERS[key] = fn
        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        REGISTRY[key] = run
        return fn
    return deco


# Importing the query modules fills the registry.
def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from pitchlake.plans import q_bronze, q_core, q_io, q_meta, q_ml, q_more, q_ops, q_stream  # noqa: F401
    return REGISTRY
