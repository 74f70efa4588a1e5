"""Run the whole medallion DAG, writing every layer once.

This is how the library runs at scale: each layer is written as a parquet
table (partitioned where the reference partitions) under a shared folder --
by default below the session's ``spark.checkpoint.dir`` -- and every
downstream layer reads the written table back.  Lineage is cut at each
layer, a lost executor only re-runs tasks of the current layer, and every
input is scanned once per layer instead of once per consumer.

    python -m pitchlake.plans.run /root/testdata/sf0.01 [out_dir]
"""

from __future__ import annotations

import sys
import time
import uuid

from pyspark.sql import SparkSession

from pitchlake.plans.landed import BRONZE_LAYERS, LANDED_LAYERS, LandedPipeline
from pitchlake.plans.pipeline import Pipeline, TrainedPipeline
from pitchlake.session import scratch_path
from pitchlake.sources import io as IO

# (property of Pipeline, partition columns) in dependency order
LAYERS = (
    ("stg_atletas_mercado", ["_rodada_captura"]),     # staging
    ("stg_atletas_pontuados", ["rodada_id"]),
    ("stg_partidas", ["rodada_id"]),
    ("stg_partidas_proxima", None),
    ("clubes", None),
    ("classicos", None),
    ("fct_atletas_rodada", ["rodada_id"]),            # silver
    ("fct_partidas", ["rodada_id"]),
    ("fct_partidas_proxima", None),
    ("dim_atletas", None),
    ("dim_clubes", None),
    ("tabela_liga", ["rodada_id"]),            # gold
    ("metricas_atleta", None),
    ("metricas_clube_rodada", ["rodada_id"]),
    ("feature_store", None),
    ("training_features", ["rodada_alvo"]),
    ("mp_wide", None),                                # predictions and meta-model
    ("mp_long", None),
    ("history", None),
    ("selection", None),
    ("previsao_final", None),
    ("previsao_final_ranked", None),
)


class _TrainedLanded(TrainedPipeline, LandedPipeline):
    """Fitted models on landed payloads."""


def run_dag(spark: SparkSession, sf_dir: str, out: str | None = None, trained: bool = True, landed: bool = False) -> dict[str, str]:
    """Materialise every layer; returns {layer: path}.

    With ``landed`` the DAG begins at the landed payloads: eight bronze tables
    are written first, the staging views read them, and rounds, market status
    and highlights are layers too.

    With ``trained`` the models are fitted, and history, selection, ensemble
    and picks come from their out-of-fold predictions; otherwise from the
    deterministic rolling-mean baselines.
    """
    out = out or scratch_path(spark, f"dag-{uuid.uuid4().hex[:12]}")
    kind = (_TrainedLanded if landed else TrainedPipeline) if trained else (LandedPipeline if landed else Pipeline)
    p = kind(spark, sf_dir)
    paths = {}
    for name, parts in (*BRONZE_LAYERS, *LAYERS, *LANDED_LAYERS) if landed else LAYERS:
        df = getattr(p, name)
        path = f"{out}/{name}"
        if parts:
            IO.replace_partitions(df, path, parts)
        else:
            IO.overwrite(df, path)
        # downstream layers now read the written table (cached_property slot)
        p.__dict__[name] = spark.read.parquet(path)
        paths[name] = path
    return paths


def main() -> None:
    from pitchlake.session import get_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    spark.sparkContext.setLogLevel("ERROR")
    t0 = time.time()
    paths = run_dag(spark, sf_dir, sys.argv[2] if len(sys.argv) > 2 else None)
    print(f"{len(paths)} layers written in {time.time() - t0:.1f}s")
    for k, v in paths.items():
        print(f"  {k}: {v}")


if __name__ == "__main__":
    main()
