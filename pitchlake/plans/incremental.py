"""M03 over the whole DAG: a refresh re-opens the rounds that changed inputs can reach, and no others.

Every layer is a table partitioned by round.  A refresh goes through the layers
in dependency order and keeps, per layer, the set of rounds whose rows changed:

1. Which rounds to look at: those that a changed round of an input can reach
   (``REACH``).  Sources are compared as a whole, round by round.
2. The layer's rows of these rounds are built once and written aside.
3. Rounds whose rows equal the stored ones (compared by count and by sums of
   two 64-bit row hashes) are left alone: their files stay, and nothing that
   depends on them is re-opened.  The others replace their partitions.

So a late score costs the rounds it reaches, a second refresh writes nothing,
and the tables equal a full build.  Rounds may change and be added; a round
that vanishes from its source keeps its rows.  A refresh that failed halfway is
run again: layers that it finished compare equal, and the changes that it had
found are kept in the folder ``_open`` until it ends, so what depends on them
is still re-opened.  The driver holds round numbers, never rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.plans.pipeline import Pipeline
from pitchlake.session import scratch_path
from pitchlake.sources import io as IO


@dataclass(frozen=True)
class Layer:
    """A property of the pipeline, its round column, and how far changed rounds of its inputs reach."""

    name: str
    by: str
    inputs: dict[str, str] = field(default_factory=dict)


#: same: the round itself; next: the round and the one after; from: all rounds from the one before it on
#: (what was the newest round changes when a newer one arrives).
REACH = {
    "same": lambda changed, rounds: changed,
    "next": lambda changed, rounds: changed | {r + 1 for r in changed},
    "from": lambda changed, rounds: {r for r in rounds if r >= max([x for x in rounds if x < min(changed)], default=min(changed))},
}

LAYERS = (
    Layer("stg_atletas_mercado", "_rodada_captura"),
    Layer("stg_atletas_pontuados", "rodada_id"),
    Layer("stg_partidas", "rodada_id"),
    Layer("fct_atletas_rodada", "rodada_id", {"stg_atletas_mercado": "same", "stg_atletas_pontuados": "same"}),
    Layer("fct_partidas", "rodada_id", {"stg_partidas": "same"}),
    Layer("tabela_liga", "rodada_id", {"fct_partidas": "from"}),
    Layer("metricas_clube_rodada", "rodada_id", {"fct_atletas_rodada": "same", "fct_partidas": "same", "tabela_liga": "same"}),
    Layer("training_features", "rodada_alvo", {"fct_atletas_rodada": "from", "fct_partidas": "same", "tabela_liga": "next"}),
)


def fingerprints(df: DataFrame | None, by: str) -> dict[int, tuple]:
    """Per round: rows, and sums of two hashes of them (in any order)."""
    if df is None:
        return {}
    cols = [F.col(c) for c in sorted(df.columns)]
    one, two = F.xxhash64(*cols), F.xxhash64(F.lit("m03"), *cols)
    nulls = F.xxhash64(*[c.isNull() for c in cols])                    # a null is skipped by the hash
    add = lambda h: F.sum(F.xxhash64(h, nulls).cast("decimal(38,0)"))
    rows = df.groupBy(by).agg(F.count(F.lit(1)), add(one), add(two)).collect()     # a row per round
    return {r[0]: tuple(r[1:]) for r in rows if r[0] is not None}


def _pending(spark: SparkSession, out: str) -> dict[str, set[int]]:
    """Changed rounds that a refresh found and did not carry through."""
    found = IO.read_if_exists(spark, f"{out}/_open")
    out_: dict[str, set[int]] = {}
    for r in found.collect() if found is not None else []:
        out_.setdefault(r["layer"], set()).add(r["round"])
    return out_


def _note(spark: SparkSession, out: str, rows: list[tuple[str, int]], mode: str) -> None:
    spark.createDataFrame(rows, "layer string, round int").coalesce(1).write.mode(mode).parquet(f"{out}/_open")


def refresh(p: Pipeline, out: str) -> DataFrame:
    """Bring the tables under ``out`` up to ``p``; one row per layer and round that was looked at: layer, round, state."""
    spark = p.spark
    pending = _pending(spark, out)
    changed: dict[str, set[int]] = {}
    report: list[tuple[str, int, str]] = []
    for layer in LAYERS:
        path = f"{out}/{layer.name}"
        df = getattr(p, layer.name).filter(F.col(layer.by).isNotNull())
        kept = IO.read_if_exists(spark, path)
        kept = None if kept is None else kept.select(*[F.col(c).cast(k).alias(c) for c, k in df.dtypes])
        stored = fingerprints(kept, layer.by)
        moved = set(pending.get(layer.name, ()))
        opened = None
        if layer.inputs and stored:
            rounds = set(stored).union(*(changed[i] for i in layer.inputs))
            opened = set().union(*(REACH[how](changed[i], rounds) for i, how in layer.inputs.items() if changed[i]))
        if opened is None or opened:
            if opened is not None:
                df = df.filter(F.col(layer.by).isin(sorted(opened)))
            aside = scratch_path(spark, f"m03-{layer.name}-{uuid.uuid4().hex[:12]}")
            df.write.parquet(aside)
            built = spark.read.schema(df.schema).parquet(aside)
            new = fingerprints(built, layer.by)
            differ = sorted(r for r, f in new.items() if stored.get(r) != f)
            if differ:
                _note(spark, out, [(layer.name, r) for r in differ], "append")     # before the table changes
                IO.replace_partitions(built.filter(F.col(layer.by).isin(differ)), path, [layer.by])
            moved |= set(differ)
            report += [(layer.name, r, "rewritten" if r in differ else "kept") for r in sorted(new)]
        changed[layer.name] = moved
        table = spark.read.parquet(path)
        p.__dict__[layer.name] = table.select(*[F.col(c).cast(k).alias(c) for c, k in df.dtypes])   # what later layers read
    if any(changed.values()):
        _note(spark, out, [], "overwrite")
    return spark.createDataFrame(report, "layer string, round int, state string")
