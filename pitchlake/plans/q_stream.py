"""Queries: streaming operators.

All of them run a real stream end to end: the events are landed as JSON
folders per day under the session's shared checkpoint directory, consumed
with ``availableNow``, and the sink is read back.
"""

from __future__ import annotations

import os


from pitchlake.plans.queries import query
from pitchlake.streaming import pipeline as S


def _landed(p):
    base = S.scratch(p.spark, "stream")
    src = os.path.join(base, "landing")
    S.land_events_by_day(p.t.events, src)
    return base, src


STREAM_SCHEMA = S.EVENT_SCHEMA + ", dia STRING"


@query("st1_bronze_stream")
def _(p):
    base, src = _landed(p)
    out, ckpt = os.path.join(base, "bronze"), os.path.join(base, "_ckpt_bronze")
    S.bronze_stream(p.spark, src, STREAM_SCHEMA, out, ckpt, max_files=8).awaitTermination()
    return p.spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


@query("st2_silver_stream")
def _(p):
    base, src = _landed(p)
    out, ckpt = os.path.join(base, "silver"), os.path.join(base, "_ckpt_silver")
    stream = (p.spark.readStream.schema(STREAM_SCHEMA).option("timestampNTZFormat", S.TS_FORMAT)
              .option("maxFilesPerTrigger", 8).json(src))
    q = (S.silver_stream(stream).writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).outputMode("append").start(out))
    q.awaitTermination()
    return p.spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


@query("st3_stream_merge")
def _(p):
    """ST3: newest event per user after merging every micro-batch."""
    base, src = _landed(p)
    out, ckpt = os.path.join(base, "silver_merge"), os.path.join(base, "_ckpt_merge")
    stream = (p.spark.readStream.schema(STREAM_SCHEMA).option("timestampNTZFormat", S.TS_FORMAT)
              .option("maxFilesPerTrigger", 4).json(src))
    S.stream_merge(stream.drop("dia"), out, ["user_id"], ckpt, order=["ts", "event_id"]).awaitTermination()
    return S.latest_table(p.spark, out).select("event_id", "ts", "user_id", "event_type", "value", "props")


def _windowed(p, name, gold):
    base, src = _landed(p)
    stream = (p.spark.readStream.schema(STREAM_SCHEMA).option("timestampNTZFormat", S.TS_FORMAT)
              .option("maxFilesPerTrigger", 8).json(src))
    S.windowed_stream(stream.drop("dia"), os.path.join(base, name), os.path.join(base, f"_ckpt_{name}"), gold).awaitTermination()
    return p.spark.read.parquet(os.path.join(base, name, "gold")).drop("_day")


@query("st4_gold_stream")
def _(p):
    """ST4: daily totals after all micro-batches."""
    return _windowed(p, "st4", S.gold_daily)


@query("st5_cadence_15min")
def _(p):
    """ST5: 15-minute capture buckets after all micro-batches."""
    return _windowed(p, "st5", S.status_buckets)
