"""Structured Streaming ingestion (ST1-ST5).

Every transformation is a plain DataFrame function, so the same code runs
on a streaming frame (``readStream``) and on a batch frame (the "batch
twin").  No row is dropped for arriving late or out of order.  Sinks are
checkpointed and idempotent so a restarted query (lost executor, failed
driver) resumes from its checkpoint without duplicating rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pitchlake.operators import merge as M
from pitchlake.sources import io as IO
from pitchlake.streaming import keyed_table as KT

# JSON keeps microseconds only with an explicit pattern (the default stops at ms).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
EVENT_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                "value DOUBLE, props STRING")


# ------------------------------------------------------------------ ST1
def bronze_stream(spark: SparkSession, src: str, schema: StructType | str, out: str, ckpt: str,
                  fmt: str = "json", max_files: int | None = None) -> StreamingQuery:
    """ST1: new files in ``src`` -> bronze parquet with lineage columns.

    Runs to completion over whatever is new (``availableNow``), which is how
    a scheduled 15-minute job consumes a landing folder; the checkpoint
    records the files already ingested.
    """
    r = spark.readStream.schema(schema).format(fmt).option("timestampNTZFormat", TS_FORMAT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.load(src)
    df = df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                   F.current_timestamp().alias("_ingestao_timestamp"))
    return (df.writeStream.format("parquet").option("checkpointLocation", ckpt)
            .trigger(availableNow=True).outputMode("append").start(out))


# ------------------------------------------------------------------ ST2
SILVER_RULES = {"valor_positivo": "value > 0", "tipo_conhecido":
                "event_type IN ('view', 'click', 'purchase', 'signup', 'error')"}


def silver_stream(df: DataFrame, key: str = "event_id", ts: str = "ts", delay: str | None = None,
                  rules: dict[str, str] | None = None) -> DataFrame:
    """ST2: typed, cleaned, expectation-filtered, de-duplicated by key.

    Without ``delay`` de-duplication is exact for files in any order (a
    backlog is read by modification time, not by event time): the state has
    one entry per key, split over the shuffle partitions; on a cluster keep it
    in the RocksDB state store.  With ``delay`` the state is bounded, and rows
    later than ``delay`` behind the newest are dropped: only for feeds whose
    order is known.
    """
    conds = [F.coalesce(F.expr(r), F.lit(False)) for r in (rules or SILVER_RULES).values()]
    ok = conds[0]
    for c in conds[1:]:
        ok = ok & c
    clean = df.filter(F.col(key).isNotNull() & ok).withColumn("event_type", F.lower(F.trim("event_type")))
    if df.isStreaming and delay:
        # watermarks need a TIMESTAMP (not TIMESTAMP_NTZ) event-time column
        return (clean.withColumn("_event_time", F.col(ts).cast("timestamp"))
                .withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key])
                .drop("_event_time"))
    return clean.dropDuplicates([key])


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the watermarks of a finished query have dropped."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for op in p["stateOperators"])


# ------------------------------------------------------------------ ST3
def stream_merge(df: DataFrame, out: str, keys: list[str], ckpt: str, order: list[str] | None = None,
                 rows_per_bucket: int = KT.ROWS_PER_BUCKET) -> StreamingQuery:
    """ST3: upsert every micro-batch into a silver table of key buckets.

    Each batch is de-duplicated (M11) and merged (M01) with the leaves of the
    keyed table that its keys fall in; only those are written again, and split
    when they pass ``rows_per_bucket``.  A batch id that is published already
    (replay after a restart) is skipped, so the sink is idempotent.  With
    ``order`` the newest row per key wins across batches, so late files cannot
    overwrite newer rows.
    """
    from pitchlake.operators.windows import latest_per_key

    def combine(current: DataFrame, new: DataFrame) -> DataFrame:
        return latest_per_key(current.unionByName(new), keys, order) if order else M.merge_upsert(current, new, keys)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        src = M.dedupe_source(batch, keys, order) if order else batch.dropDuplicates(keys)
        KT.merge(src, out, batch_id, keys, combine, rows_per_bucket)

    return (df.writeStream.foreachBatch(upsert).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def latest_table(spark: SparkSession, out: str) -> DataFrame | None:
    """The table written by :func:`stream_merge` (None before the first batch)."""
    cur = KT.read(spark, out)
    return None if cur is None else cur.drop(KT.CODE, KT.VERSION)


# ------------------------------------------------------------------ ST4 / ST5
def gold_daily(df: DataFrame, ts: str = "ts") -> DataFrame:
    """ST4: daily tumbling-window events, purchase revenue and distinct users (exact)."""
    g = df.groupBy(F.window(F.col(ts), "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("eventos"),
        F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)), 2)
        .alias("receita"),
        F.countDistinct("user_id").alias("usuarios"))
    return g.select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"),
                    "eventos", "receita", "usuarios")


def status_buckets(df: DataFrame, ts: str = "ts", minutes: int = 15) -> DataFrame:
    """ST5: one history row per 15-minute capture bucket: captures and the
    last captured status in the bucket."""
    g = df.groupBy(F.window(F.col(ts), f"{minutes} minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("capturas"),
        F.max_by(F.col("event_type"), F.struct(F.col(ts), F.col("event_id"))).alias("ultimo_status"))
    return g.select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"),
                    "capturas", "ultimo_status")


def windowed_stream(df: DataFrame, base: str, ckpt: str, gold, ts: str = "ts") -> StreamingQuery:
    """ST4/ST5 as a stream: late and unordered files included, nothing dropped.

    A micro-batch is added to ``base/silver`` (partitioned by event day and
    batch, so a replay overwrites its own rows), then ``gold`` is computed
    again for the days it touches, from all their rows, and these days of
    ``base/gold`` are replaced.  Windows lie inside a day.
    """
    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.to_date(ts).cast("string")
        IO.replace_partitions(batch.withColumn("_day", day).withColumn("_batch", F.lit(batch_id)),
                              f"{base}/silver", ["_day", "_batch"])
        silver = spark.read.parquet(f"{base}/silver")
        days = silver.filter(F.col("_batch") == batch_id).select("_day").distinct()     # bounded by the calendar
        touched = silver.join(F.broadcast(days), "_day", "left_semi").drop("_day", "_batch")
        out = gold(touched).withColumn("_day", F.to_date("inicio").cast("string"))
        IO.replace_partitions(out, f"{base}/gold", ["_day"])

    return (df.writeStream.foreachBatch(refresh).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


# ------------------------------------------------------------------ run helpers
def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    from pitchlake.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def land_events_by_day(events: DataFrame, path: str) -> None:
    """Test/driver helper: split events into one JSON folder per day so a
    stream sees them as successive file drops."""
    events.withColumn("dia", F.to_date("ts").cast("string")).write.mode("overwrite") \
        .option("timestampNTZFormat", TS_FORMAT).partitionBy("dia").json(path)
