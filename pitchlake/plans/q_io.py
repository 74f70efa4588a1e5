"""Queries: landed JSON round trips and file/schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchlake.plans.queries import query
from pitchlake.sources import bindings as B
from pitchlake.sources import contracts as C
from pitchlake.sources import landing as L

INGEST_TS = "2024-02-01 00:00:00"


@query("s01_land_market_status")
def _(p):
    return L.flatten_status(B.landed_status(p.t)).drop("_raw_json")


@query("s02_land_athletes")
def _(p):
    return L.explode_athletes(B.landed_athletes(p.t)).drop("_raw_json")


@query("s03_land_scored")
def _(p):
    return L.explode_scored(B.landed_scored(p.t))


@query("s04_land_matches")
def _(p):
    return L.explode_matches(B.landed_matches(p.t))


@query("s05_land_clubs")
def _(p):
    return L.explode_clubs(B.landed_clubs(p.t))


@query("s06_land_rounds")
def _(p):
    return L.explode_rounds(B.landed_rounds(p.t))


@query("s07_land_highlights")
def _(p):
    return L.flatten_highlights(B.landed_highlights(p.t))


@query("s08_land_leagues")
def _(p):
    return L.explode_leagues(B.landed_leagues(p.t))


@query("s09_add_ingest_metadata")
def _(p):
    ev = p.t.events.select("event_id", "user_id", "event_type")
    return L.add_metadata(ev, "b-0001", INGEST_TS, "eventos")


@query("s10_batch_load")
def _(p):
    from pitchlake.sources.io import ingest_to_bronze
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    df = ingest_to_bronze(p.spark, f"{p.sf_dir}/events.parquet", "parquet", schema,
                          batch_id="b-0001", ingest_ts=INGEST_TS, source="eventos")
    return df.drop("_source_file", "_raw_json")


@query("s16_evolve_schema")
def _(p):
    target = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DECIMAL(12,2), "
              "o_orderdate DATE, o_orderpriority STRING, o_clerk STRING")
    src = p.t.orders.withColumn("o_ano", F.year("o_orderdate"))
    return C.conform(src, target)


@query("s17_migrate_types")
def _(p):
    declared = {"l_orderkey": "NUMBER(38,0)", "l_quantity": "NUMBER(12,2)", "l_linenumber": "TINYINT",
                "l_returnflag": "CHAR(1)", "l_linestatus": "VARCHAR(1)", "l_shipdate": "DATE"}
    li = p.t.lineitem.select(*declared.keys())
    return C.convert_schema(li, declared)


@query("s20_enforce_contract")
def _(p):
    return C.enforce_contract(p.raw_atletas_mercado, C.RAW_ATLETAS_MERCADO)


# ------------------------------------------------------------------ sinks (write, then read back)
def _scratch(p, name):
    from pitchlake.streaming.pipeline import scratch
    return scratch(p.spark, name)


@query("s11_stream_load")
def _(p):
    """Incremental file ingest (parquet drops, one folder per day) with a
    checkpoint and a run-to-completion trigger; the bronze table is read back."""
    import os
    from pitchlake.streaming.pipeline import EVENT_SCHEMA, bronze_stream
    base = _scratch(p, "s11")
    src = os.path.join(base, "landing")
    p.t.events.withColumn("dia", F.to_date("ts").cast("string")).write.partitionBy("dia").parquet(src)
    out = os.path.join(base, "bronze")
    bronze_stream(p.spark, src, EVENT_SCHEMA + ", dia STRING", out, os.path.join(base, "_ckpt"),
                  fmt="parquet", max_files=8).awaitTermination()
    return p.spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("s13_append_sink")
def _(p):
    """Two partitioned appends (first and second half of the month)."""
    from pitchlake.sources.io import append
    out = _scratch(p, "s13")
    ev = p.t.events.withColumn("event_date", F.to_date("ts"))
    append(ev.filter(F.dayofmonth("ts") <= 15), out, ["event_date"])
    append(ev.filter(F.dayofmonth("ts") > 15), out, ["event_date"])
    return p.spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("s14_overwrite_sink")
def _(p):
    """A full overwrite replaces an earlier, different table (schema too)."""
    from pitchlake.sources.io import overwrite
    out = _scratch(p, "s14")
    overwrite(p.t.orders.select("o_orderkey", F.col("o_totalprice").alias("preco")), out)
    overwrite(p.t.orders, out)
    return p.spark.read.parquet(out)


@query("s15_replace_partitions")
def _(p):
    """The athlete fact partitioned by round; the last two rounds are
    rebuilt from a fresh computation and replaced partition-wise."""
    from pitchlake.sources.io import replace_partitions
    out = _scratch(p, "s15")
    f = p.fct_atletas_rodada.drop("_ingestao_timestamp")
    replace_partitions(f.withColumn("pontos_num", F.lit(-1.0)), out, ["rodada_id"])      # stale first load
    last = f.agg(F.max("rodada_id")).scalar()
    replace_partitions(f, out, ["rodada_id"])                                              # full reload
    replace_partitions(f.filter(F.col("rodada_id") >= last - 1), out, ["rodada_id"])      # idempotent re-run
    return p.spark.read.parquet(out).select("atleta_id", "rodada_id", "pontos_num", "preco_num")


@query("s18_bucketed_write")
def _(p):
    """Orders and customers bucketed (and sorted) by customer key into
    external tables; the join of the two reads matching buckets without a
    shuffle."""
    import os
    import uuid
    from pitchlake.sources.io import write_bucketed
    base = _scratch(p, "s18")
    suffix = uuid.uuid4().hex[:8]
    o_t, c_t = f"pl_orders_b_{suffix}", f"pl_customer_b_{suffix}"
    o = p.t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = p.t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    n = int(p.spark.conf.get("spark.sql.shuffle.partitions"))       # follows the cluster and the data
    write_bucketed(o, o_t, ["o_custkey"], n, ["o_custkey"], path=os.path.join(base, "orders"))
    write_bucketed(c, c_t, ["o_custkey"], n, ["o_custkey"], path=os.path.join(base, "customer"))
    return p.spark.table(o_t).join(p.spark.table(c_t), "o_custkey")


@query("s19_batched_copy")
def _(p):
    """Partition-by-partition copy as one partitioned write, validated."""
    from pitchlake.sources.io import copy_by_partition
    o = p.t.orders.withColumn("o_ano", F.year("o_orderdate"))
    return copy_by_partition(o, _scratch(p, "s19"), ["o_ano"])
