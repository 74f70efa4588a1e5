"""Landed JSON round trips, file sinks and a restartable stream."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import merge as M
from pitchlake.operators.windows import latest_per_key
from pitchlake.sources import bindings as B
from pitchlake.sources import io as IO
from pitchlake.sources import landing as L
from pitchlake.sources.tables import Tables
from pitchlake.streaming import keyed_table as KT
from pitchlake.streaming import pipeline as S

from sf_paths import SF_SMALL


def test_scored_map_round_trip(spark):
    t = Tables(spark, SF_SMALL)
    back = L.explode_scored(B.landed_scored(t)).drop("apelido")
    orig = B.scored_athletes(t)
    assert back.count() == orig.count()
    assert back.exceptAll(orig.select(*back.columns)).count() == 0


def test_status_defaults(spark):
    p = spark.createDataFrame([('{"rodada_atual": 3, "fechamento": {"dia": 1, "timestamp": 5}}',)], "payload string")
    r = L.flatten_status(p).collect()[0]
    assert r.cartoleta_inicial == 0.0 and r.game_over is False and r.fechamento_dia == 1


def test_replace_partitions_is_idempotent(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "r int, v string")
    IO.append(df, out, ["r"])
    IO.replace_partitions(spark.createDataFrame([(2, "B")], "r int, v string"), out, ["r"])
    IO.replace_partitions(spark.createDataFrame([(2, "B")], "r int, v string"), out, ["r"])
    assert sorted((x.r, x.v) for x in spark.read.parquet(out).collect()) == [(1, "a"), (2, "B")]


def test_stream_merge_restart_equals_batch(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events
    src = os.path.join(tmpdir_path, "landing")
    S.land_events_by_day(ev.filter(F.dayofmonth("ts") <= 15), src)         # first file drop
    out, ckpt = os.path.join(tmpdir_path, "silver"), os.path.join(tmpdir_path, "ckpt")
    schema = S.EVENT_SCHEMA + ", dia STRING"

    def run():
        st = (spark.readStream.schema(schema).option("timestampNTZFormat", S.TS_FORMAT)
              .option("maxFilesPerTrigger", 3).json(src)).drop("dia")
        S.stream_merge(st, out, ["user_id"], ckpt, order=["ts", "event_id"]).awaitTermination()

    run()
    ev.filter(F.dayofmonth("ts") > 15).withColumn("dia", F.date_format("ts", "yyyy-MM-dd")) \
        .write.mode("append").option("timestampNTZFormat", S.TS_FORMAT).partitionBy("dia").json(src)
    run()                                                                    # restart from checkpoint
    got = S.latest_table(spark, out).select("event_id").collect()
    want = latest_per_key(ev, ["user_id"], ["ts", "event_id"]).select("event_id").collect()
    assert sorted(r.event_id for r in got) == sorted(r.event_id for r in want)


def _unordered_drops(spark, ev, src, files):
    """Land events in ``files`` files per day, newest day first, and one file twice."""
    ev = ev.withColumn("dia", F.to_date("ts").cast("string"))
    w = lambda df: df.write.mode("append").option("timestampNTZFormat", S.TS_FORMAT).partitionBy("dia").json(src)
    for late in (False, True):
        w(ev.filter((F.dayofmonth("ts") <= 15) == late).repartition(files))
    w(ev.filter(F.dayofmonth("ts") == 3))


def _stream(spark, src, n=5):
    return (spark.readStream.schema(S.EVENT_SCHEMA + ", dia STRING").option("timestampNTZFormat", S.TS_FORMAT)
            .option("maxFilesPerTrigger", n).json(src).drop("dia"))


@pytest.mark.parametrize("files", [1, 4])
def test_no_row_is_lost_whatever_the_file_order(spark, tmpdir_path, files):
    ev = Tables(spark, SF_SMALL).events.filter("value > 0")
    src, out = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "silver")
    _unordered_drops(spark, ev, src, files)
    q = (S.silver_stream(_stream(spark, src, 20)).writeStream.format("parquet").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(tmpdir_path, "ckpt")).start(out))
    q.awaitTermination()
    assert S.dropped_rows(q) == 0
    got = spark.read.parquet(out)
    assert got.count() == ev.count() == got.select("event_id").distinct().count()


def test_windowed_streams_equal_the_batch(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events
    src = os.path.join(tmpdir_path, "landing")
    ev.withColumn("dia", F.to_date("ts").cast("string")).repartition(3).write.option("timestampNTZFormat", S.TS_FORMAT) \
        .partitionBy("dia").json(src)
    for name, gold in (("daily", S.gold_daily), ("buckets", S.status_buckets)):
        base = os.path.join(tmpdir_path, name)
        S.windowed_stream(_stream(spark, src, 40), base, base + "-ckpt", gold).awaitTermination()
        got, want = spark.read.parquet(base + "/gold").drop("_day"), gold(ev)
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def _keyed(spark, ids, v):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v int")


def _put(batch, out, version, limit):
    KT.merge(batch, out, version, ["id"], lambda cur, new: M.merge_upsert(cur, new, ["id"]), rows_per_bucket=limit)


def test_keyed_table_splits_as_it_grows(spark, tmpdir_path):
    """Batches of new keys and updates: the table equals a dictionary, and no leaf passes the limit."""
    out, want = os.path.join(tmpdir_path, "t"), {}
    assert S.latest_table(spark, out) is None
    for v, ids in enumerate([range(5), range(3, 60), range(0, 400, 2), range(390, 400), range(350, 420)]):
        _put(_keyed(spark, ids, v), out, v, 20)
        want |= dict.fromkeys(ids, v)
        got = S.latest_table(spark, out).collect()
        assert len(got) == len(want) and {r.id: r.v for r in got} == want
        leaves = {r[KT.CODE]: r.n_rows for r in KT.leaves(spark, out).collect()}
        assert sum(leaves.values()) == len(want) and max(leaves.values()) <= 40
        assert abs(sum(2.0 ** -(c.bit_length() - 1) for c in leaves) - 1) < 1e-12      # the leaves cover every hash once
    assert len(leaves) >= 16


def test_merge_rewrites_only_touched_buckets(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "t")
    _put(_keyed(spark, range(400), 0), out, 0, 20)
    n = len(KT.leaves(spark, out).collect())
    files = set(glob.glob(out + "/data/*/*/*.parquet"))
    one = _keyed(spark, [7], 1)
    _put(one, out, 1, 20)
    _put(one, out, 1, 20)                                   # a replay
    added = set(glob.glob(out + "/data/*/*/*.parquet")) - files
    assert n >= 16 and added and {f.split("/_v=")[1][0] for f in added} == {"1"}
    assert len({f.split("/_k=")[1].split("/")[0] for f in added}) <= 2 and files <= set(glob.glob(out + "/data/*/*/*.parquet"))
    assert {r.id: r.v for r in S.latest_table(spark, out).collect()} == dict.fromkeys(range(400), 0) | {7: 1}


def test_a_version_that_was_not_published_is_written_again(spark, tmpdir_path):
    """A crash after the data and before the directory: readers see the old table, the replay the new one."""
    out = os.path.join(tmpdir_path, "t")
    _put(_keyed(spark, range(100), 0), out, 0, 30)
    before = glob.glob(out + "/manifest/*.parquet")
    _put(_keyed(spark, range(50, 150), 1), out, 1, 30)
    for f in set(glob.glob(out + "/manifest/*.parquet")) - set(before):
        os.remove(f)
    assert not KT.published(spark, out, 1)
    assert {r.id: r.v for r in S.latest_table(spark, out).collect()} == dict.fromkeys(range(100), 0)
    _put(_keyed(spark, range(50, 150), 1), out, 1, 30)
    assert {r.id: r.v for r in S.latest_table(spark, out).collect()} == dict.fromkeys(range(50), 0) | dict.fromkeys(range(50, 150), 1)
    _put(_keyed(spark, [], 2), out, 2, 30)
    assert S.latest_table(spark, out).count() == 150


def test_only_a_missing_path_is_no_table(spark, tmpdir_path):
    assert IO.versions(spark, os.path.join(tmpdir_path, "none")) == []
    bad = os.path.join(tmpdir_path, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        IO.versions(spark, bad)


def test_derbies_are_a_window_not_all_pairs(spark):
    d = B.derbies(Tables(spark, SF_SMALL)).collect()
    assert 0 < len(d) <= 25 and all(r.clube_id_a < r.clube_id_b for r in d)


def test_dag_runner_writes_every_layer(spark, tmpdir_path):
    from pitchlake.plans.run import LAYERS, run_dag
    paths = run_dag(spark, SF_SMALL, os.path.join(tmpdir_path, "dag"))
    assert set(paths) == {n for n, _ in LAYERS}
    assert spark.read.parquet(paths["previsao_final_ranked"]).count() > 0
