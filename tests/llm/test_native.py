"""URL filters, decontamination, sharding, mixing: SQL twins on tables, brute force and edges on small rows."""

import datetime as dt
import random

import duckdb
import numpy as np
import pytest
from llm_rows import DOCS, SF, odd_rows, prose, same

from pitchlake.llm import decontaminate, mixing, sharding, url_filter
from pitchlake.llm.oracle import ORACLE
from pitchlake.llm.queries import QUERIES
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, cur.fetchall()))


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_urls_against_a_loop(spark):
    rng = random.Random(3)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "1.2.3.4", "ba.com"]
    caps = [(i, f"{rng.choice(('http', 'HTTPS'))}://{rng.choice(('', 'u:p@'))}{rng.choice(hosts).upper()}{rng.choice(('', ':80'))}"
             f"{rng.choice(('', '/', '/p', '/p/?q=1', '/p#f'))}", day(rng.randrange(40))) for i in range(300)]
    caps += [(1, None, day(3)), (2, "no url", day(3)), (3, "", None), (4, "http://a.com/p", None), (5, "http://a.com", day(3)), (5, "http://a.com", day(3))]
    ents = [(rng.choice(("l1", "l2")), v, "domain", rng.choice([*hosts, "com"]), rng.choice(("add", "remove")), day(rng.randrange(40)))
            for v in ("block", "allow") for _ in range(40)]
    ents += [("l3", "block", "url", "a.com/p", "add", day(5)), ("l3", "block", "url", "a.com/p", "add", day(5)), (None, "block", "domain", "a.com", "add", day(0)),
             ("l4", "block", "domain", None, "add", day(0)), ("l5", "block", "domain", "b.org", "add", None)]
    out = url_filter.judge(spark.createDataFrame(caps, "page_id long, url string, fetched_on date").withColumn("value", F.lit("x")).withColumn("n", F.lit(0)),
                           spark.createDataFrame(ents, "list_name string, verdict string, kind string, value string, action string, on date"))

    def host(u):
        import re
        m = re.match(url_filter.URL, u or "")
        return (m[1].lower().rstrip("."), m[2].rstrip("/")) if m else ("", "")

    want = []
    for page, u, d in caps:
        h, p = host(u)
        active = []
        for key in {e[:4] for e in ents if None not in e}:
            covers = (h + p == key[3]) if key[2] == "url" else h == key[3] or h.endswith("." + key[3]) and not h[-1].isdigit() and "." in key[3]
            past = [(e[5], e[4] == "add") for e in ents if e[:4] == key and None not in e and d is not None and e[5] <= d]
            if h and covers and past and max(past)[1]:
                active.append((0 if key[2] == "url" else 1_000_000 - len(key[3]), key[1] != "allow", key[0], key[3], key[1]))
        best = min(active, default=(0, 0, None, None, "none"))
        want.append(repr((page, h, d, len(active), best[2], best[3], best[4], best[4] != "block")))
    assert sorted(repr(tuple(r)) for r in out.collect()) == sorted(want)


def test_urls_empty(spark):
    caps = spark.createDataFrame([], "page_id long, url string, fetched_on date")
    ents = spark.createDataFrame([], "list_name string, verdict string, kind string, value string, action string, on date")
    assert url_filter.judge(caps, ents).count() == 0
    one = spark.createDataFrame([(1, "http://a.com", day(1))], caps.schema)
    assert url_filter.judge(one, ents).first()["kept"]


QUESTION = "A train leaves the station with Anna and travels 300 km in 4 hours before it stops near the old bridge for repairs"


def flagged(spark, docs, items):
    out = decontaminate.contaminated(spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string"),
                                     spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]) for r in out.collect()}


def test_templates(spark):
    rng = random.Random(8)
    pad = lambda: prose(rng, 60)
    new = QUESTION.replace("Anna", "Bert").replace("300", "1,250").replace("km", "miles").replace("4", "17")
    docs = [QUESTION, f"{pad()} {QUESTION} {pad()}", f"{pad()}. {new} {pad()}", new.upper().replace("BERT", "Bert"),
            pad(), QUESTION.replace("leaves", "left").replace("travels", "flies").replace("near", "by"), None, "", QUESTION[:40]]
    assert {d for d, _ in flagged(spark, docs, [QUESTION])} >= {0, 1, 2}
    assert not {d for d, _ in flagged(spark, docs, [QUESTION])} & {4, 5, 6, 7, 8}


def test_slots_must_be_consistent(spark):
    item = "Anna gives two of the many apples to Bert and later Anna asks whether Bert still has the apples that she gave"
    good = item.replace("Anna", "Xenia").replace("Bert", "Yuri")
    bad = item.replace("Anna gives", "Xenia gives").replace("Anna asks", "Zoe asks")
    assert flagged(spark, ["so " + good, "so " + bad], ["so " + item]) == {(0, 0)}


def test_short_items(spark):
    assert flagged(spark, ["we met when the quick fox jumped again", "the quick"], ["the quick fox jumped again", "the quick", None, ""]) == {(0, 0)}


def test_decontaminate_edges(spark, odd, clashing, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(7, odd_rows()[0][1][:200]), (7, None), (None, odd_rows()[0][1][200:400])], "item_id long, text string")
    assert decontaminate.contaminated(odd, none).count() == 0 and decontaminate.contaminated(no_docs, items).count() == 0
    out = decontaminate.contaminated(odd, items)
    assert {r["doc_id"] for r in out.collect()} == {0, 1, 2, 7, None}
    assert same(out, decontaminate.contaminated(clashing, items))
    rest = decontaminate.drop_contaminated(clashing, items)
    assert rest.columns == clashing.columns and rest.count() == len(odd_rows()) - 7


def test_shards(spark, odd, clashing, no_docs):
    tree, grown = sharding.even_tree(8), sharding.even_tree(9)
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.assign_shards(ids, tree, grown).toPandas()
    moved = out[out["shard"] != out["grown_shard"]]
    assert set(moved["grown_shard"]) == {8} and abs(len(moved) / 20_000 - 1 / 9) < 0.02
    share = out["shard"].value_counts(normalize=True)
    assert len(share) == 8 and (abs(share - 1 / 8) < 0.02).all()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    odd_out = sharding.assign_shards(odd, tree, grown)
    assert odd_out.count() == len(odd_rows()) and same(odd_out, sharding.assign_shards(clashing, tree, grown))
    assert sharding.assign_shards(no_docs, tree).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(odd, [])


def test_weights_and_confined_movement(spark):
    tree = [sharding.Shard(0, "eu", "r1", 1), sharding.Shard(1, "eu", "r1", 2), sharding.Shard(2, "eu", "r2", 1), sharding.Shard(3, "us", "r1", 4),
            sharding.Shard(4, "us", "r1", 0)]
    heavier = [sharding.Shard(x.shard, x.region, x.rack, 3 if x.shard == 2 else x.weight) for x in tree]
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.assign_shards(ids, tree, heavier).toPandas()
    share = out["shard"].value_counts(normalize=True)
    assert np.allclose([share.get(i, 0) for i in range(5)], [1 / 8, 2 / 8, 1 / 8, 4 / 8, 0], atol=0.015)
    assert set(out[out["shard"] != out["grown_shard"]]["grown_shard"]) == {2}


def test_targets():
    got = mixing.targets([("a", 100), ("b", 100), (None, 100), ("c", 100)])
    # weights 5, 2, 1 and 5 again; a and the null source stop at 200, the rest is dealt 2 : 1
    assert got == {"a": 200.0, "b": pytest.approx(400 / 3), "c": pytest.approx(200 / 3), None: 200.0}
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


def test_flow_prefers_first_uses():
    # pattern 1 serves both sources; the flow uses it for b before a's words are used twice
    flows = mixing.min_cost_flow([10, 10, 4], [[0], [0, 1], [1]], [15, 9])
    assert sum(f.get(0, 0) for f in flows) == 15 and sum(f.get(1, 0) for f in flows) == 9
    assert sum(flows[0].values()) <= 10 and sum(flows[1].values()) <= 10 and sum(flows[2].values()) <= 4
    over = mixing.min_cost_flow([10], [[0]], [25])
    assert over == [{0: 20}]


def test_mix(spark, odd, clashing, no_docs):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "en", rng.choice(["a", "a", "a", "b", "c", None]), 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(docs, mixing.n_words(F.col("text")), F.array("source"))
    pdf = out.toPandas()
    pdf["source"] = [s[0] for s in pdf["sources"]]
    for _, g in pdf.groupby("source", dropna=False):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 30
    assert (pdf["taken"] <= 2 * pdf["size"]).all()
    assert same(out, mixing.mix(docs.repartition(7), mixing.n_words(F.col("text")), F.array("source")))
    assert mixing.mix(no_docs, mixing.n_words(F.col("text")), F.array("source")).count() == 0
    assert mixing.mix(odd, mixing.n_words(F.col("text")), F.array("source")).count() == len(odd_rows())
    assert mixing.repeat_documents(clashing, mixing.n_words(F.col("text")), F.array("source")).columns == clashing.columns


def test_overlapping_sources(spark):
    """Documents of two sources: quotas are met from shared documents, first uses first."""
    docs = spark.createDataFrame([(i, 10, ["a"] if i < 100 else ["a", "b"] if i < 200 else ["b"]) for i in range(300)], "doc_id long, n long, src array<string>")
    out = mixing.mix(docs, F.col("n"), F.col("src")).toPandas()
    assert abs(out["taken"].sum() - 1.5 * 3000) <= 20
    assert out["copies"].max() <= 2
