"""The pipeline against a plain version of its stages, and the guard of the entry module."""

import subprocess
import sys

import corpus_pipeline as pipeline
from llm_rows import SF, odd_rows
from test_duplicates import classes

from pitchlake.llm import decontaminate, mixing, quality_score, sharding
from pitchlake.llm.common import staged, table
from pyspark.sql import functions as F


def test_stages_on_the_table(spark):
    docs = table(spark, SF, "documents")
    names, ids = docs.columns, lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    labels = table(spark, SF, "labels")
    out = []
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    assert all(df.columns == names for df in out[:-1])
    good = quality_score.score_documents(table(spark, SF, "documents"), labels).filter("predicted = 1")
    assert ids(out[0]) == ids(good)
    want = [r for r in classes([(r["doc_id"], r["text"]) for r in out[0].collect()]) if r.endswith("True)")]
    assert len(want) == out[1].count() and {int(r[1:].split(",")[0]) for r in want} == set(ids(out[1]))
    bad = set(ids(decontaminate.contaminated(out[1], table(spark, SF, "benchmark"))))
    assert ids(out[2]) == [i for i in ids(out[1]) if i not in bad]
    copies = mixing.mix(out[2], mixing.n_words(F.col("text")), F.array("source")).collect()
    assert ids(out[3]) == sorted(r["doc_id"] for r in copies for _ in range(r["copies"]))
    alone = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(out[2], sharding.even_tree(8)).collect()}
    rows = out[4].collect()
    assert len(rows) == out[3].count() and all(alone[r["doc_id"]] == r["shard"] for r in rows)
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_stages_on_odd_and_empty_rows(spark, odd, clashing, no_docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, odd_rows()[2][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, clashing, no_docs):
        for name, stage in pipeline.STAGES:
            out = staged(stage(spark, docs, str(tmp_path)), f"odd-{name}")
            assert name == "shards" or out.columns == docs.columns
            docs = out


def test_entry_works_without_the_folder(tmp_path):
    code = ("import importlib, sys; import __spark_entry__ as e; a = set(e.queries());"
            "[sys.modules.pop(m) for m in list(sys.modules) if m.startswith(('pitchlake.llm', 'corpus_pipeline'))];"
            "sys.modules.update({'pitchlake.llm': None, 'corpus_pipeline': None});"
            "importlib.reload(e); b = set(e.queries()); assert {'pipeline', 'op4_suffix_dedup'} <= a - b and len(b) > 150, (len(a), len(b))")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
