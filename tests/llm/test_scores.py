"""Toxicity, quality classifier and quality rules: held-out accuracy, brute force, edge cases."""

import re
import zlib

import numpy as np
import pytest

from pitchlake.llm import quality_rules, quality_score, toxicity
from pitchlake.llm.common import table

from llm_rows import odd_rows, same

SF01 = "/root/testdata/sf0.01"


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return float(np.mean((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None])))


@pytest.mark.parametrize("module, label, least", [(quality_score, "quality", 0.97), (toxicity, "toxic", 0.8)])
def test_held_out(spark, module, label, least):
    labels = table(spark, SF01, "labels")
    out = module.score_documents(table(spark, SF01, "documents"), labels).toPandas()
    assert len(out) == 1000 and out["score"].between(0, 1).all()
    held = [zlib.crc32(str(i).encode()) % module.FOLDS == module.HELD_OUT for i in out["doc_id"]]
    assert (out["held_out"] == held).all()
    assert (out["predicted"] == (out["score"] >= 0.3)).all()
    m = out[out["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert auc(m[label].to_numpy(), m["score"].to_numpy()) >= least


def test_held_out_labels_are_never_used(spark):
    """Flipping every held-out label changes no score."""
    from pyspark.sql import functions as F
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    for module, label in ((quality_score, "quality"), (toxicity, "toxic")):
        flipped = labels.withColumn(label, F.when(crc % module.FOLDS == module.HELD_OUT, 1 - F.col(label)).otherwise(F.col(label)))
        assert same(module.score_documents(docs, labels), module.score_documents(docs, flipped))


@pytest.mark.parametrize("module", [quality_score, toxicity])
def test_edges(module, odd, clashing, no_docs, labels, no_labels):
    out = module.score_documents(odd, labels)
    rows = out.collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    if module is toxicity:                # the classifier's clashing columns are in the pipeline's tests
        assert same(out, module.score_documents(clashing, labels))
    assert module.score_documents(no_docs, labels).count() == 0
    none = {r["score"] for r in module.score_documents(odd, no_labels).collect()}
    assert max(none) - min(none) < 1e-9


def test_isotonic_is_the_least_squares_rising_curve():
    got = quality_score.isotonic(np.array([1.0, 1, 2, 1]), np.array([0.0, 1, 0, 1]))
    assert np.allclose(got, [0, 1 / 3, 1 / 3, 1])


def test_nnpu_finds_the_marked_rows():
    rng = np.random.default_rng(0)
    ids, positive = [], []
    for i in range(600):
        bad = i < 100 or rng.random() < 0.1
        ids.append(np.array(sorted({int(x) for x in rng.integers(1, 50, 12)} | ({0} if bad else set()))))
        positive.append(int(i < 100))
    w, b = toxicity.train_nnpu(ids, np.array(positive), 50, 0.1)
    assert w[0] > 3 and w[0] > 2 * np.abs(w[1:]).max()


def base_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for t in tri:
        seen[t] = seen.get(t, 0) + 1
    again = {j for i, t in enumerate(tri) if seen[t] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))


def test_rules_base_counts(odd, clashing, no_docs, labels, no_labels):
    out = quality_rules.judge(odd, labels)
    got = sorted((tuple(r)[1:6] for r in out.collect()))
    assert got == sorted(base_counts(r[1]) for r in odd_rows())
    for r in out.collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert same(out, quality_rules.judge(clashing, labels))
    assert quality_rules.judge(no_docs, no_labels).count() == 0
    plain = quality_rules.judge(odd, no_labels)
    assert plain.filter("kept = base_failed").count() == 0


def test_verdicts_of_long_texts_can_be_filtered(spark, odd, labels):
    """A filter, a count and a semi-join on the verdict cost what reading it costs (30,000 words here)."""
    import time
    out = quality_rules.judge(odd, labels)
    began = time.time()
    rows = out.collect()
    kept = out.filter("kept")
    assert kept.count() == sum(r["kept"] for r in rows)
    assert odd.join(kept.select("doc_id"), "doc_id", "left_semi").count() == sum(
        r[0] in {x["doc_id"] for x in rows if x["kept"]} for r in odd_rows() if r[0] is not None)
    assert out.filter("base_failed AND n_repeat_words > 0").count() == sum(r["base_failed"] and r["n_repeat_words"] > 0 for r in rows)
    assert time.time() - began < 20
