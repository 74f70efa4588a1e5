"""SimHash classes against brute force over all pairs."""

import random
import re

import pytest
import xxhash

from pitchlake.llm import simhash
from pitchlake.llm.common import table

from llm_rows import DOCS, odd_rows, same


def plain(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def classes(fps, ids):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for f, doc in zip(fps, ids, strict=True):
        if doc is not None:
            least[find(f)] = min(least.get(find(f), doc), doc)
    return [least.get(find(f)) for f in fps]


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    fps = [plain(t) for _, t in rows]
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, classes(fps, [i for i, _ in rows]), strict=True)]
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_table(spark):
    check(table(spark, "/root/testdata/sf0.01", "documents"))


def test_odd_rows(odd, clashing, no_docs):
    check(odd)
    assert same(simhash.near_duplicates(odd), simhash.near_duplicates(clashing))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_rows_without_an_id(spark):
    rows = [(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (7, None), (None, ""), (3, "Alpha BETA gamma delta")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    check(docs)
    check(docs.filter("doc_id IS NULL"))


@pytest.mark.parametrize("hot", [1, 4, 256])
def test_links_of_crowded_segments(spark, monkeypatch, hot):
    """Many fingerprints share a segment; all links are found whatever is met directly."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(hot)
    centers = [rng.getrandbits(64) for _ in range(4)]
    fps = {0, (1 << 64) - 1, 1, 3, 7}
    for c in centers:
        for _ in range(60):
            f = c
            for _ in range(rng.randrange(5)):
                f ^= 1 << rng.choice([0, 1, 2, 15, 16, 31, 32, 33, 48, 63])
            fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    nodes = spark.createDataFrame(signed, "fp long").repartition(3)
    got = sorted((r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(nodes).collect())
    want = {(a, b) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 2}
    assert len(got) == len(set(got)) and {frozenset(p) for p in got} == {frozenset(p) for p in want}


def test_long_text_is_counted_in_chunks(monkeypatch):
    text = odd_rows()[9][1]
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint(text) == whole == plain(text)
