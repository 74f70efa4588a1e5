"""Prefix trie against a plain walk over a tree of tuples."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from pitchlake.llm import prefix_trie
from pitchlake.llm.common import table

from llm_rows import SF, same

CONVS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuild(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = rebuild(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = leaves.get(path, 0) or 1
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = saved.get(path, 0) + (len(members[path]) - 1) * n_words
        if path:
            up = path[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
    out = []
    for path, m in members.items():
        end = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(path))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), children.get(path, 0), leaves[path],
                    saved[path], hashlib.sha256(end.encode()).hexdigest()))
    return out


def check(spark, rows):
    got = prefix_trie.trie(spark.createDataFrame(rows, CONVS).repartition(3))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(rows)))


def odd():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "bot", None, ""]), rng.choice(["a b", "a  b", "c", None, "", "é x\ny"]))
            for c in range(120) for t in range(rng.randrange(1, 7))]
    rows += [(200, t % 50, "user", f"turn {t}") for t in range(150)] + [(201, t, "user", f"turn {t}") for t in range(150)]
    rows += [(c, None, "user", "null turn") for c in (1, 1, 40)] + [(None, 0, "user", "no id"), (None, None, None, None)]
    rows += [(-5, 0, "user", "a"), (-5, 1, "bot", "b"), (0, 0, "user", "tie"), (0, 0, "user", "tie"), (0, 0, "bot", "tie")]
    rows += [(999, 0, "u", "only"), (1020, 0, "u", "x " * 30_000), (1021, 0, "u", "y"), (1022, 9, "u", "z")]
    return rows + [(c, t, "user", "same for all") for c in range(300, 360) for t in range(3)]


@pytest.mark.parametrize("width, slices, piece", [(4, 1 << 12, 512), (1, 2, 1), (3, 5, 7)])
def test_odd_rows(spark, monkeypatch, width, slices, piece):
    monkeypatch.setattr(prefix_trie, "WIDTH", width)
    monkeypatch.setattr(prefix_trie, "SLICE", slices)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    check(spark, odd())


def test_table(spark):
    docs = table(spark, SF, "conversations")
    got = prefix_trie.trie(docs).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain([tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()])))


def test_empty_table_and_clashing_names(spark):
    from pyspark.sql import functions as F
    assert prefix_trie.trie(spark.createDataFrame([], CONVS)).count() == 0
    docs = spark.createDataFrame(odd(), CONVS)
    names = ("pos", "digest", "g", "m", "part", "h", "n", "base", "first", "block", "a1", "ka", "depth", "n_words", "n_convs")
    assert same(prefix_trie.trie(docs), prefix_trie.trie(docs.withColumns({n: F.lit("x") for n in names})))


def test_filters_on_results(spark):
    out = prefix_trie.trie(spark.createDataFrame(odd(), CONVS))
    assert out.filter("depth = 3 AND n_convs > 1").count() == len([r for r in plain(odd()) if r[1] == 3 and r[3] > 1])
