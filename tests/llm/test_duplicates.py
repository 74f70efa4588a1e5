"""MinHash classes, repeated bytes and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np

from pitchlake.llm import line_dedup, minhash, repeats
from pitchlake.llm.common import table
from pitchlake.llm.graph import components

from llm_rows import DOCS, SF, odd_rows, prose, same


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def classes(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both) and rows[i][0] is not None and rows[j][0] is not None:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((repr((doc, len(sets[i]), least[find(i)] if doc is not None else None,
                         doc is not None and doc == least[find(i)])) for i, (doc, _) in enumerate(rows)))


def check_classes(docs):
    got = minhash.near_duplicates(docs).collect()
    want = classes([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])) for r in got) == want


def test_classes_of_the_table(spark):
    check_classes(table(spark, SF, "documents"))


def test_classes_of_odd_rows(odd, clashing, no_docs):
    check_classes(odd)
    assert same(minhash.near_duplicates(odd), minhash.near_duplicates(clashing))
    assert minhash.near_duplicates(no_docs).count() == 0


def test_chain_of_near_copies(spark):
    """Neighbours are similar, ends are not: links through the middle, found in round two as well."""
    rng = random.Random(1)
    words = prose(rng, 200, 10_000).split()
    rows = []
    for i in range(30):
        words[rng.randrange(200)] = f"new{i}"
        rows.append((100 - i, " ".join(words), None, None, None))
    check_classes(spark.createDataFrame(rows, DOCS))


def test_kept_rows(odd, clashing):
    out = minhash.keep_one(odd)
    assert out.columns == odd.columns and minhash.keep_one(clashing).columns == clashing.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and None not in ids and 0 in ids and 1 not in ids


def test_recall_of_the_tables():
    """Pairs at similarity 0.75 to 0.8 meet in a table."""
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(300):
        a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        b = np.concatenate([a[:345], rng.integers(0, 1 << 63, 55, dtype=np.uint64)])
        keys = minhash.table_keys(np.stack([minhash.signature(np.unique(a)), minhash.signature(np.unique(b))]))
        missed += not (keys[0] == keys[1]).any()
    assert missed <= 2


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for a, b in edges:
        if a != b:
            assert got.get(a, a) == got.get(b, b) == find(a)


def cut(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for _, b in texts:
        for i in range(len(b) - 399):
            k = hashlib.md5(b[i:i + 400]).digest()
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d, b in texts:
        keep = np.ones(len(b), bool)
        for i in range(len(b) - 399):
            if seen[hashlib.md5(b[i:i + 400]).digest()] > 1:
                keep[i:i + 400] = False
        turns = np.flatnonzero(np.diff(np.concatenate([[1], keep, [1]]).astype(int)))
        kept = np.frombuffer(b, np.uint8)[keep].tobytes()
        out.append(repr((d, len(b), len(b) - len(kept), len(turns) // 2, hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def check_cut(docs, **options):
    want = cut([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = repeats.remove_repeats(docs, **options).collect()
    assert sorted(repr((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == want


def test_difference_cover():
    assert len({(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER if a != b}) == repeats.PERIOD - 1


def test_cut_of_the_table(spark):
    check_cut(table(spark, SF, "documents"))


def test_cut_at_the_bound(spark):
    """Shared strings of 399, 400 and 401 bytes at odd places, overlaps, runs of one byte; many small chunks."""
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh é") for _ in range(3000))
    rows = [(i, prose(rng, 30 + i) + s + prose(rng, 40), None, None, None) for i, s in enumerate(
        [text[:399], text[100:500], text[100:501], text[700:1099], text[701:1101], text[900:1400], "z" * 401, "yx" * 210, text[2000:], text[1900:2600]])]
    rows += [(50, text[:399], None, None, None), (51, "q" * 400, None, None, None), (52, "q" * 399 + "r", None, None, None)]
    check_cut(spark.createDataFrame(rows, DOCS).repartition(4), chunk_bytes=1 << 12)


def test_cut_of_odd_rows(odd, clashing, no_docs):
    check_cut(odd)
    assert same(repeats.remove_repeats(odd), repeats.remove_repeats(clashing))
    assert repeats.remove_repeats(no_docs).count() == 0


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def dropped(rows):
    places = [((-(1 << 63) if d is None else d, k), d, x) for d, t in rows for k, x in enumerate((t or "").split("\n"))
              if re.search(r"[^\x20\x09-\x0D]", x)]
    first = {}
    for at, _, x in places:
        first[x] = min(first.get(x, at), at)
    words = {x: re.findall(r"[^\x20\x09-\x0D]+", x) for x in first}
    near = {x for x in first for y in first if first[y] < first[x] and min(len(words[x]), len(words[y])) >= line_dedup.MIN_WORDS
            and abs(len(words[x]) - len(words[y])) <= 1 and distance(words[x], words[y]) <= 1}
    out = {}
    for d in {d for d, _ in rows}:
        own = [(at, x) for at, e, x in places if e == d]
        eq = [at[1] for at, x in own if first[x] < at]
        nr = [at[1] for at, x in own if first[x] == at and x in near]
        out[d] = (len(own), len(eq), len(nr), len(own) - len(eq) - len(nr), sorted(eq + nr))
    return out


def check_lines(docs):
    want = dropped([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.dropped_lines(docs).collect()}
    assert got == want


def test_lines_one_edit_apart(spark):
    rng = random.Random(6)
    base = [prose(rng, n) for n in (5, 7, 8, 9, 14, 15, 40)]
    rows = []
    for i in range(40):
        lines = []
        for b in rng.sample(base, 4):
            w = b.split()
            for _ in range(rng.choice((0, 1, 1, 2))):
                k = rng.randrange(len(w))
                kind = rng.randrange(3)
                w[k:k + (kind != 1)] = [] if kind == 0 else [f"x{rng.randrange(6)}"]
            lines.append(rng.choice((" ", "  ")).join(w))
        rows.append((i, "\n".join(lines + [""]), None, None, None))
    check_lines(spark.createDataFrame(rows, DOCS))


def test_lines_of_odd_rows(spark, odd, clashing, no_docs):
    once = spark.createDataFrame([r for i, r in enumerate(odd_rows()) if i not in (3, 8)], DOCS)   # ids once
    check_lines(once)
    assert same(line_dedup.dropped_lines(odd), line_dedup.dropped_lines(clashing))
    assert line_dedup.dropped_lines(no_docs).count() == 0
    clean = line_dedup.clean_texts(clashing)
    assert clean.columns == clashing.columns and clean.count() == clashing.count()


def test_variants_that_occur_once_are_not_carried_on(spark, monkeypatch):
    """Of two near lines and 30 that share a half with another only, the common variant alone is written."""
    rng = random.Random(8)
    half = prose(rng, 20)
    lines = [f"{half} {prose(rng, 20)}" for _ in range(31)]
    lines.append(" ".join([*lines[0].split()[:-1], "other"]))
    rows = spark.createDataFrame([(i, 0, x.split()) for i, x in enumerate(lines)], "doc long, line_no int, w array<string>")
    sizes = {}

    def staged(df, label):
        sizes[label] = df.count()
        return df

    monkeypatch.setattr(line_dedup, "staged", staged)
    assert [tuple(r) for r in line_dedup.near_lines(rows).collect()] == [(31, 0)]
    assert line_dedup.variants(rows).count() == 32 * 41
    assert max(sizes.values()) <= 4


def test_line_words_with_any_blanks(spark):
    texts = ["a b", " a\tb  c ", "\x0bé\x0c\rb", "\t \r", "a b c", ""]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    got = [r[0] for r in df.select(line_dedup._line_words(df["line"])).collect()]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
