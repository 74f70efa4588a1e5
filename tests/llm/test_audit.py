"""Filter audit against a plain replay of every order."""

import re
from itertools import permutations

from pitchlake.llm import filter_audit
from pitchlake.llm.common import table

from llm_rows import DOCS, SF, odd_rows, same


def fails(rows, i):
    doc, text, source = rows[i]
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    out = set()
    if len(w) < 200:
        out.add("A")
    if 100 * len(set(w)) < 50 * len(w):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
        out.add("C")
    if re.search(r"[#$%&*|]", t):
        out.add("D")
    if doc is not None and any(d is not None and d < doc and (x or "") == t for d, x, _ in rows):
        out.add("E")
    return out


def replay(rows, good, toxic):
    """Apply the filters one after the other, document by document."""
    out, shapley = {}, {}
    failed = [fails(rows, i) for i in range(len(rows))]
    for part in {s or "" for _, _, s in rows}:
        members = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(members)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in failed[i]]
                redundant = sum(f in failed[i] for i in members if i not in left)
                left = [i for i in left if i not in gone]
                out[part, order, step] = (len(left), len(gone), redundant, sum(failed[i] == {f} for i in members),
                                          sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def check(docs, labels):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    marks = [r for r in labels.collect() if r["doc_id"] is not None]
    want = replay(rows, {r["doc_id"] for r in marks if r["quality"] == 1}, {r["doc_id"] for r in marks if r["toxic"] == 1})
    got = [tuple(r) for r in filter_audit.audit(docs, labels).drop("filter").collect()]
    assert len(got) == len(want) and set(got) == want


def test_table(spark):
    check(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_odd_rows(odd, clashing, no_docs, labels, no_labels):
    check(odd, labels)
    check(odd, no_labels)
    assert same(filter_audit.audit(odd, labels), filter_audit.audit(clashing, labels))
    assert filter_audit.audit(no_docs, labels).count() == 0


def test_hot_text_and_part(spark):
    """A third of all rows are copies of one text in one source; orders commute in what they keep."""
    rows = odd_rows() + [(100 + i, "one hot TEXT | of all", None, "a", 1) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(90, 110)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    check(docs, labels)
    out = filter_audit.audit(docs, labels)
    last = out.filter("step = 5").groupBy("part").agg({"kept": "min"}).join(out.filter("step = 5").groupBy("part").agg({"kept": "max"}), "part")
    assert last.filter("`min(kept)` <> `max(kept)`").count() == 0


def test_filters_on_results(odd, labels):
    """Filters that Spark may push down give the rows that they give on the written result."""
    out = filter_audit.audit(odd, labels)
    assert out.filter("part = 'a' AND step = 2 AND removed > 0").count() == len(
        [r for r in out.collect() if r["part"] == "a" and r["step"] == 2 and r["removed"] > 0])
