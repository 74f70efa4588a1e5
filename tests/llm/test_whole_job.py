"""Cases that shorter versions of the operators lost."""

import random

import pytest
from llm_rows import DOCS, prose
from pitchlake.llm import minhash
from test_native import flagged


@pytest.mark.parametrize("item", [
    "What is 3 + 4 * 5 - 2 / 6 + 7 - 8 * 9 + 10 - 11 / 12 + 13 ?",
    "Compute 12 + 7 , 15 - 4 , 8 * 9 , 36 / 6 , 81 - 1",
    "Who wrote Pride and Prejudice , Emma , Persuasion , Mansfield Park and Northanger Abbey ?",
    "Wer malte Haus und Hof am See"])
def test_verbatim_items_without_literal_windows(spark, item):
    other = item.replace("4", "5").replace("Emma", "Sanditon").replace("Hof", "Garten")
    docs = [item, f"we read this: {item} and then went on", f"One more. {item}. So it goes", item.lower(), "nothing of it in here at all, not a word of it"]
    assert {d for d, _ in flagged(spark, docs, [item])} == {0, 1, 2, 3}
    assert (0, 0) in flagged(spark, [other], [other])


def test_numbers_count_in_windows_without_literals(spark):
    item = "Compute 12 + 7 , 15 - 4 , 8 * 9 , 36 / 6 , 81 - 1"
    assert not flagged(spark, ["Compute 11 + 3 , 16 - 5 , 7 * 8 , 35 / 5 , 80 - 2"], [item])


def test_names_at_the_start_of_sentences(spark):
    item = "Anna has 3 apples. Anna buys 4 more. Anna eats 2 pears. Anna sells 5 plums. How many pieces does she have?"
    new = item.replace("Anna", "Bert").replace("3", "7").replace("4", "9")
    docs = [new, f"some words before it: {new} and after", f'they said "{new}"', "So. " + item, "Birds have wings. Trees have leaves. Cars have wheels."]
    assert {d for d, _ in flagged(spark, docs, [item])} == {0, 1, 2, 3}
    asked = item.replace("does she", "does Anna")
    assert flagged(spark, [asked.replace("Anna", "Bert"), asked.replace("Anna", "Bert").replace("does Bert", "does Carl")], [asked]) == {(0, 0)}


def test_rows_that_repeat_an_id_or_have_none_keep_their_texts(spark):
    rng = random.Random(12)
    a, z, y, q, v = (prose(rng, 120, 5000) for _ in range(5))
    rows = [(1, a), (5, a), (5, z), (3, y), (6, y + " more"), (6, q), (None, v), (None, v + " tail"), (None, a), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS).repartition(4)
    got = [(r["doc_id"], r["text"]) for r in minhash.keep_one(docs).collect()]
    assert sorted(got[k] for k in range(len(got)) if got[k][0] is not None) == sorted([(1, a), (5, z), (3, y), (6, q)])
    assert [t for i, t in got if i is None] in ([v], [v + " tail"])


def test_every_trusted_document_counts(spark):
    """op6: more documents labelled good than any bound; when all are good, target and raw corpus are equal and every weight is 0."""
    from pitchlake.llm import quality_rules
    n = quality_rules.MAX_TRUSTED + 800
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('word', id, ' and ', id % 7) AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert quality_rules.trusted_ids(labels.union(labels)).count() == n
    assert set(quality_rules.weights(docs, labels)) == {0}


def test_trusted_ids_of_any_number_are_joined(spark):
    """op6: the verdicts are the same when Spark does not broadcast the ids; null ids match nothing."""
    from pitchlake.llm import quality_rules
    rows = [(i % 50 if i % 9 else None, " ".join(f"w{(i * j) % 41}" for j in range(60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(0, 60, 2)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    few = quality_rules.weights(docs, labels)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert quality_rules.weights(docs, labels) == few and any(few)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
