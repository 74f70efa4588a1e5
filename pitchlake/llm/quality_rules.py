"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio.

Base counts are exact per document.  The model verdict compares two
multinomials over hashed word unigrams and bigrams (crc32 into ``2 * K``
buckets): the trusted target (documents labelled good) and the raw corpus
(every document).  A document's score is the mean over its n-grams of
``ln(p_target / p_raw)``; it is kept if the mean reaches ``LEAST``.

- The raw multinomial counts every n-gram of every document.  Counts are
  combined map-side per task, so a shuffle moves ``2 * K`` sums per task.
- The target multinomial counts every n-gram of every document labelled good.
  Their ids may be many, so texts and ids are shuffled by id, at any size.
- Weights are fixed-point integers, so a score is an exact sum and the
  verdict does not depend on the order of addition.  The 2 * K weights travel
  as one constant of the plan.

All of it is SQL functions.  Texts are shuffled once, to meet the trusted ids.
Counts and sums of every row are written once; verdicts, and what is filtered,
counted or joined by them, read those.

Edge cases: null and empty texts have no words and fail the base rule.
Repeated rows are judged alike, and each counts in the raw corpus.  With no
trusted document every document has the score 0 and base rules decide.  An
empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import staged, text_or_empty, words

K = 8192
#: Read by the SQL twin alone, which takes about so many trusted ids if there are more.
MAX_TRUSTED = 8192
SMOOTHING = 0.5
#: Fixed-point unit of a weight.
UNIT = 1 << 16
#: Least mean log-likelihood ratio of a document that is kept.
LEAST = -0.12

# Fixed by the result contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, _words, and the base counts of every row."""
    text = text_or_empty(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    rows = docs.select("doc_id", words(F.col("text")).alias("_words"),
                       F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                       (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                       lines.alias("_lines"))
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_h": F.transform("_words", lambda w: F.xxhash64(w))}).drop("_lines")
    return with_repeats(rows)


def with_repeats(rows: DataFrame) -> DataFrame:
    """n_repeat_words: words in 3-word windows found twice or more in the text.

    Windows are 64-bit hashes; only a text whose windows are not all distinct
    sorts them, to find the places of the repeated ones.  Each step is a
    column of its own, so that no array is built anew for every element.
    """
    rows = rows.withColumn("_t", F.when(F.size("_h") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_h") - 3),
        lambda i: F.xxhash64(F.get("_h", i), F.get("_h", i + 1), F.get("_h", i + 2)))))
    rows = rows.withColumn("_s", F.when(
        F.size(F.array_distinct("_t")) < F.size("_t"),
        F.sort_array(F.transform("_t", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    again = F.filter(
        F.transform("_s", lambda e, k: F.when((F.get("_s", k - 1)["x"] == e["x"]).eqNullSafe(F.lit(True))
                                              | (F.get("_s", k + 1)["x"] == e["x"]).eqNullSafe(F.lit(True)), e["i"])),
        lambda i: i.isNotNull())
    rows = rows.withColumn("_p", F.sort_array(again))
    steps = F.zip_with(F.slice("_p", F.lit(2), F.size("_p") - 1), F.slice("_p", F.lit(1), F.size("_p") - 1),
                       lambda b, a: F.least(b - a, F.lit(3)))
    covered = F.when(F.size("_p") >= 1, F.lit(3) + F.aggregate(steps, F.lit(0), lambda n, x: n + x))
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_h", "_t", "_s", "_p")


def _bigram(c: str, i: Column) -> Column:
    return F.lit(K) + (F.get(c, i) * 31 + F.get(c, i + 1)) % K


def with_codes(docs: DataFrame, raw: Column) -> DataFrame:
    return docs.withColumn("_c", F.transform(raw, lambda w: F.crc32(w.cast("binary"))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled good."""
    return labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def weights(docs: DataFrame, labels: DataFrame) -> list[int]:
    """Fixed-point log ratios of the ``2 * K`` buckets (bounded, whatever the input)."""
    ids = trusted_ids(labels).select("doc_id", F.lit(1).alias("_t")).hint("shuffle_hash")      # ids are hashed, texts not sorted
    known = docs.select("doc_id", "text").filter("doc_id IS NOT NULL").join(ids, "doc_id", "left").select("text", F.coalesce("_t", F.lit(0)).alias("t"))
    rows = known.unionAll(docs.filter("doc_id IS NULL").select("text", F.lit(0).alias("t")))    # these would meet in one task
    coded = with_codes(rows, words(F.col("text")))
    grams = (coded.select("t", F.posexplode("_c").alias("i", "c"), "_c")
             .select("t", F.explode(F.array(F.col("c") % K, _bigram("_c", F.col("i")))).alias("bucket"))
             .filter("bucket IS NOT NULL"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target")).collect()
    raw, target = [0] * (2 * K), [0] * (2 * K)
    for r in counts:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return [0] * (2 * K)
    base = math.log(n_raw + SMOOTHING * 2 * K) - math.log(n_target + SMOOTHING * 2 * K)
    return [round((math.log(t + SMOOTHING) - math.log(r + SMOOTHING) + base) * UNIT)
            for t, r in zip(target, raw, strict=True)]


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept of every row."""
    w = F.from_json(F.lit(json.dumps(weights(docs, labels))), "array<long>")
    rows = with_codes(with_base(docs), F.col("_words"))
    last = F.size("_c") - 1
    total = F.aggregate(
        F.when(last >= 0, F.sequence(F.lit(0), last)), F.lit(0).cast("long"),
        lambda acc, i: acc + F.get(w, (F.get("_c", i) % K).cast("int"))
        + F.coalesce(F.get(w, _bigram("_c", i).cast("int")), F.lit(0).cast("long")))
    rows = rows.withColumn("_total", F.coalesce(total, F.lit(0).cast("long")))
    # written, so that a filter on the verdict reads numbers and is not pushed into the arrays above
    rows = staged(rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_total"), "rules-counts")
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), F.col("_total").alias("llr"),
                       (~failed & (F.col("_total") >= F.lit(round(LEAST * UNIT)) * n_grams)).alias("kept"))
