"""Line de-duplication across documents by a deletion-neighbourhood join.

A line is dropped if an earlier line (by doc_id, then line number) is equal,
or, for lines of ``MIN_WORDS`` words or more, within one word edit: one word
replaced, added or missing.  Earlier lines count whether or not they stay
themselves.  Lines without a word are never dropped.

1. Equal lines are reduced to their earliest place (128-bit hashes).
2. Two lines one edit apart agree in their first or their last half, so only
   lines that share a half with another line go on (nothing else can match).
3. Each of these emits its deletion variants: a hash of the line without word
   j for every j, and of the whole line.  The hash is the exclusive or of
   hashes of (place, word); block-wise running sums, made once per line, make
   all variants of a line of m words cost m * sqrt(m), not m * m.
4. Equal variants meet; a variant that occurs once goes before anything else
   is done.  The variants of (line without word j) with one j are
   lines that differ in word j alone; a whole line meets the lines that have
   one word more.  Per variant only the earliest places are kept, by
   aggregation, so a variant that a third of all lines share makes no pairs.
5. The earliest place found for a line is verified on the words themselves.

All of it is SQL functions.

Edge cases: null and empty texts have no lines with words.  A null doc_id
comes before all others.  Rows that repeat a doc_id share their places: equal
lines at the same place are both kept.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import WORD_BREAKS, discard, release, staged, text_or_empty, words

MIN_WORDS = 8
_NO_ID = -(1 << 63)


def lines_of(docs: DataFrame) -> DataFrame:
    """doc, line_no, line of every line that has a word."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc")
    return (docs.select(doc, F.posexplode(F.split(text_or_empty(F.col("text")), "\n")).alias("line_no", "line"))
            .filter(F.col("line").rlike(r"[^ \t\x0b\x0c\r]")))          # ends at the first such character


def _identity(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g")]


def _line_words(line: Column) -> Column:
    """:func:`words` of a line; blanks other than spaces are rare, and replacing them is dear."""
    return F.when(line.rlike(f"[{WORD_BREAKS}]"), words(line)).otherwise(F.array_remove(F.split(line, " "), ""))


def _half_keys() -> Column:
    """Hashes of the first and last halves, as one of m and of m - 1 words (``_w``: the words)."""
    m = F.size("_w")
    keys = []
    for s in (m, m - 1):
        p = F.floor(s / 2).cast("int")
        keys += [F.xxhash64(F.lit("first"), s, F.slice("_w", F.lit(1), p)),
                 F.xxhash64(F.lit("last"), s, F.slice("_w", m - (s - p) + 1, s - p))]
    return F.when(m >= MIN_WORDS, F.array(*keys))


def line_table(docs: DataFrame) -> DataFrame:
    """doc, line_no, h, g (identity) and half keys of every line that has a word."""
    rows = lines_of(docs).withColumn("_w", _line_words(F.col("line")))
    return rows.select("doc", "line_no", *_identity(F.col("line")), _half_keys().alias("keys"))


def distinct_lines(rows: DataFrame) -> DataFrame:
    """h, g, doc, line_no (earliest place) and half keys of every distinct line of a line table."""
    first = F.min(F.struct("doc", "line_no")).alias("at")
    return rows.groupBy("h", "g").agg(first, F.first("keys").alias("keys")).select("h", "g", "at.doc", "at.line_no", "keys")


def candidates(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """doc, line_no, w (words) of the distinct lines that share a half with another."""
    keyed = distinct.select("doc", "line_no", F.explode(F.array_distinct("keys")).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    places = keyed.join(shared, "key").select("doc", "line_no").distinct()
    wanted = places.groupBy("doc").agg(F.collect_set("line_no").alias("wanted"))      # lines of one document
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), "text").join(wanted, "doc")
    split = texts.select("doc", "wanted", F.split(text_or_empty(F.col("text")), "\n").alias("lines"))
    lines = split.select("doc", F.explode("wanted").alias("line_no"), "lines")
    found = lines.select("doc", "line_no", words(F.get("lines", F.col("line_no"))).alias("w")).distinct()
    return found.filter(F.size("w") >= MIN_WORDS)       # rows that repeat a doc_id may have a shorter line in that place


def _running(values: Column) -> Column:
    """Exclusive or of the first 0, 1, ... values."""
    return F.aggregate(values, F.array(F.lit(0).cast("long")),
                       lambda a, x: F.array_append(a, F.element_at(a, -1).bitwiseXOR(x)))


def variants(lines: DataFrame) -> DataFrame:
    """doc, line_no, v (hash of the variant), j (the word left out, -1: none)."""
    rows = lines.select("doc", "line_no", F.size("w").alias("m"),
                        F.transform("w", lambda x, i: F.xxhash64(i, x)).alias("here"),           # words at their places
                        F.transform("w", lambda x, i: F.xxhash64(i - 1, x)).alias("moved"))      # one place to the left
    rows = rows.withColumn("b", F.ceil(F.sqrt("m")).cast("int"))
    block = F.sequence(F.lit(0), F.floor(F.col("m") / F.col("b")).cast("int"))                   # the last may be empty

    def blocks(c: str) -> Column:
        return F.transform(block, lambda k: _running(F.slice(c, k * F.col("b") + 1, F.col("b"))))

    rows = rows.withColumns({"here": blocks("here"), "moved": blocks("moved")})
    rows = rows.withColumns({f"_{c}": _running(F.transform(c, lambda x: F.element_at(x, -1))) for c in ("here", "moved")})
    at = rows.select("*", F.explode(F.sequence(F.lit(-1), F.col("m") - 1)).alias("j"))

    def before(n: Column, c: str) -> Column:
        """Exclusive or of the first n values."""
        k = F.floor(n / F.col("b")).cast("int")
        return F.get(f"_{c}", k).bitwiseXOR(F.get(F.get(c, k), n - k * F.col("b")))

    j, m = F.col("j"), F.col("m")
    left_out = before(j, "here").bitwiseXOR(before(j + 1, "moved")).bitwiseXOR(before(m, "moved"))
    value = F.when(j < 0, F.xxhash64(m, before(m, "here"))).otherwise(F.xxhash64(m - 1, left_out))
    return at.select("doc", "line_no", value.alias("v"), "j")


def within_one_edit(a: Column, b: Column) -> Column:
    """True if two different word arrays are one word edit apart."""
    longer, shorter = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    d = F.array_position(F.zip_with(longer, shorter, lambda x, y: ~x.eqNullSafe(y)), True).cast("int")   # first difference, from 1
    rest, n = F.slice(longer, d + 1, F.size(longer)), F.size(longer) - F.size(shorter)
    return F.when(d == 0, n == 0).when(n == 0, rest == F.slice(shorter, d + 1, F.size(longer))) \
        .when(n == 1, rest == F.slice(shorter, d, F.size(longer))).otherwise(False)


def near_lines(lines: DataFrame) -> DataFrame:
    """doc, line_no of the lines that are one edit from an earlier line."""
    v = variants(lines)
    again = v.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
    v = staged(v.join(again, "v"), "lines-variants")
    release(lines.sparkSession)
    at = F.struct("doc", "line_no")
    by_word = v.groupBy("v", "j").agg(F.min(at).alias("least"), F.count(F.lit(1)).alias("n"))
    by_word = staged(by_word.withColumn("whole", F.col("j") < 0), "lines-met")
    release(lines.sparkSession)
    sides = by_word.groupBy("v").agg(F.min(F.when(F.col("whole"), F.col("least"))).alias("least_whole"),
                                     F.min(F.when(~F.col("whole"), F.col("least"))).alias("least_part"),
                                     F.max("n").alias("most"))
    useful = sides.filter("most > 1 OR (least_whole IS NOT NULL AND least_part IS NOT NULL)")
    met = by_word.join(useful, "v").select("v", "j", F.least(
        F.when(F.col("j") >= 0, F.col("least")), F.when(F.col("j") < 0, F.col("least_part")).otherwise(F.col("least_whole"))).alias("near"))
    near = (v.join(met, ["v", "j"]).filter(F.col("near") < at).groupBy("doc", "line_no").agg(F.min("near").alias("near"))
            .select("doc", "line_no", F.col("near.doc").alias("near_doc"), F.col("near.line_no").alias("near_line")))
    pairs = near.join(lines, ["doc", "line_no"]).join(
        lines.select(F.col("doc").alias("near_doc"), F.col("line_no").alias("near_line"), F.col("w").alias("near_w")),
        ["near_doc", "near_line"])
    return pairs.withColumn("ok", within_one_edit(F.col("w"), F.col("near_w"))).filter("ok").select("doc", "line_no")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with a word), n_equal, n_near, n_kept, dropped (line numbers) of every doc_id."""
    spark = docs.sparkSession
    table = staged(line_table(docs), "lines-table")                     # every text is split and hashed once
    distinct = staged(distinct_lines(table), "lines-distinct")
    places = staged(table.select("doc", "line_no", "h", "g"), "lines-places")
    discard(table)                                                      # half keys are needed for the candidates alone
    release(spark)
    lines = staged(candidates(docs, distinct), "lines-candidates")
    release(spark)
    near = near_lines(lines).select("doc", "line_no", F.lit(True).alias("near"))
    known = staged(distinct.select("h", "g", "doc", "line_no").join(near, ["doc", "line_no"], "left"), "lines-known")
    discard(distinct)
    release(spark)
    known = known.select("h", "g", F.struct("doc", "line_no").alias("least"), F.coalesce("near", F.lit(False)).alias("near"))
    rows = places.join(known, ["h", "g"])
    equal = F.col("least") < F.struct("doc", "line_no")
    found = rows.select("doc", "line_no", equal.alias("equal"), (~equal & F.col("near")).alias("near"))
    found = found.withColumn("out", F.col("equal") | F.col("near"))
    per_doc = found.groupBy("doc").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("equal").alias("n_equal"), F.count_if("near").alias("n_near"),
        F.sort_array(F.collect_list(F.when(F.col("out"), F.col("line_no")))).alias("dropped"))
    ids = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc")).distinct()
    out = ids.join(per_doc, "doc", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", F.coalesce("n_lines", zero).alias("n_lines"), F.coalesce("n_equal", zero).alias("n_equal"),
                      F.coalesce("n_near", zero).alias("n_near"),
                      F.coalesce(F.col("n_lines") - F.col("n_equal") - F.col("n_near"), zero).alias("n_kept"),
                      F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def clean_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (same columns) without the dropped lines; null texts stay null."""
    out = dropped_lines(docs).select(F.col("doc_id").alias("_id"), F.col("dropped").alias("_dropped"))
    joined = docs.join(out, docs["doc_id"].eqNullSafe(out["_id"]), "left")
    kept = F.filter(F.split(docs["text"], "\n"), lambda x, i: ~F.array_contains(out["_dropped"], i))
    clean = F.when(docs["text"].isNotNull(), F.array_join(kept, "\n")).alias("text")
    return joined.select(*[clean if c == "text" else docs[c] for c in docs.columns])
