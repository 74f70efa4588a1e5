"""Benchmark decontamination by template windows and slot consistency.

Texts and benchmark items are canonicalised word by word: numbers, the units
after them and names (capitalised words inside a sentence) become typed
placeholders, the rest is lower-cased and loses its punctuation.  A
re-parameterised question ("Anna has 3 apples" / "Bert has 7 apples") has the
template of the original.

1. Every window of ``WINDOW`` canonical words of every text is hashed and
   joined with the windows of the items.  A template window counts only if
   ``MIN_LITERAL`` of its words are no placeholders.  Items shorter than a
   window are matched whole; items under ``MIN_ITEM`` words identify nothing
   and are left out.  A window has several readings, each with a key:

   - the first one, in which a capitalised word at a sentence's start is literal;
   - one for every set of such words (and capitalised words behind a quote or
     bracket) that is read as names;
   - its words as they are, in lower case and with their numbers, without
     regard to ``MIN_LITERAL``, so that verbatim copies need no literal words.
2. Matches are summed per (document, item, shift), where shift is the
   document position less the item position: how many item words are covered,
   and which document word fills which slot of the item.
3. Slots are consistent if equal item values are filled with equal document
   values.  A document is contaminated by an item if, at one shift, the slots
   are consistent and ``MIN_COVERED`` words (or the whole item, if shorter)
   are covered, or as many words in one run are equal as they are.

The counts of a pair are those of the first reading if it suffices, else of
all readings together.

The rules are regular expressions and cost far more than a look at a word, so
they run only where a window can match.  A placeholder or literal is decided by
the word and the two before it, and of the words of a matching window at least
``MIN_LITERAL`` (or all, word for word) are equal but for case and punctuation.
Five of eight places hold three within four neighbours; so any matching window
has, at one of its places i, words (i, i+1, i+2), (i, i+1, i+3) or (i, i+2,
i+3) of the item.  Such triples of all items are marked in a table of bits; a
place of a text whose three triples are all unmarked starts nothing.  A marked
place is cut out with the words around it, and windows are read from the cuts.
A triple sets three bits of one long; one that finds its bits set by others
costs work and changes no result.  The table has 32 bits a triple or more, up
to ``MAX_BITS``.

All of it is SQL functions; triples and window hashes are code-generated over
exploded places.  The join is on the window hash, unhinted: Spark broadcasts
the items' windows where their size allows, else it shuffles.

Edge cases: null and empty texts or items have no windows.  Rows that repeat
an id are matched each, and summed as one document.  Null ids group together.
Empty tables give an empty result.  Only doc_id, item_id and text are read.
"""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import words

WINDOW = 8
MIN_LITERAL = 5
MIN_ITEM = 5
MIN_COVERED = 13
#: Bits of the table of triples (16 MB): its bound, whatever the items.
MAX_BITS = 1 << 27

# Abbreviations and names of units that may follow a number.
UNITS = ("mm cm dm m km in ft yd mi mg g kg t lb oz ml cl dl l ms s min h "
         "hz khz mhz ghz kb mb gb tb w kw mw v a j kj cal kcal pa kpa bar eur usd gbp % € $ £ "
         "meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms "
         "liter liters litre litres second seconds minute minutes hour hours day days week weeks month months "
         "year years dollar dollars euro euros percent degree degrees").split()

NUMBER, NAME, UNIT = "\u0002num", "\u0002name", "\u0002unit"
#: Reading of a window by its words as they are.
RAW = -1


def _units() -> str:
    return "|".join(u.replace("$", "\\$") for u in sorted(UNITS, key=lambda u: (-len(u), u)))


#: (pattern, replacement with \\1): applied in order to words joined by single spaces.
RULES = (
    ("(^|[.!?] )(\\p{Lu})", "\\1\u0001\\2"),                       # the first word of a sentence is no name
    (" \\p{Lu}[^ ]*", f" {NAME}"),
    ("(^|[^\\p{L}\\p{N}\u0002])[0-9]+([.,][0-9]+)*", f"\\1{NUMBER}"),
    (f"({NUMBER}) ({_units()})([^\\p{{L}}\\p{{N}}%€$£\u0002]|$)", f"\\1 {UNIT}\\3"),
    ("[^\\p{L}\\p{N} \u0002]", ""),
)


def canonical(raw: Column) -> Column:
    """Canonical words of an array of words, one for one (punctuation alone: empty)."""
    text = F.concat_ws(" ", raw)
    for pattern, new in RULES:
        text = F.regexp_replace(text, pattern, new.replace("\\", "$"))
    return F.split(F.lower(text), " ")


def _literal(token: Column) -> Column:
    return ~token.contains("\u0002") & (token != "")


def ambiguous(raw: Column) -> Column:
    """Per word whether it may be a name or not: capitalised at a sentence's start or behind a quote or bracket."""
    marked = F.split(F.regexp_replace(F.concat_ws(" ", raw), RULES[0][0], RULES[0][1].replace("\\", "$")), " ")
    return F.transform(marked, lambda x: x.rlike("^[^\\p{L}\\p{N} ]+\\p{Lu}"))


def verbatim(raw: Column) -> Column:
    """The words in lower case without sentence punctuation around them, one for one; numbers and signs stay."""
    text = F.lower(F.concat_ws(" ", raw))
    text = F.regexp_replace(text, "(?<=[\\p{L}\\p{N}])[.,;:!?\"'()\\[\\]{}«»“”„‘’…]+(?= |$)", "")
    return F.split(F.regexp_replace(text, "(?<= |^)[\"'()\\[\\]{}«»“”„‘’…¿¡]+(?=[\\p{L}\\p{N}])", ""), " ")


_LATIN = [chr(c) for c in range(256) if c != 32]
_KEPT = [c for c in _LATIN if unicodedata.category(c)[0] in "LN"]
_DROPPED = [c for c in _LATIN if c not in _KEPT]


def folded(raw: Column, text: Column) -> Column:
    """The letters and digits of every word in lower case, one for one: equal wherever canonical literals or verbatim words are.

    Texts within Latin-1 and common typographic marks are translated by a table, others by expressions.
    """
    joined = F.concat_ws(" ", raw)
    marks = "".join(map(chr, range(0x2010, 0x2028))) + "€"
    table = F.translate(joined, "".join([*_KEPT, *_DROPPED]) + marks, "".join(c.lower() for c in _KEPT))
    other = F.translate(F.regexp_replace(F.lower(joined), "[^\\p{L}\\p{N} ]+", ""), "ς", "σ")
    return F.split(F.when(text.rlike("[^\\x{0}-\\x{FF}\\x{2010}-\\x{2027}€]"), other).otherwise(table), " ")


def _triples(fold: str, i: Column) -> list[Column]:
    a, b, c, d = [F.get(fold, i + j) for j in range(4)]
    return [F.xxhash64(F.lit(1), a, b, c), F.xxhash64(F.lit(2), a, b, d), F.xxhash64(F.lit(3), a, c, d)]


def marked_triples(items: DataFrame) -> tuple[Column, int]:
    """The table of bits as a one-row subquery (array of long), and how many longs it has."""
    fold = items.select(folded(words(F.col("text")), F.col("text")).alias("fold")).filter(F.size("fold") >= MIN_ITEM)
    n = fold.agg(F.sum(F.size("fold")).alias("n")).first()["n"] or 0
    longs = min(MAX_BITS // 64, 1 << max(10, (3 * n // 2).bit_length()))
    at = fold.select("fold", F.explode(F.sequence(F.lit(0), F.size("fold") - 1)).alias("i"))
    bits = (at.select(F.explode(F.array(*_triples("fold", F.col("i")))).alias("k")).distinct()
            .select(_slot(F.col("k"), longs).alias("slot"), _bits_of(F.col("k")).alias("bit"))
            .unionAll(items.sparkSession.range(longs).select(F.col("id").cast("int"), F.lit(0).cast("long")))
            .groupBy("slot").agg(F.bit_or("bit").alias("bit")))
    row = bits.agg(F.sort_array(F.collect_list(F.struct("slot", "bit"))).alias("all"))
    return row.select(F.transform("all", lambda x: x["bit"])).scalar(), longs


def _slot(key: Column, longs: int) -> Column:
    return key.bitwiseAND(F.lit(longs - 1)).cast("int")


def _bits_of(key: Column) -> Column:
    out = F.lit(0).cast("long")
    for k in (58, 52, 46):
        place = F.call_function("shiftrightunsigned", key, F.lit(k)).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


#: Per set of ambiguous places of a window (as bits) its subsets: the places read as names.
_READINGS = [[m for m in range(1 << WINDOW) if m & ~places == 0] for places in range(1 << WINDOW)]


def _readings(places: Column) -> Column:
    """The readings of a window, and RAW for its words as they are."""
    table = F.from_json(F.lit(json.dumps([[*x, RAW] for x in _READINGS])), "array<array<int>>")
    return F.get(table, places)


def _bits(flags: str, start: Column, n: int) -> Column:
    out = F.lit(0)
    for j in range(n):
        out = out + F.when(F.get(flags, start + j), F.lit(1 << j)).otherwise(F.lit(0))
    return out


def _is_set(m: Column, j: Column) -> Column:
    return (m > 0) & (F.call_function("shiftright", m, j).bitwiseAND(F.lit(1)) == 1)


def item_windows(items: DataFrame) -> DataFrame:
    """key, item_id, pos, n (words in the window), n_item, raw_key, first_item, slots [(pos, value, free: may be no slot)]."""
    base = (items.select("item_id", words(F.col("text")).alias("raw"))
            .withColumn("canon", canonical(F.col("raw"))).withColumn("n_item", F.size("raw"))
            .withColumn("amb", ambiguous(F.col("raw"))).withColumn("plain", verbatim(F.col("raw")))
            .filter(F.col("n_item") >= MIN_ITEM).withColumn("n", F.least("n_item", F.lit(WINDOW))))
    at = base.select("*", F.explode(F.sequence(F.lit(0), F.col("n_item") - F.col("n"))).alias("pos"))
    at = at.select("*", F.explode(_readings(_bits("amb", F.col("pos"), WINDOW))).alias("m"))
    j = F.sequence(F.lit(0), F.col("n") - 1)
    part = at.withColumn("w", F.transform(j, lambda j: F.when(_is_set(F.col("m"), j), F.lit(NAME)).otherwise(F.get("canon", F.col("pos") + j))))
    raw_key = F.col("m") == RAW
    slots = F.transform(F.filter(j, lambda j: F.get("w", j).contains("\u0002")),
                        lambda j: F.struct((F.col("pos") + j).alias("at"), _value(F.get("raw", F.col("pos") + j)).alias("item"),
                                           _is_set(F.col("m"), j).alias("free")))
    key = F.when(raw_key, F.xxhash64(-F.col("n"), F.transform(F.slice("plain", F.col("pos") + 1, F.col("n")), lambda x: F.xxhash64(x)))) \
        .otherwise(F.xxhash64("n", F.transform("w", lambda x: F.xxhash64(x))))
    return (part.filter(raw_key | (F.size(F.filter("w", _literal)) >= F.least(F.lit(MIN_LITERAL), F.col("n"))))
            .select(key.alias("key"), "item_id", "pos", "n", "n_item", raw_key.alias("raw_key"),
                    (F.col("m") == 0).alias("first_item"), slots.alias("slots")))


def _value(word: Column) -> Column:
    """A slot's value: the word without case and outer punctuation."""
    return F.lower(F.regexp_replace(word, "[^\\p{L}\\p{N}]", ""))


def cuts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, place, ahead, behind, raw: the words around every marked place, two more in front for the rules.

    ``ahead`` is the index in ``raw`` of the first word a window may start with, ``behind`` that of the marked place.
    """
    table, longs = marked_triples(items)
    at = (docs.select("doc_id", "text", words(F.col("text")).alias("raw"))
          .withColumn("fold", folded(F.col("raw"), F.col("text")))
          .select("doc_id", "raw", "fold", F.explode(F.when(F.size("raw") >= MIN_ITEM, F.sequence(F.lit(0), F.size("raw") - 1))).alias("place")))
    # keys pass a generator of one row, or the filter would be pushed below them and hash every triple seven times
    at = at.select("doc_id", "raw", "place", F.inline(F.array(F.struct(*[k.alias(f"k{j}") for j, k in enumerate(_triples("fold", F.col("place")))]))))
    marked = F.lit(False)
    for key in (F.col("k0"), F.col("k1"), F.col("k2")):
        marked = marked | (F.get(table, _slot(key, longs)).bitwiseAND(_bits_of(key)) == _bits_of(key))
    first = F.greatest(F.col("place") - (WINDOW - 3), F.lit(0))
    before = F.greatest(first - 2, F.lit(0))
    return at.filter(marked).select("doc_id", "place", (first - before).alias("ahead"), (F.col("place") - before).alias("behind"),
                                    F.slice("raw", before + 1, F.col("place") + WINDOW - before).alias("raw"))


def text_windows(docs: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, key, start, first_doc, slot_words (the words of a window that has a placeholder), one row per cut and reading."""
    base = (cuts(docs, items).withColumn("canon", canonical(F.col("raw"))).withColumn("amb", ambiguous(F.col("raw")))
            .withColumn("h", F.transform("canon", lambda x: F.xxhash64(x)))
            .withColumn("v", F.transform(verbatim(F.col("raw")), lambda x: F.xxhash64(x)))
            .withColumn("p", F.transform("canon", lambda x: x.contains("\u0002"))))
    n, at, m = F.col("n"), F.col("at"), F.col("m")
    last = F.least(F.col("behind"), F.size("raw") - n)
    windows = base.select("*", F.explode(F.array(*[F.lit(x) for x in sizes])).alias("n"))
    windows = windows.select("*", F.explode(F.when(last >= F.col("ahead"), F.sequence("ahead", last))).alias("at"))
    windows = windows.select("*", F.explode(_readings(_bits("amb", at, WINDOW).bitwiseAND(F.call_function("shiftleft", F.lit(1), n) - 1))).alias("m"))
    # places behind the window are null, which a hash skips
    hashes = [F.when(F.lit(j) >= n, F.lit(None).cast("long")).when(m == RAW, F.get("v", at + j))
              .when(m.bitwiseAND(F.lit(1 << j)) != 0, F.xxhash64(F.lit(NAME))).otherwise(F.get("h", at + j)) for j in range(WINDOW)]
    slot = m > 0
    for j in range(WINDOW):
        slot = slot | ((F.lit(j) < n) & F.coalesce(F.get("p", at + j), F.lit(False)))
    return windows.select("doc_id", F.xxhash64(F.when(m == RAW, -n).otherwise(n), F.array(*hashes)).alias("key"),
                          (F.col("place") - F.col("behind") + at).alias("start"), (m == 0).alias("first_doc"),
                          F.when(slot & (m != RAW), F.slice("raw", at + 1, n)).alias("slot_words"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_covered, n_windows, n_slots of every contaminated pair."""
    bench = item_windows(items)
    short = [r["n"] for r in bench.filter(F.col("n") < WINDOW).select("n").distinct().collect()]   # under WINDOW values
    hits = text_windows(docs, items, [WINDOW, *sorted(short)]).join(bench, "key")
    filled = F.transform("slots", lambda s: F.struct(
        s["at"].alias("at"), s["item"].alias("item"),
        F.when(F.col("raw_key"), s["item"]).otherwise(_value(F.get("slot_words", s["at"] - F.col("pos")))).alias("doc"), s["free"].alias("free")))
    # a word that may be no name and is the same in both is no slot
    filled = F.transform(F.filter(filled, lambda s: ~(s["free"] & (s["item"] == s["doc"]))),
                         lambda s: F.struct(s["at"], s["item"], s["doc"]))
    first = F.col("first_doc") & F.col("first_item")
    place = F.sequence("pos", F.col("pos") + F.col("n") - 1)

    def union(arrays: Column) -> Column:
        return F.array_distinct(F.flatten(F.collect_set(arrays)))

    by_shift = (hits.select("doc_id", "item_id", (F.col("start") - F.col("pos")).alias("shift"), "pos", "n", "n_item", "raw_key",
                            first.alias("first"), place.alias("place"), filled.alias("filled"))
                .groupBy("doc_id", "item_id", "shift")
                .agg(F.max("n_item").alias("n_item"), F.max("n").alias("n"),
                     F.sort_array(F.collect_set(F.when(F.col("raw_key"), F.col("pos")))).alias("same"),
                     F.collect_set("pos").alias("windows"), union(F.col("place")).alias("cover"), union(F.col("filled")).alias("filled"),
                     F.collect_set(F.when(F.col("first"), F.col("pos"))).alias("windows1"),
                     union(F.when(F.col("first"), F.col("place"))).alias("cover1"),
                     union(F.when(F.col("first"), F.col("filled"))).alias("filled1")))
    need = F.least(F.lit(MIN_COVERED), F.col("n_item"))

    def consistent(filled: str) -> Column:
        pairs = F.array_distinct(F.transform(filled, lambda s: F.struct(s["item"], s["doc"])))
        return F.size(pairs) == F.size(F.array_distinct(F.transform(filled, lambda s: s["item"])))

    ahead = need - F.col("n")           # so many windows later, a run of equal words is long enough
    run = F.exists(F.transform("same", lambda x, i: F.coalesce(F.get("same", i + ahead) == x + ahead, F.lit(False))), lambda x: x)
    by_shift = by_shift.withColumns({"ok1": (F.size("cover1") >= need) & consistent("filled1"),
                                     "ok": (F.size("cover") >= need) & (consistent("filled") | run)})

    def most(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("ok1"), F.size(name + "1"))), F.max(F.size(name))).cast("long")

    return (by_shift.filter("ok OR ok1").groupBy("doc_id", "item_id")
            .agg(most("cover").alias("n_covered"), most("windows").alias("n_windows"), most("filled").alias("n_slots")))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with the columns of ``docs``."""
    bad = contaminated(docs, items).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
