"""URL filters: an as-of join of captures with dated list entries.

List entries (``list_name``, ``verdict`` block or allow, ``kind`` domain or
url, ``value``, ``action`` add or remove, ``on`` a date) become validity
intervals: an entry is active from the day of an add to the day before the
next remove.  A capture (``page_id``, ``url``, ``fetched_on``) is judged by the
entries active on its day: a ``domain`` entry covers its host and all hosts
under it, a ``url`` entry one host and path (no query, no fragment).  The most
specific active entry decides: url before domain, then the longer domain, then
allow before block.  Without one the capture is kept.

Entries are dated by the day, so all captures of a host on a day get the same
answer.  Captures are therefore first reduced to distinct (host, day) and
(host and path, day); only those are joined with the intervals, on the value
with a range condition, and the answers are joined back.  A host with a third
of all captures is as many rows as there are days; the join back is an equi
join that Spark may split where it is skewed.

All of it is SQL functions.

Edge cases: an add and a remove on one day leave the entry active; repeated
adds are one.  Entries with a null field are not used.  Null, empty and
relative URLs have no host, and captures without a day are before every entry:
both match nothing and are kept.  Rows that repeat a page_id are judged each.
Empty captures give an empty result, empty lists keep everything.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host without a port and a final dot (no host: empty)."""
    return F.lower(F.rtrim(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), F.lit(".")))


def path_of(url: Column) -> Column:
    """Path without final slashes."""
    return F.rtrim(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2), F.lit("/"))


def domains_of(host: Column) -> Column:
    """The host and the domains above it of two labels or more (an address: itself)."""
    labels = F.split(host, "\\.")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).when(host.rlike("^[0-9.]+$"), F.array(host)).otherwise(above)


def intervals(entries: DataFrame) -> DataFrame:
    """list_name, verdict, kind, value, valid_from, valid_to (not included)."""
    key = ("list_name", "verdict", "kind", "value")
    days = (entries.select(*key, "action", F.col("on").cast("date").alias("on")).dropna()
            .groupBy(*key, "on").agg(F.max(F.col("action") == "add").alias("active")))
    w = Window.partitionBy(*key).orderBy("on")
    turns = (days.withColumn("before", F.lag("active").over(w))
             .filter(F.coalesce(F.col("before") != F.col("active"), F.col("active"))))
    spans = turns.withColumn("valid_to", F.coalesce(F.lead("on").over(w), F.lit(FOREVER).cast("date")))
    return spans.filter("active").select(*key, F.col("on").alias("valid_from"), "valid_to")


def _active(keys: DataFrame, spans: DataFrame) -> DataFrame:
    """keys (value, day) with the entries active on the day."""
    on = (keys["value"] == spans["value"]) & (keys["day"] >= spans["valid_from"]) & (keys["day"] < spans["valid_to"])
    return keys.join(spans, on).drop(spans["value"])


def _answer(by: list[str], hits: DataFrame, rank: Column) -> DataFrame:
    """Number of active entries, and the deciding one (least rank)."""
    entry = F.struct(rank.alias("rank"), F.when(F.col("verdict") == "allow", 0).otherwise(1).alias("block"),
                     "list_name", "value", "verdict")
    return hits.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(entry).alias("first"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, host, fetched_on, n_active, list_name, value, verdict, kept of every capture."""
    spans = intervals(entries)
    rows = captures.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                           F.col("fetched_on").cast("date").alias("day"))
    rows = rows.withColumn("address", F.when(F.col("host") != "", F.concat("host", "path")))
    hosts = (rows.filter("host <> '' AND day IS NOT NULL").select("host", "day").distinct()
             .select("host", "day", F.explode(domains_of(F.col("host"))).alias("value")))
    by_host = _answer(["host", "day"], _active(hosts, spans.filter("kind = 'domain'")), 1_000_000 - F.length("value"))
    urls = rows.filter("address IS NOT NULL AND day IS NOT NULL").select(F.col("address").alias("value"), "day").distinct()
    by_url = _answer(["value", "day"], _active(urls, spans.filter("kind = 'url'")), F.lit(0))
    by_url = by_url.select(F.col("value").alias("address"), "day", F.col("n").alias("n_url"), F.col("first").alias("first_url"))
    out = rows.join(by_host, ["host", "day"], "left").join(by_url, ["address", "day"], "left")
    first = F.coalesce("first_url", "first")
    return out.select("page_id", "host", F.col("day").alias("fetched_on"),
                      (F.coalesce("n", F.lit(0)) + F.coalesce("n_url", F.lit(0))).cast("long").alias("n_active"),
                      first["list_name"].alias("list_name"), first["value"].alias("value"),
                      F.coalesce(first["verdict"], F.lit("none")).alias("verdict"),
                      (F.coalesce(first["verdict"], F.lit("none")) != "block").alias("kept"))
