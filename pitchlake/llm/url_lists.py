"""Dated captures and lists derived from ``pages``, which has neither dates nor lists.

Every host, parent domain and some addresses get adds and removes on days
drawn from their crc32; every page is fetched on a day drawn from its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import id_crc
from pitchlake.llm.url_filter import host_of, path_of

FIRST_DAY = "2024-01-01"
#: (list, verdict, kind, remainder of the crc by 6 that lists a value, day of the add, days to the remove, to the next add)
LISTS = (("spam", "block", "domain", 0, 150, 120, 60), ("adult", "block", "domain", 1, 250, 200, 90),
         ("trusted", "allow", "domain", 2, 100, 250, 30), ("takedown", "block", "url", 3, 300, 40, 20))


def day(n: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))


def captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", day(id_crc(F.col("page_id")) % 366).alias("fetched_on"))


def entries(pages: DataFrame) -> DataFrame:
    host = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).filter("host <> ''")
    names = host.select("host").distinct()
    parent = names.select(F.regexp_replace("host", "^[^.]+\\.(.+\\..+)$", "$1").alias("value"))
    domains = names.select(F.col("host").alias("value")).unionAll(parent).select("value", F.lit("domain").alias("kind"))
    urls = host.select(F.concat("host", "path").alias("value"), F.lit("url").alias("kind"))
    values = domains.unionAll(urls).distinct().withColumn("c", id_crc(F.col("value")))
    out = None
    for name, verdict, kind, part, first, stay, pause in LISTS:
        c, listed = F.col("c"), values.filter((F.col("kind") == kind) & (F.col("c") % 6 == part))
        add = c % first
        remove = add + 1 + c % stay
        turns = F.array(F.struct(F.lit("add").alias("action"), day(add).alias("on")),
                        F.struct(F.lit("remove").alias("action"), day(remove).alias("on")),
                        F.struct(F.lit("add").alias("action"), day(remove + c % pause).alias("on")))
        one = listed.select(F.lit(name).alias("list_name"), F.lit(verdict).alias("verdict"), "kind", "value",
                            F.inline(F.slice(turns, F.lit(1), (1 + c % 3).cast("int"))))
        out = one if out is None else out.unionAll(one)
    return out
