"""Join strategies: plans on both sides of the size limit, salted joins of every kind."""

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import governance as G
from pitchlake.operators import joins as J


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_broadcast_follows_the_size(spark, tmpdir_path):
    path = tmpdir_path + "/small"
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(path)
    small, big = spark.read.parquet(path), spark.range(5000).withColumnRenamed("id", "k")
    assert 0 < J.estimated_bytes(small) < 1 << 20
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(J.smart_join(big, small, "k"))
        over = J.smart_join(big, small, "k", max_mb=0.0001)
        assert "SortMergeJoin" in _plan(over) and "Hint" not in over._jdf.queryExecution().analyzed().toString()
        assert over.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_salted_join_equals_the_plain_join(spark, how):
    big = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None))
                                  .otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("x"))
    small = spark.createDataFrame([(7, "hot"), (7, "twice"), (8, "b"), (99, "alone"), (None, "null")], "k long, y string")
    got = J.salted_join(big, small, "k", rows_per_salt=50, how=how)
    want = big.join(small, "k", how).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert [(r["k"], r["_salts"]) for r in J.hot_keys(big, "k", 50).filter("k IS NOT NULL").collect()] == [(7, 7)]


def test_salted_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        J.salted_join(spark.range(1), spark.range(1), "id", how="cross")


def test_masks(spark):
    df = spark.createDataFrame([("ana@mail.example.com", "+55 555-1234", 5), ("plain", "12-34", None), (None, None, 7)],
                               "e string, p string, i int")
    rows = df.select(G.mask_email_tld(F.col("e")), G.mask_email_local(F.col("e")), G.mask_phone_tail(F.col("p")),
                     G.pseudonym(F.col("i")), G.redact(F.col("e"))).collect()
    assert tuple(rows[0])[:3] == ("a***@***.com", "a***@mail.example.com", "+55 ***-****")
    assert tuple(rows[1])[1:4] == ("plain", "12-34", None) and rows[2][3] is not None
    assert {r[4] for r in rows} == {"[REDACTED]"}


def test_tags_of_columns_with_double_underscores(spark):
    df = spark.createDataFrame([("x@y.com", 1)], "contact__main string, n int")
    assert [tuple(r) for r in G.discover_tags({"t": df}).collect()] == [("t", "contact__main", "pii", "email")]
