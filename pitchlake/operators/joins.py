"""Join strategies: pre-aggregated joins, size-checked broadcast, salted skew join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_MB = 100     # the reference's broadcast guideline


def customer_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Aggregate orders per customer first, then left join and zero-fill.

    Aggregating before the join keeps the join 1:1 and shuffles one row per
    customer instead of every order.
    """
    agg = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("pedidos"),
        F.round(F.sum("o_totalprice"), 2).alias("valor_total"),
        F.min("o_orderdate").alias("primeiro_pedido"),
        F.max("o_orderdate").alias("ultimo_pedido"))
    j = customers.select("c_custkey", "c_name").join(agg, "c_custkey", "left")
    return j.select("c_custkey", "c_name",
                    F.coalesce(F.col("pedidos"), F.lit(0)).alias("pedidos"),
                    F.coalesce(F.col("valor_total"), F.lit(0.0)).alias("valor_total"),
                    "primeiro_pedido", "ultimo_pedido")


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan in bytes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def smart_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_mb: float = DEFAULT_BROADCAST_MB) -> DataFrame:
    """Broadcast ``small`` only when its estimated size is below ``max_mb``.

    Otherwise the join carries no hint: the planner shuffles, and AQE may still
    broadcast at runtime once the real size is known.
    """
    if estimated_bytes(small) <= max_mb * 1024 * 1024:
        small = F.broadcast(small)
    return big.join(small, on, how)


#: Rows of one key that a task takes before the key is split.
ROWS_PER_SALT = 1_000_000


#: Keys that the sketch tracks in every task, and that it may report; both bound what is broadcast.
TRACKED, MAX_HOT = 10_000, 1_000


def hot_keys(df: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Keys with more rows than a task should take, and into how many salts to split them.

    Counted by a frequent-items sketch: every task keeps ``TRACKED`` keys, the
    sketches are merged, and at most ``MAX_HOT`` keys come out.  No row is
    shuffled by its key.  A key that the sketch leaves out holds less than a
    thousandth of the rows.
    """
    found = df.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {MAX_HOT}, {TRACKED})").alias("_top"))
    found = found.select(F.explode("_top").alias("_t")).select(F.col("_t.item").alias(key), F.col("_t.count").alias("_rows"))
    return found.filter(F.col("_rows") > rows_per_salt).select(
        key, F.ceil(F.col("_rows") / F.lit(rows_per_salt)).cast("int").alias("_salts"))


def salted_join(big: DataFrame, small: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT,
                how: str = "inner") -> DataFrame:
    """Spread the hot keys of ``big`` over several tasks before its first shuffle.

    The hot keys (at most ``MAX_HOT``) are broadcast, so ``big`` gets its salts
    where it is read.  A row's salt is its number within its partition, so
    equal rows are dealt out evenly too; ``big`` should be a scan or a written
    table, whose partitions a retried task reads in the same order.  The small
    side is repeated for hot keys alone.  Rows with a null key match nothing
    and are dealt out like hot ones.  The result equals the plain equi-join for
    inner, left, right and full.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"salted_join does not support {how!r}")
    hot = F.broadcast(hot_keys(big, key, rows_per_salt))          # MAX_HOT rows
    number = F.monotonically_increasing_id()
    salts = F.coalesce("_salts", F.when(F.col(key).isNull(), F.lit(TRACKED)).otherwise(F.lit(1)))
    b = big.withColumn("_row", number).join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)), salts).cast("int")).drop("_salts", "_row")
    s = small.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    out = b.join(s, [key, "_salt"], "left" if how in ("left", "full") else "inner").drop("_salt")
    if how in ("right", "full"):                 # a small row without any big row, once
        alone = small.join(big.select(key).distinct(), key, "left_anti")
        out = out.unionByName(alone, allowMissingColumns=True)
    return out
