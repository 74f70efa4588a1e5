"""Data-quality rules and governance helpers."""

from pyspark.sql import functions as F

from pitchlake.operators import governance as G
from pitchlake.operators import quality as Q
from pitchlake.sources import contracts as C


def test_rules(spark):
    df = spark.createDataFrame([(1, "F", 10.0), (1, "X", -1.0), (None, "O", None)], "k int, s string, v double")
    assert Q.not_null(df, "k").count() == 1
    assert Q.unique(df, "k").collect()[0].qtd == 2
    assert Q.accepted_values(df, "s", ["F", "O"]).count() == 1
    assert Q.expression_true(df, "v >= 0").count() == 2            # NULL fails
    assert Q.non_negative(df, ["v"]).count() == 1
    kept, counts = Q.expect_or_drop(df, {"pos": "v > 0", "key": "k IS NOT NULL"})
    assert kept.count() == 1
    assert {r.regra: r.descartadas for r in counts.collect()} == {"pos": 2, "key": 1}


def test_suite_and_validate_copy(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "k int, fk int")
    parent = spark.createDataFrame([(5,), (6,)], "id int")
    s = {r.regra: r.falhas for r in Q.run_suite(df, {"k_pos": "k > 1"}, ["k"], ("fk", parent, "id")).collect()}
    assert s == {"k_pos": 2, "unique_k": 2, "relationships_fk": 1}
    v = Q.validate_copy(df, df.select("fk", "k")).collect()[0]
    assert v.contagem_igual and v.colunas_iguais and v.conteudo_igual


def test_erase_retention_row_filter(spark):
    t = {"a": spark.createDataFrame([(1, "x"), (2, "y")], "user_id int, v string"),
         "b": spark.createDataFrame([(1,)], "z int")}
    audit, remaining = G.erase_subject(t, 1, dry_run=False)
    assert [(r.tabela, r.linhas_afetadas, r.linhas_mantidas) for r in audit.collect()] == [("a", 1, 1)]
    assert remaining["a"].count() == 1
    rep, kept = G.retention({"e": spark.createDataFrame([("2020-01-01",), ("2024-01-01",)], "event_date string")
                            .withColumn("event_date", F.to_date("event_date"))}, 365, "2024-06-01")
    assert rep.collect()[0].linhas_expiradas == 1 and kept["e"].count() == 1
    acc = spark.createDataFrame([("u1", "ASIA")], "usuario string, regiao string")
    rows = spark.createDataFrame([(1, "ASIA"), (2, "EUROPE")], "id int, region string")
    assert G.row_filter(rows, acc, "u1", False).count() == 1 and G.row_filter(rows, acc, "u1", True).count() == 2


def test_contract_and_migration(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "x")], "a int, b string, extra string")
    diff = {(c, p) for c, p, _, _ in C.schema_diff(df, "a INT, b DATE, c STRING")}
    assert diff == {("b", "tipo_diferente"), ("c", "faltando"), ("extra", "extra")}
    out = C.conform(df, "a BIGINT, b DATE, c STRING")
    assert out.columns == ["a", "b", "c", "extra"] and out.collect()[0].c is None
    assert C.migrated_type("NUMBER(12,2)") == "DECIMAL(12,2)" and C.migrated_type("varchar(10)") == "STRING"
    assert C.migrated_type("NUMBER(38,0)") == "decimal(38,10)" and C.migrated_type("DATE") == "DATE"


def test_declared_tests_suite_counts(spark):
    m = {"a": spark.createDataFrame([(1, "x"), (1, None), (None, "y")], "k int, v string"),
         "b": spark.createDataFrame([(1,)], "k int")}
    tests = (("a", "k", "unique", None), ("a", "k", "not_null", None),
             ("a", "v", "accepted_values", (("x",), None)), ("a", "k", "relationships", ("b", "k")))
    got = {(r.coluna, r.teste): r.falhas for r in Q.run_declared_tests(m, tests, singular=()).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 1, ("v", "accepted_values"): 1,
                   ("k", "relationships"): 0}
