"""Column functions: results, trends, scouts, keys, encodings, masks."""

from pyspark.sql import functions as F

from pitchlake.functions import expressions as X
from pitchlake.operators import governance as G


def test_match_result_and_points(spark):
    df = spark.createDataFrame([(2, 1), (0, 0), (1, 3), (None, 1), (None, None)], "h int, a int")
    out = df.select(X.match_result(F.col("h"), F.col("a")).alias("r")).collect()
    assert [r.r for r in out] == ["V", "E", "D", None, None]
    pts = df.select(X.points_from_result(X.match_result(F.col("h"), F.col("a"))).alias("p")).collect()
    assert [r.p for r in pts] == [3, 1, 0, 0, 0]


def test_trend_label_band_and_null(spark):
    df = spark.createDataFrame([(11.1, 10.0), (8.9, 10.0), (10.5, 10.0), (5.0, None)], "c double, p double")
    out = [r.t for r in df.select(X.trend_label(F.col("c"), F.col("p")).alias("t")).collect()]
    assert out == ["subindo", "caindo", "estavel", "estavel"]


def test_status_decode(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (6,), (None,)], "s int")
    out = [r.d for r in df.select(X.decode_market_status(F.col("s")).alias("d")).collect()]
    assert out == ["Aberto", "Fechado", "Desconhecido", "Em Manutenção", "Fim de Rodada", "Desconhecido"]


def test_parse_scouts_edge_cases(spark):
    rows = [('{"G": 2, "A": 1}',), ("{}",), (None,), ("not json",), ('{"G": "1.0", "CA": "x"}',)]
    df = X.parse_scouts(spark.createDataFrame(rows, "scout_json string"))
    got = [(r.scout_gol, r.scout_assistencia, r.scout_cartao_amarelo) for r in df.collect()]
    assert got == [(2, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 0, 0)]
    assert len(df.columns) == 20


def test_keys_are_deterministic_and_null_safe(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    out = df.select(X.row_key("k", "v").alias("rk"), X.surrogate_key("k", "v").alias("sk")).collect()
    assert out[0].rk != out[1].rk and len(out[0].rk) == 64
    assert out[1].sk is not None and len(out[1].sk) == 32


def test_one_hot_drops_first_and_unseen_is_zero(spark):
    df = spark.createDataFrame([(1,), (3,), (9,)], "p int")
    out = df.select(*X.one_hot(F.col("p"), [1, 2, 3], "pos")).collect()
    assert [tuple(r) for r in out] == [(0, 0), (0, 1), (0, 0)]


def test_masks_null_and_one_char(spark):
    df = spark.createDataFrame([("john@ex.com", "555-123-4567", "J"), (None, None, None)],
                               "email string, phone string, name string")
    m = G.mask_columns(df, {"email": "email", "phone": "phone", "name": "name"}).collect()
    assert m[0].email == "j***@ex.com" and m[0].phone == "***-***-4567" and m[0].name == "J"
    assert m[1].email is None and m[1].phone is None and m[1].name is None


def test_wall_clock_helpers_ignore_session_zone(spark):
    """1995-10-15 00:00 does not exist in Sao Paulo (DST gap); NTZ helpers keep it."""
    df = spark.createDataFrame([("1995-10-15 00:00:00",), ("2024-01-01 00:00:07.179575",)], "s string") \
        .select(F.to_timestamp_ntz("s").alias("t"))
    cols = [X.ntz_epoch_seconds(F.col("t")).alias("e"), X.ntz_text(F.col("t")).alias("x"),
            X.ntz_day(F.col("t")).cast("string").alias("d")]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        utc = [tuple(r) for r in df.select(*cols).collect()]
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        sp = [tuple(r) for r in df.select(*cols).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == sp
    assert utc[0] == (813715200, "1995-10-15 00:00:00", "1995-10-15 00:00:00")
