"""Column -> Column helpers (the reference's SQL macros and CASE rules).

All of them are built-in Spark expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ----------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Scout codes of the game's JSON payload and the column each one lands in.
SCOUT_COLUMNS = (
    ("G", "scout_gol"),
    ("A", "scout_assistencia"),
    ("FT", "scout_finalizacao_trave"),
    ("FD", "scout_finalizacao_defendida"),
    ("FF", "scout_finalizacao_fora"),
    ("FS", "scout_falta_sofrida"),
    ("DS", "scout_desarme"),
    ("I", "scout_impedimento"),
    ("SG", "scout_saldo_gol"),
    ("DE", "scout_defesa"),
    ("DP", "scout_defesa_penalti"),
    ("GC", "scout_gol_contra"),
    ("CA", "scout_cartao_amarelo"),
    ("CV", "scout_cartao_vermelho"),
    ("FC", "scout_falta_cometida"),
    ("PS", "scout_passe_decisivo"),
    ("PC", "scout_passe_completo"),
    ("PP", "scout_pre_assistencia"),
    ("V", "scout_vitoria"),
    ("GS", "scout_gol_sofrido"),
)
# Match result letters: win / draw / loss.
WIN, DRAW, LOSS = "V", "E", "D"
# Trend labels and their +-10 % band.
TREND_UP, TREND_DOWN, TREND_FLAT = "subindo", "caindo", "estavel"
TREND_BAND = 0.10
# Market status codes.
MARKET_STATUS = {1: "Aberto", 2: "Fechado", 4: "Em Manutenção", 6: "Fim de Rodada"}
UNKNOWN = "Desconhecido"
# ----------------------------------------------------------------------------


def match_result(goals_for: Column, goals_against: Column) -> Column:
    """P02: 'V' / 'E' / 'D' from the club's point of view, NULL if unknown."""
    return (F.when(goals_for > goals_against, WIN)
            .when(goals_for == goals_against, DRAW)
            .when(goals_for < goals_against, LOSS))


def trend_label(current: Column, previous: Column) -> Column:
    """P03: 'subindo' above +10 %, 'caindo' below -10 %, else 'estavel'."""
    return (F.when(current > previous * (1 + TREND_BAND), TREND_UP)
            .when(current < previous * (1 - TREND_BAND), TREND_DOWN)
            .otherwise(TREND_FLAT))


def decode_market_status(code: Column) -> Column:
    """Simple CASE over the market status code."""
    expr = None
    for k, v in MARKET_STATUS.items():
        expr = (F.when(code == k, v) if expr is None else expr.when(code == k, v))
    return expr.otherwise(UNKNOWN)


def points_from_result(result: Column) -> Column:
    """League points of a result letter."""
    return F.when(result == WIN, 3).when(result == DRAW, 1).otherwise(0)


def result_indicators(result: Column) -> list[Column]:
    """The three 0/1 indicator columns (wins, draws, losses)."""
    return [F.when(result == WIN, 1).otherwise(0).alias("vitorias"),
            F.when(result == DRAW, 1).otherwise(0).alias("empates"),
            F.when(result == LOSS, 1).otherwise(0).alias("derrotas")]


def first_non_null(*cols: Column) -> Column:
    """The first available value."""
    return F.coalesce(*cols)


def tier_label(amount: Column, high: float = 1000, medium: float = 100) -> Column:
    """>= 1000 high, >= 100 medium, else low."""
    return F.when(amount >= high, "high").when(amount >= medium, "medium").otherwise("low")


def cents_to_units(cents: Column, precision: int = 2) -> Column:
    """P10: round(x / 100, p)."""
    return F.round(cents / F.lit(100.0), precision)


def total_goals(home: Column, away: Column) -> Column:
    """Goals of a match with unknown sides counted as 0."""
    return F.coalesce(home, F.lit(0)) + F.coalesce(away, F.lit(0))


def safe_ratio(num: Column, den: Column, default=0) -> Column:
    """num / den when den > 0, else ``default`` (ANSI-safe division)."""
    d = F.lit(default) if not isinstance(default, Column) else default
    return F.when(den > 0, num / den).otherwise(d)


# ------------------------------------------------------------------ JSON scouts
def scout_columns(json_col: Column) -> list[Column]:
    """the 20 scout counts from a JSON object, missing/invalid -> 0.

    The text is parsed once into MAP<STRING,STRING>; each value is read
    through DOUBLE so '1.0' counts as 1 and junk becomes 0 instead of
    nulling the whole map or raising under ANSI casts.
    """
    m = F.from_json(json_col, "map<string,string>")
    return [F.coalesce(m[code].try_cast("double").try_cast("int"), F.lit(0)).alias(name)
            for code, name in SCOUT_COLUMNS]


def parse_scouts(df: DataFrame, json_col: str = "scout_json", keep: bool = False) -> DataFrame:
    """F01 on a frame: appends the 20 ``scout_*`` columns."""
    out = df.select("*", *scout_columns(F.col(json_col)))
    return out if keep else out.drop(json_col)


# ---------------------------------------------------------------------- hashing
def row_key(*cols: str | Column) -> Column:
    """sha2-256 of the key columns joined with '||'."""
    return F.sha2(F.concat_ws("||", *[F.col(c) if isinstance(c, str) else c for c in cols]), 256)


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the columns joined with '-', NULLs as empty strings."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# ---------------------------------------------------------------------- encoding
def binary_encode(side: Column, flag: Column) -> list[Column]:
    """home side -> 1/0 and boolean -> 1/0."""
    return [F.when(side == "casa", 1).otherwise(0).alias("mando_casa"),
            F.coalesce(flag.cast("int"), F.lit(0)).alias("classico")]


def one_hot(col: Column, levels, prefix: str, drop_first: bool = True) -> list[Column]:
    """one 0/1 column per known level; unseen level -> all zeros."""
    lv = list(levels)[1:] if drop_first else list(levels)
    return [F.when(col == v, 1).otherwise(0).alias(f"{prefix}_{v}") for v in lv]


# ---------------------------------------------------------------------- coverage
def coverage(pred: Column, real: Column, threshold: Column | float) -> Column:
    """Share of rows whose absolute error is within the threshold."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.avg(F.when(F.abs(pred - real) <= thr, 1.0).otherwise(0.0))


# ---------------------------------------------------------------------- wall-clock time
# Spark converts TIMESTAMP_NTZ through the session time zone in date_trunc,
# date_format and timestamp_diff; these helpers stay on the wall clock, so
# results are the same in every session time zone (DST gaps included).
_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def ntz_epoch_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp (interval arithmetic)."""
    iv = c - F.expr(_EPOCH_NTZ)
    secs = (F.extract(F.lit("DAY"), iv) * 86400 + F.extract(F.lit("HOUR"), iv) * 3600
            + F.extract(F.lit("MINUTE"), iv) * 60 + F.extract(F.lit("SECOND"), iv))
    return (secs * 1000000).cast("long")


def ntz_epoch_seconds(c: Column) -> Column:
    return F.floor(ntz_epoch_micros(c) / 1000000)


def ntz_text(c: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a wall-clock timestamp."""
    return F.substring(c.cast("string"), 1, 19)


def ntz_day(c: Column) -> Column:
    """Midnight of the day of a wall-clock timestamp, as TIMESTAMP_NTZ."""
    return F.to_date(c).cast("timestamp_ntz")
