"""Landed API payloads -> typed bronze rows.

The game API returns nested JSON (structs, arrays, maps keyed by id).
Here each payload arrives as one JSON string per row (from files via
``spark.read.text``/``json`` or from a stream), is parsed on the executors
with an explicit schema (``from_json``) and flattened with
``explode``/``inline`` -- the reference's driver-side Python loops become
distributed column work.

``payloads`` below builds such landed JSON from the driver tables so the
round trip can be checked: flatten(payload(X)) must give back X.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               MapType, StringType, StructField, StructType)

# ------------------------------------------------------------------ payload schemas
FECHAMENTO = StructType([StructField(n, IntegerType()) for n in ("dia", "mes", "ano", "hora", "minuto")]
                        + [StructField("timestamp", LongType())])
STATUS_SCHEMA = StructType([
    StructField("rodada_atual", IntegerType()), StructField("status_mercado", IntegerType()),
    StructField("temporada", IntegerType()), StructField("game_over", BooleanType()),
    StructField("times_escalados", IntegerType()), StructField("mercado_pos_rodada", BooleanType()),
    StructField("bola_rolando", BooleanType()), StructField("nome_rodada", StringType()),
    StructField("rodada_final", IntegerType()), StructField("cartoleta_inicial", DoubleType()),
    StructField("esquema_default_id", IntegerType()), StructField("fechamento", FECHAMENTO)])
ATHLETE_ITEM = StructType([
    StructField("atleta_id", IntegerType()), StructField("nome", StringType()),
    StructField("apelido", StringType()), StructField("apelido_abreviado", StringType()),
    StructField("slug", StringType()), StructField("foto", StringType()),
    StructField("clube_id", IntegerType()), StructField("posicao_id", IntegerType()),
    StructField("status_id", IntegerType()), StructField("rodada_id", IntegerType()),
    StructField("pontos_num", DoubleType()), StructField("media_num", DoubleType()),
    StructField("preco_num", DoubleType()), StructField("variacao_num", DoubleType()),
    StructField("jogos_num", IntegerType()), StructField("entrou_em_campo", BooleanType()),
    StructField("scout", MapType(StringType(), StringType()))])     # as text: one odd value must not void the map
ATHLETES_SCHEMA = StructType([StructField("atletas", ArrayType(ATHLETE_ITEM))])
SCORED_ITEM = StructType([
    StructField("apelido", StringType()), StructField("pontuacao", DoubleType()),
    StructField("scout", MapType(StringType(), StringType())), StructField("posicao_id", IntegerType()),
    StructField("clube_id", IntegerType()), StructField("entrou_em_campo", BooleanType())])
SCORED_SCHEMA = StructType([StructField("rodada", IntegerType()),
                            StructField("atletas", MapType(StringType(), SCORED_ITEM))])
MATCH_ITEM = StructType([
    StructField("partida_id", IntegerType()), StructField("clube_casa_id", IntegerType()),
    StructField("clube_visitante_id", IntegerType()), StructField("clube_casa_posicao", IntegerType()),
    StructField("clube_visitante_posicao", IntegerType()),
    StructField("placar_oficial_mandante", IntegerType()),
    StructField("placar_oficial_visitante", IntegerType()), StructField("partida_data", StringType()),
    StructField("timestamp", LongType()), StructField("local", StringType()),
    StructField("valida", BooleanType()), StructField("campeonato_id", IntegerType()),
    StructField("aproveitamento_mandante", ArrayType(StringType())),
    StructField("aproveitamento_visitante", ArrayType(StringType()))])
MATCHES_SCHEMA = StructType([StructField("rodada", IntegerType()),
                             StructField("partidas", ArrayType(MATCH_ITEM))])
ESCUDOS = StructType([StructField(n, StringType()) for n in ("60x60", "45x45", "30x30")])
CLUB_ITEM = StructType([StructField(n, StringType()) for n in
                        ("nome", "abreviacao", "slug", "apelido", "nome_fantasia", "url_editoria")]
                       + [StructField("escudos", ESCUDOS)])
CLUBS_SCHEMA = MapType(StringType(), CLUB_ITEM)
ROUND_ITEM = StructType([StructField("rodada_id", IntegerType()), StructField("nome_rodada", StringType()),
                         StructField("inicio", StringType()), StructField("fim", StringType())])
ROUNDS_SCHEMA = ArrayType(ROUND_ITEM)
MITO = StructType([StructField("time_id", IntegerType()), StructField("nome", StringType()),
                   StructField("nome_time", StringType()), StructField("slug", StringType()),
                   StructField("clube_id", IntegerType())])
HIGHLIGHTS_SCHEMA = StructType([StructField("rodada_id", IntegerType()), StructField("mito_rodada", MITO),
                                StructField("media_cartoletas", DoubleType()),
                                StructField("media_pontos", DoubleType())])
LEAGUE_ITEM = StructType([
    StructField("liga_id", IntegerType()), StructField("slug", StringType()), StructField("nome", StringType()),
    StructField("descricao", StringType()), StructField("tipo", StringType()), StructField("imagem", StringType()),
    StructField("criacao", StringType()), StructField("quantidade_times", IntegerType()),
    StructField("vagas_restantes", IntegerType()), StructField("mata_mata", BooleanType()),
    StructField("sem_capitao", BooleanType())])
LEAGUES_SCHEMA = ArrayType(LEAGUE_ITEM)


def _parsed(df: DataFrame, schema, col: str = "payload") -> DataFrame:
    return df.withColumn("_p", F.from_json(F.col(col), schema))


def rejected_payloads(payloads: DataFrame, schema, col: str = "payload") -> DataFrame:
    """The landed rows whose JSON does not parse with ``schema``.

    The flatteners skip such a payload; this branch keeps it, so that a run can
    count, store and repair what it skipped.
    """
    text = F.col(col)
    if isinstance(schema, StructType):
        marked = StructType([*schema.fields, StructField("_corrupt", StringType())])
        parsed = F.from_json(text, marked, {"columnNameOfCorruptRecord": "_corrupt"})
        return payloads.filter(parsed.isNull() | parsed["_corrupt"].isNotNull())
    return payloads.filter(F.from_json(text, schema).isNull())


def _scout_json(scout: Column) -> Column:
    """The scout object as JSON text with whole numbers; values that are none are left out."""
    counts = F.transform_values(scout, lambda k, v: v.try_cast("int"))
    return F.to_json(F.map_filter(counts, lambda k, v: v.isNotNull()))


def _zero(c: Column) -> Column:
    """Numeric null -> 0.0 (the reference's ``float(x or 0)``)."""
    return F.coalesce(c.cast("double"), F.lit(0.0))


def _false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# ------------------------------------------------------------------ flatteners
def flatten_status(payloads: DataFrame) -> DataFrame:
    """One status payload -> one row with ``fechamento.*`` flattened."""
    p = _parsed(payloads, STATUS_SCHEMA)
    s = "_p."
    return p.select(
        F.col(s + "rodada_atual"), F.col(s + "status_mercado"), F.col(s + "temporada"),
        _false(F.col(s + "game_over")).alias("game_over"), F.col(s + "times_escalados"),
        _false(F.col(s + "mercado_pos_rodada")).alias("mercado_pos_rodada"),
        _false(F.col(s + "bola_rolando")).alias("bola_rolando"), F.col(s + "nome_rodada"),
        F.col(s + "rodada_final"), _zero(F.col(s + "cartoleta_inicial")).alias("cartoleta_inicial"),
        F.col(s + "esquema_default_id"),
        *[F.col(f"{s}fechamento.{n}").alias(f"fechamento_{n}") for n in ("dia", "mes", "ano", "hora", "minuto")],
        F.col(s + "fechamento.timestamp").alias("fechamento_timestamp"),
        F.col("payload").alias("_raw_json"))


def explode_athletes(payloads: DataFrame) -> DataFrame:
    """``atletas[]`` -> rows; numeric null -> 0, bool null -> false,
    ``scout`` object re-serialised to JSON text."""
    p = _parsed(payloads, ATHLETES_SCHEMA).select("_rodada_captura", F.explode("_p.atletas").alias("a"))
    a = "a."
    return p.select(
        F.col(a + "atleta_id"), F.col(a + "nome"), F.col(a + "apelido"), F.col(a + "apelido_abreviado"),
        F.col(a + "slug"), F.col(a + "foto"),
        F.col(a + "clube_id"), F.col(a + "posicao_id"), F.col(a + "status_id"), F.col(a + "rodada_id"),
        *[_zero(F.col(a + c)).alias(c) for c in ("pontos_num", "media_num", "preco_num", "variacao_num")],
        F.coalesce(F.col(a + "jogos_num"), F.lit(0)).alias("jogos_num"),
        _false(F.col(a + "entrou_em_campo")).alias("entrou_em_campo"),
        _scout_json(F.col(a + "scout")).alias("scout_json"), F.to_json("a").alias("_raw_json"),
        F.col("_rodada_captura"))


def explode_scored(payloads: DataFrame) -> DataFrame:
    """Map keyed by athlete id (string) -> rows with an int id."""
    p = _parsed(payloads, SCORED_SCHEMA).select(
        F.col("_p.rodada").alias("rodada_id"), F.explode("_p.atletas").alias("k", "v"))
    return p.select(F.col("k").cast("int").alias("atleta_id"), "rodada_id", F.col("v.apelido"),
                    F.col("v.clube_id"), F.col("v.posicao_id"),
                    _zero(F.col("v.pontuacao")).alias("pontuacao"),
                    _scout_json(F.col("v.scout")).alias("scout_json"),
                    _false(F.col("v.entrou_em_campo")).alias("entrou_em_campo"))


def explode_matches(payloads: DataFrame) -> DataFrame:
    """``partidas[]`` -> rows; round = payload round else the current
    round of the capture; arrays kept as JSON text; ``valida`` default false."""
    p = _parsed(payloads, MATCHES_SCHEMA).select(
        F.coalesce(F.col("_p.rodada"), F.col("_rodada_captura")).alias("rodada_id"),
        F.explode("_p.partidas").alias("m"))
    m = "m."
    return p.select(
        F.col(m + "partida_id"), "rodada_id", F.col(m + "clube_casa_id"), F.col(m + "clube_visitante_id"),
        F.col(m + "clube_casa_posicao"), F.col(m + "clube_visitante_posicao"),
        F.col(m + "placar_oficial_mandante"), F.col(m + "placar_oficial_visitante"),
        F.col(m + "partida_data"), F.col(m + "timestamp").alias("timestamp_partida"),
        F.col(m + "local"), _false(F.col(m + "valida")).alias("valida"), F.col(m + "campeonato_id"),
        F.to_json(F.col(m + "aproveitamento_mandante")).alias("aproveitamento_mandante"),
        F.to_json(F.col(m + "aproveitamento_visitante")).alias("aproveitamento_visitante"))


def explode_clubs(payloads: DataFrame) -> DataFrame:
    """Map by club id with the nested ``escudos["60x60"]`` etc."""
    p = _parsed(payloads, CLUBS_SCHEMA).select(F.explode("_p").alias("k", "v"))
    return p.select(F.col("k").cast("int").alias("clube_id"),
                    *[F.col(f"v.{n}") for n in ("nome", "abreviacao", "slug", "apelido",
                                                 "nome_fantasia", "url_editoria")],
                    *[F.col("v.escudos").getField(s).alias(f"escudo_{s}") for s in ("60x60", "45x45", "30x30")])


def explode_rounds(payloads: DataFrame) -> DataFrame:
    """Top-level array -> rows."""
    return _parsed(payloads, ROUNDS_SCHEMA).select(F.inline("_p"))


def flatten_highlights(payloads: DataFrame) -> DataFrame:
    """Nested ``mito_rodada.*`` plus two averages defaulting to 0."""
    p = _parsed(payloads, HIGHLIGHTS_SCHEMA)
    return p.select(F.col("_p.rodada_id").alias("rodada_id"),
                    *[F.col(f"_p.mito_rodada.{n}").alias(f"mito_{n}") for n in
                      ("time_id", "nome", "nome_time", "slug", "clube_id")],
                    _zero(F.col("_p.media_cartoletas")).alias("media_cartoletas"),
                    _zero(F.col("_p.media_pontos")).alias("media_pontos"))


def explode_leagues(payloads: DataFrame) -> DataFrame:
    """Top-level array -> rows, two booleans default false."""
    p = _parsed(payloads, LEAGUES_SCHEMA).select(F.inline("_p"))
    return p.select(*[c for c in p.columns if c not in ("mata_mata", "sem_capitao")],
                    _false(F.col("mata_mata")).alias("mata_mata"),
                    _false(F.col("sem_capitao")).alias("sem_capitao"))


def add_metadata(df: DataFrame, batch_id: str, ingest_ts: str, source: str,
                 raw_cols: list[str] | None = None, file_col: bool = False) -> DataFrame:
    """Lineage columns on every bronze row.

    ``_raw_json`` is the row (or the given columns) as JSON, the ingest
    timestamp and batch id are fixed per run (passed in, never
    ``current_timestamp()``, so a retried task writes the same values).
    """
    raw = F.to_json(F.struct(*[F.col(c) for c in (raw_cols or df.columns)]))
    out = df.select("*", raw.alias("_raw_json"),
                    F.lit(ingest_ts).cast("timestamp_ntz").alias("_ingestao_timestamp"),
                    F.lit(batch_id).alias("_batch_id"), F.lit(source).alias("_source_system"))
    if file_col:
        out = out.withColumn("_source_file", F.col("_metadata.file_path"))
    return out
