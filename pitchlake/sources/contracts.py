"""Schemas as contracts: conform, migrate types, enforce."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, _parse_datatype_string

# ----------------------------------------------------------------------------
# Source type names and the type each migrates to.
TYPE_MAP = {
    "CHAR": "STRING",
    "VARCHAR": "STRING",
    "TINYINT": "INT",
    "SMALLINT": "INT",
    "BINARY": "BINARY",
    "NUMBER": "DECIMAL",
    "VARIANT": "STRING",
    "TIMESTAMP_NTZ": "TIMESTAMP",
    "TIMESTAMP_TZ": "TIMESTAMP",
    "SUPER": "STRING",
    "TIMETZ": "TIMESTAMP",
}
# Hive DECIMAL(38,0) keys migrate with 10 fractional digits.
WIDE_DECIMAL = {"decimal(38,0)": "decimal(38,10)"}

# Declared schema of the landed market table (FLOAT columns kept as DOUBLE).
RAW_ATLETAS_MERCADO = (
    "atleta_id INT, nome STRING, apelido STRING, apelido_abreviado STRING, slug STRING, foto STRING, "
    "clube_id INT, posicao_id INT, status_id INT, rodada_id INT, pontos_num DOUBLE, media_num DOUBLE, "
    "preco_num DOUBLE, variacao_num DOUBLE, jogos_num INT, entrou_em_campo BOOLEAN, scout_json STRING, "
    "_raw_json STRING, _ingestao_timestamp TIMESTAMP, _rodada_captura INT, _batch_id STRING")
_LINEAGE = ", _ingestao_timestamp TIMESTAMP_NTZ, _batch_id STRING"
STAGING_CONTRACTS = {
    "atletas_mercado": (
        "atleta_id INT, nome STRING, apelido STRING, apelido_abreviado STRING, slug STRING, foto_url STRING, "
        "clube_id INT, posicao_id INT, status_id INT, rodada_id INT, pontos_num DOUBLE, media_num DOUBLE, "
        "preco_num DOUBLE, variacao_num DOUBLE, jogos_num INT, entrou_em_campo BOOLEAN, scout_json STRING, "
        "_rodada_captura INT" + _LINEAGE),
    "atletas_pontuados": (
        "atleta_id INT, apelido STRING, clube_id INT, posicao_id INT, pontuacao DOUBLE, scout_json STRING, "
        "entrou_em_campo BOOLEAN, rodada_id INT" + _LINEAGE),
    "clubes": (
        "clube_id INT, nome STRING, abreviacao STRING, slug STRING, apelido STRING, nome_fantasia STRING, "
        "url_editoria STRING, escudo_60x60 STRING, escudo_45x45 STRING, escudo_30x30 STRING" + _LINEAGE),
    "ligas": (
        "liga_id INT, slug STRING, nome STRING, descricao STRING, tipo STRING, imagem STRING, criacao STRING, "
        "quantidade_times INT, vagas_restantes INT, mata_mata BOOLEAN, sem_capitao BOOLEAN" + _LINEAGE),
    "mercado_status": (
        "rodada_atual INT, status_mercado INT, temporada INT, game_over BOOLEAN, times_escalados INT, "
        "mercado_pos_rodada BOOLEAN, bola_rolando BOOLEAN, nome_rodada STRING, rodada_final INT, "
        "cartoleta_inicial DOUBLE, esquema_default_id INT, fechamento_dia INT, fechamento_mes INT, "
        "fechamento_ano INT, fechamento_hora INT, fechamento_minuto INT, fechamento_timestamp BIGINT" + _LINEAGE),
    "partidas": (
        "partida_id INT, rodada_id INT, clube_casa_id INT, clube_visitante_id INT, clube_casa_posicao INT, "
        "clube_visitante_posicao INT, placar_oficial_mandante INT, placar_oficial_visitante INT, "
        "partida_data STRING, timestamp_partida BIGINT, estadio STRING, valida BOOLEAN, campeonato_id INT, "
        "aproveitamento_mandante STRING, aproveitamento_visitante STRING" + _LINEAGE),
    "pos_rodada_destaques": (
        "rodada_id INT, mito_time_id INT, mito_nome STRING, mito_nome_cartola STRING, mito_slug STRING, "
        "mito_clube_id INT, media_cartoletas DOUBLE, media_pontos DOUBLE" + _LINEAGE),
    "rodadas": "rodada_id INT, nome_rodada STRING, inicio STRING, fim STRING" + _LINEAGE,
}
# ----------------------------------------------------------------------------


def _as_schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def schema_diff(df: DataFrame, target: StructType | str) -> list[tuple[str, str, str | None, str | None]]:
    """(column, problem, expected, found) for missing / extra / wrong-type columns."""
    t = _as_schema(target)
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in t.fields}
    out = []
    for n, dt in want.items():
        if n not in have:
            out.append((n, "faltando", dt.simpleString(), None))
        elif have[n] != dt:
            out.append((n, "tipo_diferente", dt.simpleString(), have[n].simpleString()))
    for n, dt in have.items():
        if n not in want:
            out.append((n, "extra", None, dt.simpleString()))
    return out


def conform(df: DataFrame, target: StructType | str) -> DataFrame:
    """Target columns in target order and types (missing -> NULL),
    extra columns kept after them (schema evolution by appending)."""
    t = _as_schema(target)
    cols = [(F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in t.fields]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in {f.name for f in t.fields}]
    return df.select(*cols, *extra)


def migrated_type(source_type: str) -> str:
    """Target type for a source type name such as 'NUMBER(12,2)'."""
    m = re.match(r"^\s*([A-Za-z_]+)\s*(\(.*\))?\s*$", source_type)
    if not m:
        return source_type
    base, args = m.group(1).upper(), m.group(2) or ""
    tgt = TYPE_MAP.get(base, base)
    out = f"{tgt}{args}" if tgt == "DECIMAL" else tgt if base in TYPE_MAP else f"{base}{args}"
    return WIDE_DECIMAL.get(out.lower().replace(" ", ""), out)


def convert_schema(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Cast every declared column to the migrated type of its source type."""
    return df.select(*[F.col(c).cast(migrated_type(declared[c])).alias(c) if c in declared else F.col(c)
                       for c in df.columns])


def enforce_contract(df: DataFrame, contract: StructType | str) -> DataFrame:
    """Contract violations of a frame.

    Structural problems come from the schemas; for columns present with a
    different type, one aggregate over the data counts the values that do
    not fit the declared type (``try_cast`` gives NULL for a non-NULL value).
    """
    spark = df.sparkSession
    diffs = schema_diff(df, contract)
    t = _as_schema(contract)
    want: dict[str, DataType] = {f.name: f.dataType for f in t.fields}
    checks = [n for n, p, _, _ in diffs if p == "tipo_diferente"]
    schema = "coluna string, problema string, esperado string, encontrado string"
    base = spark.createDataFrame(diffs, schema)
    if not checks:
        return base.withColumn("linhas_invalidas", F.lit(None).cast("long"))
    agg = df.agg(*[F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(want[c]).isNull(), 1)).alias(c)
                   for c in checks])
    pairs = ", ".join(f"'{c}', `{c}`" for c in checks)
    bad = agg.select(F.expr(f"stack({len(checks)}, {pairs}) as (coluna, linhas_invalidas)"))
    return base.join(bad, "coluna", "left")
