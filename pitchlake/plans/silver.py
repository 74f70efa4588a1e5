"""Staging views, dimensions and facts (the silver layer).

Each builder is ``inputs -> DataFrame``; Catalyst collapses the projection
chains and pushes the filters down to the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import expressions as X
from pitchlake.operators.windows import latest_per_key

# ---------------------------------------------------------------- P01 staging
# The staging views' renames of landed columns.
STAGING_RENAMES = {
    "atletas_mercado": {"foto": "foto_url"},
    "atletas_pontuados": {"_rodada_id": "rodada_id"},
    "partidas": {"local": "estadio"},
    "pos_rodada_destaques": {"mito_nome_time": "mito_nome_cartola"},
}
STAGING_COLUMNS = {
    "atletas_mercado": ("atleta_id", "nome", "apelido", "apelido_abreviado", "slug", "foto_url", "clube_id",
                        "posicao_id", "status_id", "rodada_id", "pontos_num",
                        "media_num", "preco_num", "variacao_num", "jogos_num",
                        "entrou_em_campo", "scout_json", "_rodada_captura",
                        "_ingestao_timestamp", "_batch_id"),
    "atletas_pontuados": ("atleta_id", "apelido", "clube_id", "posicao_id", "pontuacao", "scout_json",
                          "entrou_em_campo", "rodada_id", "_ingestao_timestamp", "_batch_id"),
    "clubes": ("clube_id", "nome", "abreviacao", "slug", "apelido", "nome_fantasia", "url_editoria",
               "escudo_60x60", "escudo_45x45", "escudo_30x30", "_ingestao_timestamp", "_batch_id"),
    "ligas": ("liga_id", "slug", "nome", "descricao", "tipo", "imagem", "criacao", "quantidade_times",
              "vagas_restantes", "mata_mata", "sem_capitao", "_ingestao_timestamp", "_batch_id"),
    "mercado_status": ("rodada_atual", "status_mercado", "temporada", "game_over", "times_escalados",
                       "mercado_pos_rodada", "bola_rolando", "nome_rodada", "rodada_final", "cartoleta_inicial",
                       "esquema_default_id", "fechamento_dia", "fechamento_mes", "fechamento_ano", "fechamento_hora",
                       "fechamento_minuto", "fechamento_timestamp", "_ingestao_timestamp", "_batch_id"),
    "partidas": ("partida_id", "rodada_id", "clube_casa_id", "clube_visitante_id", "clube_casa_posicao",
                 "clube_visitante_posicao", "placar_oficial_mandante", "placar_oficial_visitante", "partida_data",
                 "timestamp_partida", "estadio", "valida", "campeonato_id", "aproveitamento_mandante",
                 "aproveitamento_visitante", "_ingestao_timestamp", "_batch_id"),
    "pos_rodada_destaques": ("rodada_id", "mito_time_id", "mito_nome", "mito_nome_cartola", "mito_slug",
                             "mito_clube_id", "media_cartoletas", "media_pontos", "_ingestao_timestamp", "_batch_id"),
    "rodadas": ("rodada_id", "nome_rodada", "inicio", "fim", "_ingestao_timestamp", "_batch_id"),
}


def staging_view(raw: DataFrame, source: str) -> DataFrame:
    """Rename landed columns and keep the view's column list."""
    df = raw
    for old, new in STAGING_RENAMES.get(source, {}).items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    cols = STAGING_COLUMNS.get(source)
    return df.select(*[c for c in cols if c in df.columns]) if cols else df


# ---------------------------------------------------------------- facts
def fct_partidas(stg_matches: DataFrame) -> DataFrame:
    """Match fact: scores, results from both sides (P02) and goals."""
    h = F.col("placar_oficial_mandante")
    a = F.col("placar_oficial_visitante")
    return stg_matches.select(
        "partida_id", "rodada_id", "clube_casa_id", "clube_visitante_id",
        h.alias("placar_mandante"), a.alias("placar_visitante"),
        X.match_result(h, a).alias("resultado_mandante"),
        X.match_result(a, h).alias("resultado_visitante"),
        X.total_goals(h, a).alias("total_gols"),
        F.col("partida_data").cast("timestamp_ntz").alias("partida_datetime"),
        "estadio", "valida",
    )


def fct_atletas_rodada(market: DataFrame, scored: DataFrame) -> DataFrame:
    """J01 + F01: market rows enriched with the official score when present."""
    m = market.alias("m")
    p = scored.select("atleta_id", "rodada_id", "pontuacao", "scout_json").alias("p")
    j = m.join(p, (F.col("m.atleta_id") == F.col("p.atleta_id"))
               & (F.col("m._rodada_captura") == F.col("p.rodada_id")), "left")
    combined = j.select(
        F.col("m.atleta_id").alias("atleta_id"),
        F.col("m._rodada_captura").alias("rodada_id"),
        F.col("m.clube_id").alias("clube_id"),
        F.col("m.posicao_id").alias("posicao_id"),
        F.col("m.status_id").alias("status_id"),
        F.coalesce(F.col("p.pontuacao"), F.col("m.pontos_num").cast("double")).alias("pontos_num"),
        F.col("m.media_num").alias("media_num"),
        F.col("m.preco_num").alias("preco_num"),
        F.col("m.variacao_num").alias("variacao_num"),
        F.col("m.jogos_num").alias("jogos_num"),
        F.col("m.entrou_em_campo").alias("entrou_em_campo"),
        F.coalesce(F.col("p.scout_json"), F.col("m.scout_json")).alias("scout_json"),
        F.col("m._ingestao_timestamp").alias("_ingestao_timestamp"),
    )
    return X.parse_scouts(combined, "scout_json")


# ---------------------------------------------------------------- dimensions
def dim_atletas(market: DataFrame, status_seed: DataFrame) -> DataFrame:
    """W01 + J02: newest market row per athlete, status label from the seed."""
    latest = latest_per_key(market, ["atleta_id"], ["_ingestao_timestamp", "_rodada_captura"])
    st = F.broadcast(status_seed.select("status_id", "descricao"))  # 5-row seed
    return latest.join(st, "status_id", "left").select(
        "atleta_id", "nome", "apelido", "posicao_id", "clube_id", "status_id",
        F.coalesce(F.col("descricao"), F.lit(X.UNKNOWN)).alias("status_descricao"),
        F.col("_ingestao_timestamp").alias("_updated_at"),
    )


def dim_clubes(clubs: DataFrame) -> DataFrame:
    """W01 + P06: newest row per club, first available badge URL."""
    src = clubs
    if "_ingestao_timestamp" in src.columns:
        src = latest_per_key(src, ["clube_id"], ["_ingestao_timestamp"])
    return src.select(
        "clube_id", "nome", "abreviacao", "slug",
        X.first_non_null(F.col("escudo_60x60"), F.col("escudo_45x45"),
                         F.col("escudo_30x30")).alias("escudo_url"),
    )


def dim_rodadas(rounds: DataFrame, status: DataFrame) -> DataFrame:
    """J03 (+W02): round calendar; season from the newest status capture of
    the round, else the year the round starts."""
    st = latest_per_key(status.select("rodada_atual", "temporada", "_ingestao_timestamp"),
                        ["rodada_atual"], ["_ingestao_timestamp"])
    r = rounds.select("rodada_id", "nome_rodada",
                      F.to_timestamp_ntz("inicio").alias("data_inicio"),
                      F.to_timestamp_ntz("fim").alias("data_fim"))
    j = r.join(st, r.rodada_id == st.rodada_atual, "left")
    return j.select("rodada_id", "nome_rodada", "data_inicio", "data_fim",
                    F.coalesce(F.col("temporada"), F.year("data_inicio")).alias("temporada"))


def fct_mercado_status(status: DataFrame) -> DataFrame:
    """Market-status fact: decoded status (P04) per capture, closing time and capture time."""
    extra = []
    if "fechamento_timestamp" in status.columns:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        extra.append(F.timestamp_add("SECOND", F.col("fechamento_timestamp"), epoch).alias("fechamento_datetime"))
    if "_ingestao_timestamp" in status.columns:
        extra.append(F.col("_ingestao_timestamp").alias("captura_timestamp"))
    return status.select("rodada_atual", "status_mercado",
                         X.decode_market_status(F.col("status_mercado")).alias("status_descricao"),
                         "temporada", "game_over", "times_escalados", "bola_rolando", "mercado_pos_rodada", *extra)


def fct_destaques_rodada(highlights: DataFrame) -> DataFrame:
    """Highlights fact: the round's best team and averages, one row per round."""
    return highlights.drop("_batch_id")
