"""Queries: silver facts/dims, standings, athlete and club metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchlake.functions import expressions as X
from pitchlake.operators import athlete as ATH
from pitchlake.operators import standings as STD
from pitchlake.operators.windows import latest_per_key
from pitchlake.plans.queries import query
from pitchlake.sources import bindings as B

# As-of literal for "previous run" scenarios on the events-derived tables.
PREVIOUS_LOAD_BEFORE = "2024-01-26"


# ----------------------------------------------------------------- P: columns
@query("p01_staging_views")
def _(p):
    """Market staging view (foto -> foto_url, column list)."""
    return p.stg_atletas_mercado.drop("scout_json")


@query("p02_match_result")
def _(p):
    return p.fct_partidas_proxima.select("partida_id", "resultado_mandante", "resultado_visitante")


@query("p03_trend_label")
def _(p):
    """P03 on AR: each round's score against the athlete's previous round."""
    w = Window.partitionBy("atleta_id").orderBy("rodada_id")
    f = p.stg_atletas_mercado
    return f.select("atleta_id", "rodada_id",
                    X.trend_label(F.col("pontos_num"), F.lag("pontos_num").over(w)).alias("tendencia"))


@query("p04_status_decode")
def _(p):
    ev = p.t.events
    code = (F.col("user_id") % 7).cast("int")
    return ev.select("event_id", code.alias("status_mercado"),
                     X.decode_market_status(code).alias("status_descricao"))


@query("p05_points_from_result")
def _(p):
    v = STD.club_perspectives(p.fct_partidas)
    return v.select("partida_id", "clube_id",
                    X.points_from_result(F.col("resultado")).alias("pontos"),
                    *X.result_indicators(F.col("resultado")))


@query("p06_first_non_null")
def _(p):
    pt = p.t.part
    return pt.select("p_partkey", X.first_non_null(
        F.nullif(F.col("p_type"), F.lit("ECONOMY")),
        F.nullif(F.col("p_brand"), F.lit("Brand#2")),
        F.col("p_name")).alias("primeiro"))


@query("p07_played_filter")
def _(p):
    return ATH.played(p.fct_atletas_rodada).select("atleta_id", "rodada_id", "pontos_num")


@query("p08_incremental_predicate")
def _(p):
    """Rows of the new load at/after max(target round) - 1 (look-back 1)."""
    from pitchlake.operators.merge import incremental
    src = p.fct_atletas_rodada
    target = src.filter(F.col("_ingestao_timestamp") < F.lit(PREVIOUS_LOAD_BEFORE).cast("timestamp_ntz"))
    return incremental(src, target, "rodada_id", lookback=1).select("atleta_id", "rodada_id", "pontos_num")


@query("p14_total_goals")
def _(p):
    return p.fct_partidas_proxima.select("partida_id", "total_gols")


# ----------------------------------------------------------------- U / A / W: standings
@query("u01_two_perspectives")
def _(p):
    return STD.club_perspectives(p.fct_partidas).select(
        "partida_id", "rodada_id", "clube_id", "adversario_id", "mando_campo",
        "gols_pro", "gols_contra", "resultado")


@query("a08_standings_round")
def _(p):
    return p.tabela_liga


@query("w03_standings_rank")
def _(p):
    return p.tabela_liga.select("clube_id", "rodada_id", "posicao")


@query("a09_standings_cumulative")
def _(p):
    return STD.standings_cumulative(p.fct_partidas)


@query("w08_streaks")
def _(p):
    return STD.streaks(p.fct_partidas)


@query("w10_last5_form")
def _(p):
    return STD.last5_form(p.fct_partidas)


@query("w12_home_away_goals")
def _(p):
    return STD.home_away_goals(p.fct_partidas)


@query("a32_goals_for_against_means")
def _(p):
    return STD.club_goal_means(p.fct_partidas)


@query("a30_home_away_analysis")
def _(p):
    return STD.side_analysis(p.fct_partidas)


# ----------------------------------------------------------------- J / F: facts and dims
@query("j01_enrich_with_scores")
def _(p):
    return p.fct_atletas_rodada


@query("f01_parse_scouts")
def _(p):
    m = p.stg_atletas_mercado.select("atleta_id", "rodada_id", "scout_json")
    return X.parse_scouts(m, "scout_json")


@query("j02_status_lookup")
def _(p):
    return p.dim_atletas


@query("w01_latest_per_key")
def _(p):
    """W01 on EV: newest event per user (tie-break on event id)."""
    return latest_per_key(p.t.events, ["user_id"], ["ts", "event_id"])


@query("w02_qualify_filter")
def _(p):
    """W02 on OR: newest order per customer (QUALIFY as window + filter)."""
    return latest_per_key(p.t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ----------------------------------------------------------------- A: athlete metrics
@query("a01_season_totals")
def _(p):
    return ATH.season_totals(ATH.played(p.fct_atletas_rodada))


@query("a02_last_n_mean")
def _(p):
    return ATH.recent_means(ATH.played(p.fct_atletas_rodada))


@query("a03_per_game_ratios")
def _(p):
    a = ATH.season_totals(ATH.played(p.fct_atletas_rodada))
    return a.select("atleta_id", "clube_id", "posicao_id", *ATH.per_game_ratios())


@query("a04_consistency")
def _(p):
    a = ATH.season_totals(ATH.played(p.fct_atletas_rodada))
    return a.select("atleta_id", "clube_id", "posicao_id",
                    ATH.consistency(F.col("media_pontos"), F.col("desvio_padrao_pontos"))
                    .alias("consistencia_score"))


@query("a05_price_per_point")
def _(p):
    return p.metricas_atleta.select("atleta_id", "clube_id", "preco_atual", "preco_por_ponto")


@query("a06_athlete_profile")
def _(p):
    return p.metricas_atleta


@query("a07_club_round_metrics")
def _(p):
    return ATH.club_round_scores(p.fct_atletas_rodada)


@query("j10_club_result_join")
def _(p):
    return p.metricas_clube_rodada


@query("w05_rolling_mean_3")
def _(p):
    return ATH.rolling_mean(p.fct_atletas_rodada, 3)


@query("w05_rolling_mean_literal")
def _(p):
    return ATH.rolling_mean(p.fct_atletas_rodada, 3, literal=True)


@query("w07_linear_trend_5")
def _(p):
    return ATH.trend_slope(p.fct_atletas_rodada, 5)


@query("w11_price_change_pct")
def _(p):
    return ATH.price_change(p.fct_atletas_rodada)


@query("w13_season_phase")
def _(p):
    f = p.fct_atletas_rodada
    return f.select("atleta_id", "rodada_id", ATH.season_phase(F.col("rodada_id")).alias("fase"))


@query("w15_tenure_games")
def _(p):
    return ATH.starts(p.fct_atletas_rodada)


@query("a33_scout_points")
def _(p):
    return ATH.scout_points(p.fct_atletas_rodada)


@query("w09_days_since_last")
def _(p):
    """W09 on OR: days between a customer's consecutive orders."""
    from pitchlake.operators.windows import rest_days
    o = p.t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return rest_days(o, "o_custkey", "o_orderdate", "o_orderkey")


@query("l00_feature_store")
def _(p):
    return p.feature_store


@query("j05_opponent_lookup")
def _(p):
    from pitchlake.plans.pipeline import next_opponents
    fact = p.fct_atletas_rodada
    target = fact.agg(F.max("rodada_id") + 1).scalar()
    adv = next_opponents(p.fct_partidas_proxima, target)
    return p.dim_atletas.select("atleta_id", "clube_id").join(adv, "clube_id", "left")


@query("j06_cross_scalar")
def _(p):
    fact = p.fct_atletas_rodada
    target = fact.agg(F.max("rodada_id") + 1).scalar()      # scalar subquery, run once
    return p.dim_atletas.select("atleta_id", target.alias("rodada_alvo"))


@query("j07_role_playing")
def _(p):
    return p.feature_store.select("atleta_id", "clube_id", "adversario_id",
                                  "clube_posicao_tabela", "adversario_posicao_tabela",
                                  "clube_media_fantasy", "adversario_media_fantasy")


@query("j08_derby_exists")
def _(p):
    from pitchlake.plans.pipeline import derby_flag
    m = p.fct_partidas.select("partida_id", "clube_casa_id", "clube_visitante_id")
    return derby_flag(m, "clube_casa_id", "clube_visitante_id", p.classicos)


@query("j09_target_join")
def _(p):
    return p.feature_store.select("atleta_id", "rodada_alvo", "pontuacao_real")


@query("u04_distinct_values")
def _(p):
    return p.fct_atletas_rodada.select("rodada_id").distinct()


@query("s12_seed_csv")
def _(p):
    """Positions seed joined to athletes per position (reads the data)."""
    from pitchlake.sources import seeds
    cnt = p.dim_atletas.groupBy("posicao_id").agg(F.count(F.lit(1)).alias("atletas"))
    return F.broadcast(seeds.positions(p.spark)).join(cnt, "posicao_id", "left")


@query("w06_recent_row_number")
def _(p):
    """Rounds of each athlete numbered newest first (played rounds)."""
    w = Window.partitionBy("atleta_id").orderBy(F.col("rodada_id").desc())
    return ATH.played(p.fct_atletas_rodada).select("atleta_id", "rodada_id",
                                                   F.row_number().over(w).alias("rn_desc"))


@query("j03_round_calendar")
def _(p):
    from pitchlake.plans.silver import dim_rodadas
    from pitchlake.sources import landing as L
    return dim_rodadas(L.explode_rounds(B.landed_rounds(p.t)), B.status_captures(p.t))


@query("f02_row_key")
def _(p):
    return p.t.orders.select("o_orderkey", X.row_key("o_orderkey", "o_custkey", "o_orderdate").alias("row_key"))


@query("f03_surrogate_key")
def _(p):
    return p.t.orders.select("o_orderkey",
                             X.surrogate_key("o_custkey", "o_orderstatus", "o_orderpriority").alias("sk"))
