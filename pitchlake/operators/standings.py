"""League-table operators over the match fact.

Matches are turned into one row per (club, match) with a single scan
(``explode`` of a two-element array instead of a UNION ALL that reads the
fact twice), pre-aggregated to one row per (club, round), and only then
windowed -- so every window runs over at most clubs x rounds rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions import expressions as X


def club_perspectives(matches: DataFrame, played_only: bool = True) -> DataFrame:
    """Home view and away view of every match, in one pass."""
    m = matches
    if played_only:   # P07: keep matches with both scores (pushed to the scan)
        m = m.filter(F.col("placar_mandante").isNotNull() & F.col("placar_visitante").isNotNull())
    home = F.struct(F.col("clube_casa_id").alias("clube_id"),
                    F.col("clube_visitante_id").alias("adversario_id"),
                    F.col("placar_mandante").alias("gols_pro"),
                    F.col("placar_visitante").alias("gols_contra"),
                    F.col("resultado_mandante").alias("resultado"),
                    F.lit("casa").alias("mando_campo"))
    away = F.struct(F.col("clube_visitante_id").alias("clube_id"),
                    F.col("clube_casa_id").alias("adversario_id"),
                    F.col("placar_visitante").alias("gols_pro"),
                    F.col("placar_mandante").alias("gols_contra"),
                    F.col("resultado_visitante").alias("resultado"),
                    F.lit("fora").alias("mando_campo"))
    return m.select("partida_id", "rodada_id", "partida_datetime",
                    F.explode(F.array(home, away)).alias("v")).select(
        "partida_id", "rodada_id", "partida_datetime", "v.*")


def _round_totals(persp: DataFrame) -> DataFrame:
    """P05 + aggregation: one row per (club, round)."""
    r = F.col("resultado")
    return persp.groupBy("clube_id", "rodada_id").agg(
        F.sum(X.points_from_result(r)).alias("pontos"),
        F.count(F.lit(1)).alias("jogos"),
        F.sum(F.when(r == X.WIN, 1).otherwise(0)).alias("vitorias"),
        F.sum(F.when(r == X.DRAW, 1).otherwise(0)).alias("empates"),
        F.sum(F.when(r == X.LOSS, 1).otherwise(0)).alias("derrotas"),
        F.sum("gols_pro").alias("gols_pro"),
        F.sum("gols_contra").alias("gols_contra"),
    )


def _finish(df: DataFrame) -> DataFrame:
    """W03 rank per round + goal difference + win percentage."""
    df = df.withColumn("saldo_gols", F.col("gols_pro") - F.col("gols_contra"))
    w = Window.partitionBy("rodada_id").orderBy(
        F.col("pontos").desc(), F.col("saldo_gols").desc(), F.col("gols_pro").desc())
    pct = F.round(F.col("pontos").cast("double") / (F.col("jogos") * 3) * 100, 1)
    return df.select(
        "clube_id", "rodada_id", F.rank().over(w).alias("posicao"),
        "pontos", "jogos", "vitorias", "empates", "derrotas",
        "gols_pro", "gols_contra", "saldo_gols",
        F.when(F.col("jogos") > 0, pct).alias("aproveitamento_percentual"),
    )


def standings_round(matches: DataFrame) -> DataFrame:
    """A08 (as coded): totals of each round on its own, ranked per round."""
    return _finish(_round_totals(club_perspectives(matches)))


def club_round_grid(persp: DataFrame) -> DataFrame:
    """Every club x every round between the first and the last played round.

    Built per club with ``sequence`` (no cross join); the bounds are scalar
    subqueries evaluated once.
    """
    lo = persp.agg(F.min("rodada_id")).scalar()
    hi = persp.agg(F.max("rodada_id")).scalar()
    clubs_ = persp.select("clube_id").distinct()
    return clubs_.select("clube_id", F.explode(F.sequence(lo, hi)).alias("rodada_id"))


def standings_cumulative(matches: DataFrame) -> DataFrame:
    """The league table after each round (running sums, idle clubs kept)."""
    persp = club_perspectives(matches)
    per_round = _round_totals(persp)
    grid = club_round_grid(persp)
    g = grid.join(per_round, ["clube_id", "rodada_id"], "left")
    w = (Window.partitionBy("clube_id").orderBy("rodada_id")
         .rowsBetween(Window.unboundedPreceding, 0))
    cols = ["pontos", "jogos", "vitorias", "empates", "derrotas", "gols_pro", "gols_contra"]
    run = g.select("clube_id", "rodada_id",
                   *[F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long").alias(c) for c in cols])
    return _finish(run)


def streaks(matches: DataFrame) -> DataFrame:
    """Current unbeaten and winless run (in rounds) per club after each round.

    A round counts as unbeaten when the club lost no match in it, winless
    when it won none.  Runs are islands: the run length is the number of
    rounds since the last round that broke the run.
    """
    per = _round_totals(club_perspectives(matches))
    w = Window.partitionBy("clube_id").orderBy("rodada_id")
    run_w = w.rowsBetween(Window.unboundedPreceding, 0)
    x = per.select("clube_id", "rodada_id",
                   (F.col("derrotas") == 0).alias("_unb"),
                   (F.col("vitorias") == 0).alias("_winless"),
                   F.row_number().over(w).alias("_i"))
    # index of the last breaking round so far (0 if none)
    x = x.select("*",
                 F.max(F.when(~F.col("_unb"), F.col("_i")).otherwise(0)).over(run_w).alias("_lb_u"),
                 F.max(F.when(~F.col("_winless"), F.col("_i")).otherwise(0)).over(run_w).alias("_lb_w"))
    return x.select("clube_id", "rodada_id",
                    (F.col("_i") - F.col("_lb_u")).cast("int").alias("invicto_seq"),
                    (F.col("_i") - F.col("_lb_w")).cast("int").alias("sem_vitoria_seq"))


def last5_form(matches: DataFrame, n: int = 5) -> DataFrame:
    """The club's last ``n`` match results before each round, oldest first.

    One letter per match, lower case ('v','e','d'); matches of a round are
    ordered by match id.  Bounded at every step: each (club, round) keeps
    only its last ``n`` results (at most ``n`` items per group), and the
    window then runs over one row per (club, round) -- the rounds of the
    club's fixture -- concatenating the previous ``n`` rounds' lists and
    keeping their last ``n`` letters.
    """
    persp = club_perspectives(matches)
    w_in = Window.partitionBy("clube_id", "rodada_id").orderBy(F.col("partida_id").desc())
    tail = (persp.select("clube_id", "rodada_id", "partida_id", F.lower("resultado").alias("r"),
                         F.row_number().over(w_in).alias("_k"))
            .filter(F.col("_k") <= n)
            .groupBy("clube_id", "rodada_id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("partida_id", "r"))),
                             lambda x: x["r"]).alias("_last")))
    w = Window.partitionBy("clube_id").orderBy("rodada_id").rowsBetween(-n, -1)
    prev = F.flatten(F.collect_list("_last").over(w))
    return tail.select("clube_id", "rodada_id",
                       F.concat_ws("", F.when(F.size(prev) > n, F.slice(prev, -n, n)).otherwise(prev))
                       .alias("forma_ultimos5"))


def home_away_goals(matches: DataFrame) -> DataFrame:
    """Running goals scored at home and away per club after each round."""
    persp = club_perspectives(matches)
    per = persp.groupBy("clube_id", "rodada_id").agg(
        F.sum(F.when(F.col("mando_campo") == "casa", F.col("gols_pro")).otherwise(0)).alias("gc"),
        F.sum(F.when(F.col("mando_campo") == "fora", F.col("gols_pro")).otherwise(0)).alias("gf"),
        F.sum(F.when(F.col("mando_campo") == "casa", F.col("gols_contra")).otherwise(0)).alias("sc"),
        F.sum(F.when(F.col("mando_campo") == "fora", F.col("gols_contra")).otherwise(0)).alias("sf"))
    w = Window.partitionBy("clube_id").orderBy("rodada_id").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("clube_id", "rodada_id",
                      F.sum("gc").over(w).alias("gols_casa_acum"),
                      F.sum("gf").over(w).alias("gols_fora_acum"),
                      F.sum("sc").over(w).alias("sofridos_casa_acum"),
                      F.sum("sf").over(w).alias("sofridos_fora_acum"))


def club_goal_means(matches: DataFrame) -> DataFrame:
    """Per club and round, mean goals scored / conceded per match in all
    earlier rounds (expanding window over per-round sums)."""
    persp = club_perspectives(matches)
    per = persp.groupBy("clube_id", "rodada_id").agg(
        F.sum("gols_pro").alias("gp"), F.sum("gols_contra").alias("gc"),
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("clube_id").orderBy("rodada_id").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("clube_id", "rodada_id",
                      (F.sum("gp").over(w) / F.sum("n").over(w)).alias("media_gols_marcados"),
                      (F.sum("gc").over(w) / F.sum("n").over(w)).alias("media_gols_sofridos"))


def side_analysis(matches: DataFrame) -> DataFrame:
    """Mean goals and win rate by side (home / away)."""
    persp = club_perspectives(matches)
    return persp.groupBy("mando_campo").agg(
        F.count(F.lit(1)).alias("jogos"),
        F.avg("gols_pro").alias("media_gols"),
        F.avg(F.when(F.col("resultado") == X.WIN, 1.0).otherwise(0.0)).alias("taxa_vitoria"),
        F.avg(X.points_from_result(F.col("resultado")).cast("double")).alias("media_pontos"))


def club_results(matches: DataFrame) -> DataFrame:
    """Result of each club in each round: goals summed over the round's
    matches, result letter from those sums (one row per club and round)."""
    home = matches.filter(F.col("placar_mandante").isNotNull()).select(
        F.col("clube_casa_id").alias("clube_id"), "rodada_id",
        F.col("placar_mandante").alias("gm"), F.col("placar_visitante").alias("gs"))
    away = matches.filter(F.col("placar_visitante").isNotNull()).select(
        F.col("clube_visitante_id").alias("clube_id"), "rodada_id",
        F.col("placar_visitante").alias("gm"), F.col("placar_mandante").alias("gs"))
    r = home.unionByName(away).groupBy("clube_id", "rodada_id").agg(
        F.sum("gm").alias("gols_marcados"), F.sum("gs").alias("gols_sofridos"))
    return r.withColumn("resultado", X.match_result(F.col("gols_marcados"), F.col("gols_sofridos")))
