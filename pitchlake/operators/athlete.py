"""Athlete-level metrics over the athlete x round fact.

Windows are keyed by athlete, whose rows are bounded by the rounds of a
season; last-N means are folded into one aggregate (``avg(when rn <= k)``)
so last-5 and last-3 share a single window and a single shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions import expressions as X

SEASON = 2024          # value of the season column in the gold table


def _exact_sum(c):
    """Sum of 2-decimal scores, rounded back to 2 decimals: exact, so it does
    not depend on the order a distributed sum adds its terms."""
    return F.round(F.sum(c), 2)


def _exact_mean(c):
    return _exact_sum(c) / F.count(c)
SEASON_ROUNDS = 38


def played(fact: DataFrame) -> DataFrame:
    """Rows where the athlete took the field."""
    return fact.filter(F.col("entrou_em_campo"))


def recent_means(fact_played: DataFrame) -> DataFrame:
    """A02 (+W06): mean of the last 5 and last 3 played rounds, and the
    highest price among the last 5 (the reference's "current price")."""
    w = Window.partitionBy("atleta_id").orderBy(F.col("rodada_id").desc())
    x = fact_played.select("atleta_id", "pontos_num", "preco_num",
                           F.row_number().over(w).alias("rn_desc"))
    return x.groupBy("atleta_id").agg(
        _exact_mean(F.when(F.col("rn_desc") <= 5, F.col("pontos_num"))).alias("media_ultimas_5"),
        F.max(F.when(F.col("rn_desc") <= 5, F.col("preco_num"))).alias("preco_atual"),
        _exact_mean(F.when(F.col("rn_desc") <= 3, F.col("pontos_num"))).alias("media_ultimas_3"),
    )


def season_totals(fact_played: DataFrame) -> DataFrame:
    """Per (athlete, club, position) totals over played rounds."""
    p = F.col("pontos_num")
    return fact_played.groupBy("atleta_id", "clube_id", "posicao_id").agg(
        F.count(F.lit(1)).alias("total_jogos"),
        _exact_sum(p).alias("total_pontos"),
        _exact_mean(p).alias("media_pontos"),
        F.stddev_samp(p).alias("desvio_padrao_pontos"),
        F.max(p).alias("max_pontos"),
        F.min(p).alias("min_pontos"),
        F.percentile(p, 0.5).alias("mediana_pontos"),
        F.sum("scout_gol").alias("total_gols"),
        F.sum("scout_assistencia").alias("total_assistencias"),
        F.sum("scout_desarme").alias("total_desarmes"),
        F.sum("scout_cartao_amarelo").alias("total_cartoes_amarelos"),
        F.sum("scout_cartao_vermelho").alias("total_cartoes_vermelhos"),
        F.sum("scout_saldo_gol").alias("total_saldo_gol"),
        F.sum("scout_defesa").alias("total_defesas"),
        F.sum("scout_finalizacao_trave").alias("total_finalizacoes_trave"),
        F.avg(F.col("entrou_em_campo").cast("int")).alias("aproveitamento_campo"),
        _exact_sum("variacao_num").alias("variacao_preco_acumulada"),
    )


def per_game_ratios() -> list:
    """Per-game ratios, 0 when there are no games."""
    g = F.col("total_jogos")
    return [
        X.safe_ratio(F.col("total_gols"), g).alias("gols_por_jogo"),
        X.safe_ratio(F.col("total_assistencias"), g).alias("assistencias_por_jogo"),
        X.safe_ratio(F.col("total_gols") + F.col("total_assistencias"), g)
         .alias("participacao_gols_por_jogo"),
        X.safe_ratio(F.col("total_cartoes_amarelos") + F.col("total_cartoes_vermelhos"), g)
         .alias("cartoes_por_jogo"),
    ]


def consistency(mean, sd):
    """1 - sd/mean for a positive mean, else 0 (sd NULL counts as 0)."""
    return F.when(mean > 0, 1 - F.coalesce(sd, F.lit(0.0)) / mean).otherwise(0.0)


def price_per_point(price, mean):
    """Price / mean points for a positive mean, else NULL."""
    return F.when(mean > 0, F.coalesce(price, F.lit(0.0)) / mean)


def athlete_metrics(fact: DataFrame, dim: DataFrame, season: int = SEASON) -> DataFrame:
    """The athlete gold table (A01-A05 + trend P03 + dimension join)."""
    fp = played(fact)
    a = season_totals(fp).alias("a")
    m = recent_means(fp).alias("m")
    d = dim.select("atleta_id", "apelido").alias("d")
    j = a.join(d, "atleta_id").join(m, "atleta_id", "left")
    mean = F.col("media_pontos")
    m5 = F.coalesce(F.col("media_ultimas_5"), mean)
    m3 = F.coalesce(F.col("media_ultimas_3"), mean)
    return j.select(
        "atleta_id", "apelido", "clube_id", "posicao_id",
        F.lit(season).alias("temporada"),
        "total_jogos", "total_pontos", "media_pontos", "desvio_padrao_pontos",
        "max_pontos", "min_pontos", "mediana_pontos",
        "total_gols", "total_assistencias", "total_desarmes",
        "total_cartoes_amarelos", "total_cartoes_vermelhos", "total_saldo_gol",
        "total_defesas", "total_finalizacoes_trave",
        *per_game_ratios(),
        "aproveitamento_campo",
        F.coalesce(F.col("preco_atual"), F.lit(0.0)).alias("preco_atual"),
        "variacao_preco_acumulada",
        price_per_point(F.col("preco_atual"), mean).alias("preco_por_ponto"),
        m5.alias("media_ultimas_5"),
        X.trend_label(m5, m3).alias("tendencia_pontos"),
        consistency(mean, F.col("desvio_padrao_pontos")).alias("consistencia_score"),
    )


def club_round_scores(fact: DataFrame) -> DataFrame:
    """Per (club, round) fantasy totals of the athletes who played."""
    return played(fact).groupBy("clube_id", "rodada_id").agg(
        _exact_sum("pontos_num").alias("total_pontos_fantasy"),
        _exact_mean("pontos_num").alias("media_pontos_fantasy"),
        F.countDistinct("atleta_id").alias("atletas_pontuaram"),
    )


def rolling_mean(fact: DataFrame, n: int = 3, literal: bool = False) -> DataFrame:
    """Mean score over the athlete's last ``n`` rows up to each round,
    falling back to the athlete's season mean.

    ``literal=True`` reproduces the reference's descending frame, which
    averages a round with the *later* rounds.
    """
    order = F.col("rodada_id").desc() if literal else F.col("rodada_id")
    w = Window.partitionBy("atleta_id").orderBy(order).rowsBetween(-(n - 1), 0)
    wa = Window.partitionBy("atleta_id")
    return fact.select("atleta_id", "rodada_id",
                       F.coalesce(F.round(F.sum("pontos_num").over(w), 2) / F.count("pontos_num").over(w),
                                  F.round(F.sum("pontos_num").over(wa), 2) / F.count("pontos_num").over(wa))
                       .alias(f"media_ultimas_{n}"))


def trend_slope(fact: DataFrame, n: int = 5) -> DataFrame:
    """Least-squares slope of score on round over the last ``n`` played rounds."""
    w = Window.partitionBy("atleta_id").orderBy(F.col("rodada_id").desc())
    x = played(fact).select("atleta_id", "rodada_id", "pontos_num",
                            F.row_number().over(w).alias("rn"))
    return x.filter(F.col("rn") <= n).groupBy("atleta_id").agg(
        F.regr_slope(F.col("pontos_num"), F.col("rodada_id").cast("double")).alias("tendencia_slope"),
        F.count(F.lit(1)).alias("n_rodadas"))


def price_change(fact: DataFrame) -> DataFrame:
    """(latest - first) / first price per athlete (NULL when first is 0)."""
    g = fact.groupBy("atleta_id").agg(
        F.min_by("preco_num", "rodada_id").alias("preco_inicial"),
        F.max_by("preco_num", "rodada_id").alias("preco_final"))
    return g.select("atleta_id", "preco_inicial", "preco_final",
                    F.when(F.col("preco_inicial") != 0,
                           (F.col("preco_final") - F.col("preco_inicial")) / F.col("preco_inicial"))
                    .alias("valorizacao_pct"))


def season_phase(round_col, rounds: int = SEASON_ROUNDS):
    """Season phase from the round: first third 'inicio', middle 'meio', last 'fim'."""
    frac = round_col / F.lit(float(rounds))
    return (F.when(frac <= 1.0 / 3, "inicio").when(frac <= 2.0 / 3, "meio").otherwise("fim"))


def starts(fact: DataFrame) -> DataFrame:
    """Running count of games started per athlete after each round."""
    w = Window.partitionBy("atleta_id").orderBy("rodada_id").rowsBetween(Window.unboundedPreceding, 0)
    return fact.select("atleta_id", "rodada_id",
                       F.sum(F.col("entrou_em_campo").cast("int")).over(w).alias("jogos_como_titular"))


def scout_points(fact: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Fantasy points = sum of scout count x official weight.

    The weight seed has 20 fixed rows, so it is folded into one linear
    column expression: no join, no shuffle, stays in whole-stage codegen.
    """
    from pitchlake.functions.expressions import SCOUT_COLUMNS
    from pitchlake.sources.seeds import SCOUT_WEIGHTS
    wmap = weights or {code: pts for code, _desc, pts in SCOUT_WEIGHTS}
    expr = None
    for code, name in SCOUT_COLUMNS:
        term = F.col(name) * F.lit(float(wmap.get(code, 0.0)))
        expr = term if expr is None else expr + term
    return fact.select("atleta_id", "rodada_id", expr.alias("pontos_scout"))
