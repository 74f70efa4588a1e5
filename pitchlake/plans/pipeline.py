"""The medallion DAG as lazy DataFrames.

``Pipeline(spark, sf_dir)`` exposes every table of the reference's DAG
(bronze bindings -> silver -> gold -> predictions) as a cached property.
Nothing runs until an action; each property is one logical plan, and a
consumer that needs several of them gets one query that Catalyst plans as
a whole (shared scans are reused via exchange reuse).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.operators import athlete as ATH
from pitchlake.operators import standings as STD
from pitchlake.operators.windows import latest_per_key
from pitchlake.plans import silver
from pitchlake.sources import bindings as B
from pitchlake.sources import seeds
from pitchlake.sources.tables import Tables


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, share: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir, share=share)

    def trained(self) -> "TrainedPipeline":
        """The same DAG on fitted models; shared tables are written."""
        return TrainedPipeline(self.spark, self.sf_dir, share=True)

    # ------------------------------------------------------------ bronze
    @cached_property
    def raw_atletas_mercado(self) -> DataFrame:
        return B.market_athletes(self.t)

    @cached_property
    def stg_atletas_mercado(self) -> DataFrame:
        return silver.staging_view(self.raw_atletas_mercado, "atletas_mercado")

    @cached_property
    def stg_atletas_pontuados(self) -> DataFrame:
        return B.scored_athletes(self.t)

    @cached_property
    def stg_partidas(self) -> DataFrame:
        return B.raw_matches(self.t)

    @cached_property
    def stg_partidas_proxima(self) -> DataFrame:
        return B.raw_matches_unplayed(self.t)

    @cached_property
    def clubes(self) -> DataFrame:
        return B.clubs(self.t)

    @cached_property
    def classicos(self) -> DataFrame:
        return B.derbies(self.t)

    # ------------------------------------------------------------ silver
    @cached_property
    def fct_partidas(self) -> DataFrame:
        return silver.fct_partidas(self.stg_partidas)

    @cached_property
    def fct_partidas_proxima(self) -> DataFrame:
        return silver.fct_partidas(self.stg_partidas_proxima)

    @cached_property
    def fct_atletas_rodada(self) -> DataFrame:
        # several gold branches read the fact; parse the scout JSON once
        return self.t.shared("fct_atletas_rodada", lambda: silver.fct_atletas_rodada(
            self.stg_atletas_mercado, self.stg_atletas_pontuados))

    @cached_property
    def dim_atletas(self) -> DataFrame:
        return silver.dim_atletas(self.stg_atletas_mercado, seeds.athlete_status(self.spark))

    @cached_property
    def dim_clubes(self) -> DataFrame:
        return silver.dim_clubes(self.clubes)

    @cached_property
    def dim_posicoes(self) -> DataFrame:
        return seeds.positions(self.spark)

    # ------------------------------------------------------------ gold
    @cached_property
    def tabela_liga(self) -> DataFrame:
        return STD.standings_round(self.fct_partidas)

    @cached_property
    def metricas_atleta(self) -> DataFrame:
        return ATH.athlete_metrics(self.fct_atletas_rodada, self.dim_atletas)

    @cached_property
    def metricas_clube_rodada(self) -> DataFrame:
        return club_round_metrics(self.fct_atletas_rodada, self.fct_partidas,
                                  self.tabela_liga)

    @cached_property
    def feature_store(self) -> DataFrame:
        return feature_store(self)

    # ------------------------------------------------------------ predictions
    @cached_property
    def mp_wide(self) -> DataFrame:
        return B.model_predictions_wide(self.t)

    @cached_property
    def mp_long(self) -> DataFrame:
        return B.model_predictions(self.t)

    @cached_property
    def realised(self) -> DataFrame:
        """Realised scores (feature rows with a target)."""
        return self.mp_wide.filter(F.col("pontuacao_real").isNotNull()).select(
            "atleta_id", "rodada_alvo", "posicao_id", "pontuacao_real")

    def model_table(self, name: str) -> DataFrame:
        return self.mp_long.filter(F.col("modelo") == name).select(
            "atleta_id", "rodada_alvo", "pontuacao_prevista")

    @cached_property
    def history(self) -> DataFrame:
        """Every model's predictions joined (once) to the realised scores."""
        from pitchlake.operators import ensemble as EN
        return EN.with_actuals_long(self.mp_long, self.realised)

    @cached_property
    def next_rows(self) -> DataFrame:
        """Rows to predict: the round whose score is not known yet."""
        return self.mp_wide.filter(F.col("pontuacao_real").isNull()).select(
            "atleta_id", "rodada_alvo", "posicao_id")

    @cached_property
    def selection(self) -> DataFrame:
        from pitchlake.operators import ensemble as EN
        return EN.select_model(EN.coverage_by_position(self.history), self.dim_posicoes)

    @cached_property
    def previsao_final(self) -> DataFrame:
        from pitchlake.operators import ensemble as EN
        preds = self.mp_long.join(self.next_rows.select("atleta_id", "rodada_alvo"),
                                  ["atleta_id", "rodada_alvo"], "left_semi")
        return EN.ensemble_predict(self.next_rows, preds, EN.model_coverage(self.history),
                                   self.selection)

    @cached_property
    def training_features(self) -> DataFrame:
        return training_features(self)

    @cached_property
    def previsao_final_ranked(self) -> DataFrame:
        from pitchlake.operators import ensemble as EN
        return EN.final_ranked(self.previsao_final, self.metricas_atleta, self.dim_posicoes,
                               self.dim_clubes)


class TrainedPipeline(Pipeline):
    """The DAG whose history, selection, ensemble and picks come from fitted models.

    Predictions are out of fold and in the unit of the realised scores.  The
    design matrix and the predictions are written once; fits read them.
    """

    n_splits = 2
    #: Settings of the two boosters that L09 found (None: the library's plain ones).
    searched: tuple[dict, dict] | None = None

    @cached_property
    def predictions(self) -> DataFrame:
        from pitchlake.operators import models as MD
        matrix = self.t.shared("design_matrix", lambda: MD.design_matrix(self.training_features))
        out = self.t.shared("trained_predictions", lambda: MD.out_of_fold(matrix, self.n_splits, searched=self.searched))
        return out.withColumn("pontuacao_prevista", F.col("pontuacao_prevista") / B.PREDICTION_SCALE)

    @cached_property
    def mp_long(self) -> DataFrame:
        real = self.training_features.select("atleta_id", "rodada_alvo", "posicao_id",
                                             (F.col("pontuacao_real") / B.PREDICTION_SCALE).alias("pontuacao_real"))
        return real.join(self.predictions, ["atleta_id", "rodada_alvo"]).select(
            "atleta_id", "rodada_alvo", "posicao_id", "pontuacao_real", "modelo", "pontuacao_prevista")

    @cached_property
    def mp_wide(self) -> DataFrame:
        keys = ["atleta_id", "rodada_alvo", "posicao_id", "pontuacao_real"]
        wide = self.mp_long.groupBy(*keys).pivot("modelo", list(B.MODEL_NAMES)).agg(F.first("pontuacao_prevista"))
        return wide.select(*keys, *[F.col(m).alias(f"p_{m}") for m in B.MODEL_NAMES])


def club_round_metrics(fact: DataFrame, matches: DataFrame, table: DataFrame) -> DataFrame:
    """Club fantasy metrics (A07) + round result + table row, by (club, round).

    All three inputs are aggregated to one row per (club, round) before the
    joins, so the joins never fan out.
    """
    c = ATH.club_round_scores(fact)
    r = STD.club_results(matches)
    t = table.select("clube_id", "rodada_id", F.col("posicao").alias("posicao_tabela"),
                     F.col("pontos").alias("pontos_campeonato"), "aproveitamento_percentual")
    j = c.join(r, ["clube_id", "rodada_id"], "left").join(t, ["clube_id", "rodada_id"], "left")
    gm = F.coalesce(F.col("gols_marcados"), F.lit(0))
    gs = F.coalesce(F.col("gols_sofridos"), F.lit(0))
    return j.select("clube_id", "rodada_id", "total_pontos_fantasy", "media_pontos_fantasy",
                    gm.alias("total_gols_marcados"), gs.alias("total_gols_sofridos"),
                    (gm - gs).alias("saldo_gols"), "resultado", "posicao_tabela",
                    "pontos_campeonato", "aproveitamento_percentual")


def next_opponents(matches_next: DataFrame, target_round) -> DataFrame:
    """Each club's opponent and side in the target round.

    The reference's ``club IN (home, away)`` theta join is re-shaped: each
    match is exploded into its two (club, side, opponent) rows and then
    joined by equality.  The target round's matches are used when present,
    else the newest round's (K11).  A club with several matches in that
    round keeps the one with the lowest match id.
    """
    m = matches_next.select("partida_id", "rodada_id", "clube_casa_id", "clube_visitante_id")
    newest = m.agg(F.max("rodada_id")).scalar()
    pick = F.when(newest >= target_round, target_round).otherwise(newest)
    m = m.filter(F.col("rodada_id") == pick)
    sides = m.select("partida_id", F.explode(F.array(
        F.struct(F.col("clube_casa_id").alias("clube_id"), F.lit("casa").alias("mando_campo"),
                 F.col("clube_visitante_id").alias("adversario_id")),
        F.struct(F.col("clube_visitante_id").alias("clube_id"), F.lit("fora").alias("mando_campo"),
                 F.col("clube_casa_id").alias("adversario_id")))).alias("s")).select("partida_id", "s.*")
    return latest_per_key(sides, ["clube_id"], ["partida_id"], newest=False).drop("partida_id")


def derby_flag(pairs_df: DataFrame, club: str, opp: str, derbies: DataFrame) -> DataFrame:
    """EXISTS over a symmetric pair, as an equi-join on (least, greatest)."""
    d = derbies.select(F.least("clube_id_a", "clube_id_b").alias("_lo"),
                       F.greatest("clube_id_a", "clube_id_b").alias("_hi")).distinct() \
        .withColumn("_is_derby", F.lit(True))
    j = pairs_df.join(d, (F.least(F.col(club), F.col(opp)) == d._lo)
                      & (F.greatest(F.col(club), F.col(opp)) == d._hi), "left")
    return j.withColumn("eh_classico", F.coalesce(F.col("_is_derby"), F.lit(False))) \
        .drop("_lo", "_hi", "_is_derby")


def feature_store(p: Pipeline) -> DataFrame:
    """One row per athlete for the target round (max fact round + 1)."""
    fact = p.fct_atletas_rodada
    m = p.metricas_atleta
    target = fact.agg(F.max("rodada_id") + 1).scalar()       # J06: scalar subquery
    # W05 (ascending frame): mean of the athlete's last 3 rows at its latest round
    w = Window.partitionBy("atleta_id").orderBy(F.col("rodada_id").desc())
    last3 = (fact.select("atleta_id", "pontos_num", F.row_number().over(w).alias("_rn"))
             .filter(F.col("_rn") <= 3).groupBy("atleta_id")
             .agg((F.round(F.sum("pontos_num"), 2) / F.count("pontos_num")).alias("_m3")))
    slope = ATH.trend_slope(fact).select("atleta_id", "tendencia_slope")
    adv = next_opponents(p.fct_partidas_proxima, target)
    # Latest table row per club, latest club metrics round
    tab = latest_per_key(p.tabela_liga, ["clube_id"], ["rodada_id"]) \
        .select("clube_id", "posicao", "aproveitamento_percentual")
    mc_all = p.metricas_clube_rodada
    mc = mc_all.filter(F.col("rodada_id") == mc_all.agg(F.max("rodada_id")).scalar()) \
        .select("clube_id", "media_pontos_fantasy")
    base = (m.withColumn("rodada_alvo", target)
            .join(last3, "atleta_id", "left")
            .join(slope, "atleta_id", "left")
            .join(adv, "clube_id", "left"))
    tc = tab.select(F.col("clube_id").alias("_c1"), F.col("posicao").alias("clube_posicao_tabela"),
                    F.col("aproveitamento_percentual").alias("clube_aproveitamento"))
    ta = tab.select(F.col("clube_id").alias("_c2"), F.col("posicao").alias("adversario_posicao_tabela"))
    mcc = mc.select(F.col("clube_id").alias("_c3"), F.col("media_pontos_fantasy").alias("clube_media_fantasy"))
    mca = mc.select(F.col("clube_id").alias("_c4"), F.col("media_pontos_fantasy").alias("adversario_media_fantasy"))
    sc = p.stg_atletas_pontuados.select(F.col("atleta_id").alias("_a"),
                                        F.col("rodada_id").alias("_ra"),
                                        F.col("pontuacao").alias("pontuacao_real"))
    j = (base.join(tc, base.clube_id == tc._c1, "left")
         .join(ta, base.adversario_id == ta._c2, "left")
         .join(mcc, base.clube_id == mcc._c3, "left")
         .join(mca, base.adversario_id == mca._c4, "left")
         .join(sc, (base.atleta_id == sc._a) & (base.rodada_alvo == sc._ra), "left"))
    j = derby_flag(j, "clube_id", "adversario_id", p.classicos)
    return j.select(
        "atleta_id", "rodada_alvo",
        F.col("media_pontos").alias("media_pontos_geral"),
        "media_ultimas_5",
        F.coalesce(F.col("_m3"), F.col("media_pontos")).alias("media_ultimas_3"),
        "desvio_padrao_pontos", "consistencia_score", "total_jogos", "aproveitamento_campo",
        "preco_atual", F.col("variacao_preco_acumulada").alias("variacao_preco"),
        "posicao_id", "clube_id",
        "clube_posicao_tabela", "clube_aproveitamento", "clube_media_fantasy",
        "adversario_id", "adversario_posicao_tabela", "adversario_media_fantasy",
        "mando_campo", "eh_classico",
        F.col("rodada_alvo").alias("rodada_id_relativa"),
        ATH.season_phase(F.col("rodada_alvo")).alias("fase_temporada"),
        "tendencia_slope",
        "pontuacao_real",
    )


def training_features(p: Pipeline) -> DataFrame:
    """Feature rows for model training: one per (athlete, round), built only
    from what was known before that round; target = the round's score
    (NULL for the newest round, which is the one to predict).

    Means are round(sum, 2) / count so they do not depend on summation order.
    """
    f = p.fct_atletas_rodada
    w = Window.partitionBy("atleta_id").orderBy("rodada_id")
    prev = w.rowsBetween(Window.unboundedPreceding, -1)
    pp = F.when(F.col("entrou_em_campo"), F.col("pontos_num"))

    def mean(c, frame):
        return F.round(F.sum(c).over(frame), 2) / F.count(c).over(frame)
    x = f.select(
        "atleta_id", "rodada_id", "clube_id", "posicao_id", "pontos_num",
        mean(pp, prev).alias("media_pontos_geral"),
        mean(F.col("pontos_num"), w.rowsBetween(-5, -1)).alias("media_ultimas_5"),
        mean(F.col("pontos_num"), w.rowsBetween(-3, -1)).alias("media_ultimas_3"),
        F.stddev_samp(pp).over(prev).alias("desvio_padrao_pontos"),
        F.count(pp).over(prev).alias("total_jogos"),
        F.avg(F.col("entrou_em_campo").cast("int")).over(prev).alias("aproveitamento_campo"),
        F.lag("preco_num").over(w).alias("preco_atual"),
        F.lag("variacao_num").over(w).alias("variacao_preco"))
    x = x.withColumn("consistencia_score", ATH.consistency(F.col("media_pontos_geral"),
                                                          F.col("desvio_padrao_pontos")))
    # the club's first match of each round: side and opponent
    m = p.fct_partidas.select("partida_id", "rodada_id", "clube_casa_id", "clube_visitante_id")
    sides = m.select("partida_id", "rodada_id", F.explode(F.array(
        F.struct(F.col("clube_casa_id").alias("clube_id"), F.lit("casa").alias("mando_campo"),
                 F.col("clube_visitante_id").alias("adversario_id")),
        F.struct(F.col("clube_visitante_id").alias("clube_id"), F.lit("fora").alias("mando_campo"),
                 F.col("clube_casa_id").alias("adversario_id")))).alias("s")).select(
        "partida_id", "rodada_id", "s.*")
    opp = latest_per_key(sides, ["clube_id", "rodada_id"], ["partida_id"], newest=False).drop("partida_id")
    tab = p.tabela_liga.select("clube_id", "rodada_id", "posicao", "aproveitamento_percentual")
    t1 = tab.select(F.col("clube_id").alias("_c1"), (F.col("rodada_id") + 1).alias("_r1"),
                    F.col("posicao").alias("clube_posicao_tabela"),
                    F.col("aproveitamento_percentual").alias("clube_aproveitamento"))
    t2 = tab.select(F.col("clube_id").alias("_c2"), (F.col("rodada_id") + 1).alias("_r2"),
                    F.col("posicao").alias("adversario_posicao_tabela"))
    last = f.agg(F.max("rodada_id")).scalar()
    j = (x.join(opp, ["clube_id", "rodada_id"], "left")
         .join(t1, (F.col("clube_id") == F.col("_c1")) & (F.col("rodada_id") == F.col("_r1")), "left")
         .join(t2, (F.col("adversario_id") == F.col("_c2")) & (F.col("rodada_id") == F.col("_r2")), "left"))
    j = derby_flag(j, "clube_id", "adversario_id", p.classicos)
    return j.select(
        "atleta_id", F.col("rodada_id").alias("rodada_alvo"), "clube_id", "posicao_id",
        "media_pontos_geral", "media_ultimas_5", "media_ultimas_3", "desvio_padrao_pontos",
        "consistencia_score", "total_jogos", "aproveitamento_campo", "preco_atual", "variacao_preco",
        "clube_posicao_tabela", "clube_aproveitamento", "adversario_id", "adversario_posicao_tabela",
        "mando_campo", "eh_classico",
        F.when(F.col("rodada_id") == last, F.lit(None)).otherwise(F.col("pontos_num"))
        .alias("pontuacao_real"))
