"""Queries: prediction history, coverage, model selection and the ensemble."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchlake.functions import expressions as X
from pitchlake.operators import ensemble as EN
from pitchlake.plans.queries import query

NB_OFFSET = 10.0


@query("j11_history_inner")
def _(p):
    return p.history


@query("u02_label_concat")
def _(p):
    """The three model tables stacked; only poisson carries intervals."""
    poi = p.model_table("poisson")
    poi = EN.with_poisson_interval(poi, "pontuacao_prevista") \
        .withColumnRenamed("q10", "intervalo_credibilidade_inferior") \
        .withColumnRenamed("q90", "intervalo_credibilidade_superior")
    return EN.stack_models({"xgboost": p.model_table("xgboost"),
                            "lightgbm": p.model_table("lightgbm"), "poisson": poi})


@query("a10_position_priors")
def _(p):
    return p.realised.groupBy("posicao_id").agg(
        # real = score / 40: multiples of 0.00025, so a 5-decimal sum is exact
        (F.round(F.sum("pontuacao_real"), 5) / F.count("pontuacao_real")).alias("prior_media"),
        F.stddev_samp("pontuacao_real").alias("prior_std"))


@query("a11_coverage_macro")
def _(p):
    return EN.model_coverage(p.history)


@query("a12_coverage_by_position")
def _(p):
    return EN.coverage_by_position(p.history)


@query("a13_interval_coverage")
def _(p):
    h = p.history.filter(F.col("modelo") == "poisson")
    j = EN.with_poisson_interval(h, "pontuacao_prevista")
    inside = (F.col("pontuacao_real") >= F.col("q10")) & (F.col("pontuacao_real") <= F.col("q90"))
    return j.agg(F.avg(F.when(inside, 1.0).otherwise(0.0)).alias("coverage_intervalo"),
                 F.count(F.lit(1)).alias("n"))


@query("a14_error_metrics")
def _(p):
    return EN.error_metrics(p.history)


@query("a15_coverage_pivot")
def _(p):
    return EN.coverage_pivot(EN.coverage_by_position(p.history))


@query("a16_model_distribution")
def _(p):
    return p.previsao_final.groupBy("modelo_selecionado").agg(F.count(F.lit(1)).alias("atletas")) \
        .orderBy(F.col("atletas").desc(), F.col("modelo_selecionado"))


@query("a31_model_comparison")
def _(p):
    """Coverage and RMSE per model per round, with the walk-forward
    meta-model ('meta') alongside the three base models."""
    base = p.history
    bt = EN.backtest(p.mp_wide.filter(F.col("p_xgboost").isNotNull() & F.col("p_lightgbm").isNotNull()
                                      & F.col("p_poisson").isNotNull())
                     .withColumnRenamed("p_xgboost", "prev_xgb")
                     .withColumnRenamed("p_lightgbm", "prev_lgb")
                     .withColumnRenamed("p_poisson", "prev_poi"))
    meta = bt.filter(F.col("pontuacao_real").isNotNull()).select(
        "atleta_id", "rodada_alvo", "posicao_id", "pontuacao_real",
        F.col("previsao_final").alias("pontuacao_prevista"), F.lit("meta").alias("modelo"))
    allm = base.unionByName(meta)
    thr = EN.threshold_for(F.col("posicao_id"))
    e = F.col("pontuacao_prevista") - F.col("pontuacao_real")
    return allm.groupBy("modelo", "rodada_alvo").agg(
        F.avg(EN.hit(F.col("pontuacao_prevista"), F.col("pontuacao_real"), thr)).alias("coverage"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n"))


@query("l01_train_score_split")
def _(p):
    w = p.mp_wide
    return w.select("atleta_id", "rodada_alvo",
                    F.when(F.col("pontuacao_real").isNotNull(), "treino").otherwise("previsao")
                    .alias("conjunto"))


@query("l06_poisson_interval")
def _(p):
    return EN.poisson_quantiles(p.model_table("poisson").select(F.col("pontuacao_prevista").alias("mu")))


@query("l07_overdispersed_interval")
def _(p):
    """Negative-binomial 80 % band on scores offset by +10.

    Size per position by the method of moments on the offset realised
    scores: r = mean^2 / (var - mean) when var > mean, else 1e6 (Poisson
    limit).  Bounds are shifted back by the offset.
    """
    h = p.realised.select("posicao_id", (F.col("pontuacao_real") + NB_OFFSET).alias("y"))
    mom = h.groupBy("posicao_id").agg(F.avg("y").alias("m"), F.var_samp("y").alias("v"))
    mom = mom.select("posicao_id", F.when(F.col("v") > F.col("m"),
                                          F.col("m") * F.col("m") / (F.col("v") - F.col("m")))
                     .otherwise(F.lit(1e6)).alias("r"))
    poi = p.mp_long.filter(F.col("modelo") == "poisson").select(
        "atleta_id", "rodada_alvo", "posicao_id", (F.col("pontuacao_prevista") + NB_OFFSET).alias("mu"))
    x = poi.join(F.broadcast(mom), "posicao_id")      # one row per position
    low, high = EN.negbin_quantile(F.col("mu"), F.col("r"))
    return x.select("atleta_id", "rodada_alvo", (low - NB_OFFSET).alias("limite_inferior"),
                    (high - NB_OFFSET).alias("limite_superior"))


@query("l07_wide_interval")
def _(p):
    """L06 + L07 on large, strongly spread counts: order values in hundreds, by customer nation and priority.

    Size by the method of moments, as in ``l07_overdispersed_interval``.
    """
    y = F.floor(F.col("o_totalprice") / 100).cast("long")
    o = p.t.orders.select("o_custkey", "o_orderpriority", y.alias("y"))
    nation = p.t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    g = o.join(nation, "o_custkey").groupBy("c_nationkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("s2"))
    mu = F.col("s") / F.col("n")
    var = (F.col("s2") - F.col("s") * mu) / (F.col("n") - 1)
    g = g.filter("n > 1").select("c_nationkey", "o_orderpriority", "n", mu.alias("mu"), var.alias("v"))
    g = g.withColumn("size", F.when(F.col("v") > F.col("mu"), F.col("mu") * F.col("mu") / (F.col("v") - F.col("mu"))).otherwise(F.lit(1e6)))
    low, high = EN.negbin_quantile(F.col("mu"), F.col("size"))
    plow, phigh = EN.poisson_quantile(F.col("mu"))
    return g.select("c_nationkey", "o_orderpriority", "n", "mu", "size", low.alias("nb_q10"), high.alias("nb_q90"),
                    plow.alias("poisson_q10"), phigh.alias("poisson_q90"))


@query("l08_time_folds")
def _(p):
    return EN.time_folds(p.realised, "rodada_alvo", 5)


@query("l12_prediction_table")
def _(p):
    """Next-round predictions of each model with its history metrics."""
    metrics = EN.error_metrics(p.history).join(EN.model_coverage(p.history), "modelo")
    last = p.mp_long.agg(F.max("rodada_alvo")).scalar()
    nxt = p.mp_long.join(p.next_rows.select("atleta_id", "rodada_alvo"),
                         ["atleta_id", "rodada_alvo"], "left_semi")
    j = nxt.join(F.broadcast(metrics), "modelo")      # 3 rows: one per model
    return j.select("atleta_id", "rodada_alvo", "modelo",
                    F.greatest(F.col("pontuacao_prevista"), F.lit(0.0)).alias("pontuacao_prevista"),
                    "rmse", "mae", F.col("r2").alias("r2_score"), "coverage_score",
                    F.concat(F.lit("pitchlake_"), F.col("modelo")).alias("modelo_versao"),
                    F.concat(F.col("modelo"), F.lit("-r"), last.cast("string")).alias("run_id"))


@query("l13_select_model")
def _(p):
    return p.selection


@query("l14_ensemble_predict")
def _(p):
    return p.previsao_final


@query("l15_ensemble_coverage_col")
def _(p):
    return p.previsao_final.select("atleta_id", "rodada_alvo", "modelo_selecionado",
                                   "coverage_score_modelo")


@query("l16_final_pick_table")
def _(p):
    return p.previsao_final_ranked


@query("w04_rank_in_position")
def _(p):
    return p.previsao_final_ranked.select("atleta_id", "rodada_alvo", "posicao_id", "ranking_posicao")


@query("j04_dim_chain")
def _(p):
    return p.previsao_final_ranked.select("atleta_id", "apelido", "posicao", "clube")


@query("t02_top_per_position")
def _(p):
    return EN.top_per_group(p.previsao_final_ranked, "posicao",
                            [F.col("ranking_posicao"), F.col("atleta_id")], 3) \
        .select("posicao", "atleta_id", "apelido", "pontuacao_prevista", "preco_atual",
                "pontos_por_cartoleta", "ranking_posicao")


@query("t04_top20_value")
def _(p):
    f = p.previsao_final_ranked.filter(F.col("pontos_por_cartoleta").isNotNull())
    return f.orderBy(F.col("pontos_por_cartoleta").desc(), F.col("atleta_id")).limit(20) \
        .select("atleta_id", "apelido", "posicao", "pontuacao_prevista", "preco_atual",
                "pontos_por_cartoleta")


@query("l17_inverse_error_weights")
def _(p):
    return EN.inverse_error_weights(p.history)


@query("l18_backtest")
def _(p):
    w = p.mp_wide.filter(F.col("p_xgboost").isNotNull() & F.col("p_lightgbm").isNotNull()
                         & F.col("p_poisson").isNotNull())
    w = w.withColumnRenamed("p_xgboost", "prev_xgb").withColumnRenamed("p_lightgbm", "prev_lgb") \
        .withColumnRenamed("p_poisson", "prev_poi")
    return EN.backtest(w)


@query("f04_binary_encode")
def _(p):
    fs = p.feature_store
    return fs.select("atleta_id", *X.binary_encode(F.col("mando_campo"), F.col("eh_classico")))


@query("f05_one_hot")
def _(p):
    r = p.realised
    return r.select("atleta_id", "rodada_alvo",
                    *X.one_hot(F.col("posicao_id"), [1, 2, 3, 4, 5, 6], "pos", drop_first=True))


@query("j12_three_way_left")
def _(p):
    """Next-round rows with each model's prediction and coverage side by side."""
    cov = EN.model_coverage(p.history)
    models = {}
    for m in EN.MODELS:
        t = p.model_table(m).join(p.next_rows.select("atleta_id", "rodada_alvo"),
                                  ["atleta_id", "rodada_alvo"], "left_semi")
        models[m] = t.withColumn("coverage_score", cov.filter(F.col("modelo") == m)
                                 .select(F.max("coverage_score")).scalar())
    return EN.merge_models(p.next_rows, models)
