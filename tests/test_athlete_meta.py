"""Athlete metrics edge cases and the meta-model (coverage, selection, ensemble)."""

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import athlete as A
from pitchlake.operators import ensemble as EN
from pitchlake.sources import seeds

FACT = ("atleta_id int, rodada_id int, clube_id int, posicao_id int, pontos_num double, preco_num double, "
        "variacao_num double, entrou_em_campo boolean")


def _fact(spark, rows):
    df = spark.createDataFrame(rows, FACT)
    zeros = [F.lit(0).alias(n) for _, n in __import__("pitchlake.functions.expressions",
                                                          fromlist=["x"]).SCOUT_COLUMNS]
    return df.select("*", *zeros)


def test_one_game_zero_and_negative_mean_and_transfer(spark):
    f = _fact(spark, [(1, 1, 10, 4, 5.0, 3.0, 0.1, True),                        # one game: sd NULL
                      (2, 1, 10, 4, 0.0, 2.0, 0.0, True),                        # zero mean
                      (3, 1, 10, 4, -2.0, 2.0, 0.0, True), (3, 2, 10, 4, -4.0, 2.0, 0.0, True),
                      (4, 1, 10, 4, 6.0, 5.0, 0.0, True), (4, 2, 11, 4, 8.0, 6.0, 0.0, True)])  # transfer
    t = {(r.atleta_id, r.clube_id): r for r in A.season_totals(A.played(f)).collect()}
    assert t[(1, 10)].desvio_padrao_pontos is None
    assert A.consistency(F.lit(5.0), F.lit(None).cast("double")) is not None
    got = f.sparkSession.createDataFrame([(0.0, None), (-3.0, 1.0), (5.0, None)], "m double, s double") \
        .select(A.consistency(F.col("m"), F.col("s")).alias("c"),
                A.price_per_point(F.lit(10.0), F.col("m")).alias("pp")).collect()
    assert [r.c for r in got] == [0.0, 0.0, 1.0] and got[0].pp is None and got[2].pp == 2.0
    assert (4, 10) in t and (4, 11) in t                                          # K3: two rows


def test_recent_means_and_rolling_frames(spark):
    f = _fact(spark, [(1, r, 1, 1, float(r), 1.0 * r, 0.0, True) for r in range(1, 8)])
    m = A.recent_means(A.played(f)).collect()[0]
    assert m.media_ultimas_5 == pytest.approx(5.0) and m.media_ultimas_3 == pytest.approx(6.0)
    assert m.preco_atual == 7.0
    asc = {r.rodada_id: r.media_ultimas_3 for r in A.rolling_mean(f, 3).collect()}
    lit = {r.rodada_id: r.media_ultimas_3 for r in A.rolling_mean(f, 3, literal=True).collect()}
    assert asc[7] == pytest.approx(6.0) and lit[1] == pytest.approx(2.0)


def _hist(spark, rows):
    return spark.createDataFrame(rows, "modelo string, posicao_id int, rodada_alvo int, "
                                       "pontuacao_prevista double, pontuacao_real double")


def test_selection_single_tie_ensemble_zero_and_no_history(spark):
    pos = seeds.positions(spark)
    h = _hist(spark, [
        # position 1: lightgbm and xgboost both perfect -> tie goes to 'lightgbm' (alphabetical)
        ("xgboost", 1, 10, 1.0, 1.0), ("lightgbm", 1, 10, 1.0, 1.0), ("poisson", 1, 10, 9.0, 1.0),
        # position 2: below 0.70 -> ensemble weights proportional to coverage
        ("xgboost", 2, 10, 1.0, 1.0), ("xgboost", 2, 10, 9.0, 1.0), ("lightgbm", 2, 10, 9.0, 1.0),
        ("lightgbm", 2, 10, 1.0, 1.0), ("poisson", 2, 10, 9.0, 1.0), ("poisson", 2, 10, 9.0, 1.0),
        # position 3: every model misses -> uniform over the models present
        ("xgboost", 3, 10, 9.0, 1.0), ("poisson", 3, 10, 9.0, 1.0)])
    sel = {r.posicao_id: r for r in EN.select_model(EN.coverage_by_position(h), pos).collect()}
    assert sel[1].modelo == "lightgbm" and sel[1].w_lgb == 1.0 and sel[1].coverage_modelo == 1.0
    assert sel[2].modelo == "ensemble" and sel[2].w_xgb == pytest.approx(0.5) and sel[2].w_poi == 0.0
    assert sel[3].w_xgb == pytest.approx(0.5) and sel[3].w_poi == pytest.approx(0.5) and sel[3].w_lgb is None
    assert sel[4].modelo == "ensemble" and sel[4].w_xgb == pytest.approx(1 / 3)     # no history
    for r in sel.values():
        ws = [w for w in (r.w_xgb, r.w_lgb, r.w_poi) if w is not None]
        assert sum(ws) == pytest.approx(1.0)


def test_ensemble_rows(spark):
    pos = seeds.positions(spark)
    h = _hist(spark, [("xgboost", 1, 10, 1.0, 1.0), ("lightgbm", 1, 10, 9.0, 1.0), ("poisson", 1, 10, 9.0, 1.0),
                      ("xgboost", 2, 10, 9.0, 1.0), ("lightgbm", 2, 10, 1.0, 1.0), ("poisson", 2, 10, 9.0, 1.0),
                      ("lightgbm", 2, 10, 9.0, 1.0)])
    sel = EN.select_model(EN.coverage_by_position(h), pos)
    rows = spark.createDataFrame([(1, 11, 1), (2, 11, 1), (3, 11, 2), (4, 11, None)],
                                 "atleta_id int, rodada_alvo int, posicao_id int")
    preds = spark.createDataFrame([(1, 11, "xgboost", 4.0), (1, 11, "lightgbm", 2.0),
                                   (2, 11, "lightgbm", 3.0),          # single model missing -> ensemble
                                   (3, 11, "xgboost", 2.0), (3, 11, "lightgbm", 6.0)],
                                  "atleta_id int, rodada_alvo int, modelo string, pontuacao_prevista double")
    out = {r.atleta_id: r for r in EN.ensemble_predict(rows, preds, EN.model_coverage(h), sel).collect()}
    assert out[1].modelo_selecionado == "xgboost" and out[1].pontuacao_prevista == 4.0
    assert out[2].modelo_selecionado == "ensemble" and out[2].pontuacao_prevista == 0.0
    assert out[3].modelo_selecionado == "ensemble" and out[3].pontuacao_prevista == pytest.approx(6.0)
    assert out[4].pontuacao_prevista == 0.0                                           # null position -> 4


def test_poisson_quantiles_known_values_and_monotone(spark):
    mu = spark.createDataFrame([(3.0,), (10.0,), (0.0,), (25.0,)], "mu double")
    q = {r.mu: (r.q10, r.q90) for r in EN.poisson_quantiles(mu).collect()}
    assert q[3.0] == (1, 5) and q[10.0] == (6, 14) and q[0.0] == (0, 0)
    assert q[25.0][0] >= q[10.0][0] and q[25.0][1] >= q[10.0][1]


def test_time_folds_expanding(spark):
    r = spark.createDataFrame([(i,) for i in range(1, 13)], "rodada_alvo int")
    f = EN.time_folds(r, "rodada_alvo", 5).collect()
    test1 = sorted(x.rodada_alvo for x in f if x.fold == 1 and x.papel == "test")
    train5 = sorted(x.rodada_alvo for x in f if x.fold == 5 and x.papel == "train")
    assert test1 == [3, 4] and train5 == list(range(1, 11))
