"""League table: results, ties, NULL scores, idle clubs, cumulative totals."""

from pyspark.sql import functions as F

from pitchlake.operators import standings as S
from pitchlake.plans import silver


def _matches(spark, rows):
    raw = spark.createDataFrame(
        [(i, r, h, a, hs, as_, "2024-01-01 00:00:00", "x", True) for i, (r, h, a, hs, as_) in enumerate(rows)],
        "partida_id int, rodada_id int, clube_casa_id int, clube_visitante_id int, "
        "placar_oficial_mandante int, placar_oficial_visitante int, partida_data string, estadio string, valida boolean")
    return silver.fct_partidas(raw.withColumn("partida_data", F.to_timestamp("partida_data")))


def test_standings_round_ties_and_null(spark):
    m = _matches(spark, [(1, 1, 2, 2, 0), (1, 3, 4, 1, 0), (1, 5, 6, 0, 0), (1, 7, 8, None, None)])
    t = {(r.clube_id, r.rodada_id): r for r in S.standings_round(m).collect()}
    assert (7, 1) not in t and (8, 1) not in t           # unplayed match ignored
    assert t[(1, 1)].pontos == 3 and t[(1, 1)].posicao == 1   # GD +2 beats GD +1
    assert t[(3, 1)].posicao == 2
    assert t[(5, 1)].pontos == 1 and t[(6, 1)].posicao == t[(5, 1)].posicao  # 0-0 tie shares rank
    assert t[(1, 1)].aproveitamento_percentual == 100.0


def test_wins_equal_losses_and_points_identity(spark):
    m = _matches(spark, [(1, 1, 2, 2, 0), (1, 3, 4, 1, 1), (2, 2, 1, 3, 1), (2, 4, 3, 0, 2)])
    t = S.standings_round(m)
    per = t.groupBy("rodada_id").agg(F.sum("vitorias").alias("w"), F.sum("derrotas").alias("l"),
                                     F.sum("empates").alias("d"), F.sum("pontos").alias("p")).collect()
    for r in per:
        assert r.w == r.l
        assert r.p == 3 * r.w + r.d


def test_cumulative_keeps_idle_club_and_matches_one_shot(spark):
    m = _matches(spark, [(1, 1, 2, 1, 0), (1, 3, 4, 0, 2), (2, 1, 3, 2, 2), (3, 1, 2, 0, 1), (3, 3, 4, 1, 1)])
    cum = S.standings_cumulative(m)
    rows = {(r.clube_id, r.rodada_id): r for r in cum.collect()}
    assert (2, 2) in rows and rows[(2, 2)].pontos == 0 and rows[(2, 2)].jogos == 1  # idle in round 2 (lost r1)
    last = cum.filter("rodada_id = 3").select("clube_id", "pontos", "jogos").collect()
    once = S.club_perspectives(m).groupBy("clube_id").agg(
        F.sum(F.when(F.col("resultado") == "V", 3).when(F.col("resultado") == "E", 1).otherwise(0)).alias("p"),
        F.count(F.lit(1)).alias("j")).collect()
    assert {(r.clube_id, r.pontos, r.jogos) for r in last} == {(r.clube_id, r.p, r.j) for r in once}


def test_streaks(spark):
    m = _matches(spark, [(1, 1, 2, 1, 0), (2, 1, 3, 1, 1), (3, 1, 4, 0, 2), (4, 1, 2, 3, 0)])
    s = {r.rodada_id: (r.invicto_seq, r.sem_vitoria_seq)
         for r in S.streaks(m).filter("clube_id = 1").collect()}
    assert s == {1: (1, 0), 2: (2, 1), 3: (0, 2), 4: (1, 0)}


def test_last5_form_spans_rounds(spark):
    # club 1: round 1 has 3 matches (W, D, L), round 2 has 4 (W, W, W, D), round 3 one
    rows = [(1, 1, 9, 1, 0), (1, 1, 9, 0, 0), (1, 1, 9, 0, 1),
            (2, 1, 9, 1, 0), (2, 1, 9, 2, 0), (2, 1, 9, 3, 0), (2, 1, 9, 0, 0), (3, 1, 9, 1, 1)]
    m = _matches(spark, rows)
    f = {r.rodada_id: r.forma_ultimos5 for r in S.last5_form(m).filter("clube_id = 1").collect()}
    assert f == {1: "", 2: "ved", 3: "edvvve"[1:]}
