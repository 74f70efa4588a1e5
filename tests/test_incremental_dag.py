"""Refresh of the DAG: a late score re-opens the rounds that it reaches, and nothing else."""

import glob
import os

from pyspark.sql import functions as F

from pitchlake.plans import incremental as INC
from pitchlake.plans.pipeline import Pipeline, training_features
from pitchlake.plans.q_more import _BeforeLateScores

from sf_paths import SF_SMALL


def _files(out):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{out}/*/*/*.parquet")}


def _round(path):
    return int(path.split("=")[1].split("/")[0])


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_a_late_score_changes_the_rounds_it_reaches(spark, tmpdir_path, monkeypatch):
    out = os.path.join(tmpdir_path, "dag")
    first = INC.refresh(_BeforeLateScores(spark, SF_SMALL, share=False), out)
    assert first.filter("state <> 'rewritten'").count() == 0
    before = _files(out)

    # the refresh fails after the fact: the changes that it found must not be lost
    real = INC.IO.replace_partitions

    def fail(df, path, by):
        if path.endswith("metricas_clube_rodada"):
            raise RuntimeError("lost")
        real(df, path, by)
    monkeypatch.setattr(INC.IO, "replace_partitions", fail)
    try:
        INC.refresh(Pipeline(spark, SF_SMALL, share=False), out)
        raise AssertionError("it should have failed")
    except RuntimeError:
        pass
    monkeypatch.setattr(INC.IO, "replace_partitions", real)
    p = Pipeline(spark, SF_SMALL, share=False)
    second = INC.refresh(p, out).filter("state = 'rewritten'").collect()
    after = _files(out)

    touched = {}
    for f in set(before) ^ set(after) | {f for f in before if after.get(f) != before[f]}:
        touched.setdefault(f[len(out) + 1:].split("/")[0], set()).add(_round(f))
    assert touched["stg_atletas_pontuados"] == touched["fct_atletas_rodada"] == {15}
    assert touched["training_features"] and min(touched["training_features"]) >= 15
    assert not {"stg_partidas", "fct_partidas", "tabela_liga", "stg_atletas_mercado"} & set(touched)
    assert {r.layer for r in second} <= {"metricas_clube_rodada", "training_features"}

    full = Pipeline(spark, SF_SMALL, share=False)
    for layer in INC.LAYERS:
        want = getattr(full, layer.name)
        assert _rows(getattr(p, layer.name).select(*want.columns)) == _rows(want), layer.name

    again = INC.refresh(Pipeline(spark, SF_SMALL, share=False), out)
    assert again.filter("state = 'rewritten'").count() == 0 and _files(out) == after


def test_what_was_newest_is_opened_when_a_round_arrives():
    assert INC.REACH["from"]({31}, set(range(1, 32))) == {30, 31}
    assert INC.REACH["from"]({1}, {1, 2, 3}) == {1, 2, 3}
    assert INC.REACH["next"]({4}, set()) == {4, 5}


def test_fingerprints_see_nulls_and_places(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, "x", None), (2, "y", "y")], "r int, a string, b string")
    b = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, "y", "y")], "r int, a string, b string")
    fa, fb = INC.fingerprints(a, "r"), INC.fingerprints(b, "r")
    assert fa[1] != fb[1] and fa[2] == fb[2] and INC.fingerprints(a.orderBy(F.desc("a")), "r") == fa
    assert INC.fingerprints(None, "r") == {} and training_features is not None


def test_the_dag_from_landed_payloads(spark, tmpdir_path):
    """Bronze tables from payloads feed the same silver and gold; a second run gives the same tables."""
    from pitchlake.plans.landed import BRONZE_LAYERS, LANDED_LAYERS, SOURCES
    from pitchlake.plans.run import LAYERS, run_dag
    out = os.path.join(tmpdir_path, "landed")
    paths = run_dag(spark, SF_SMALL, out, trained=False, landed=True)
    assert set(paths) == {n for n, _ in (*BRONZE_LAYERS, *LAYERS, *LANDED_LAYERS)} and len(BRONZE_LAYERS) == len(SOURCES) == 8
    read = lambda n: spark.read.parquet(paths[n])
    plain = Pipeline(spark, SF_SMALL, share=False)
    for layer, keys in (("fct_atletas_rodada", ["atleta_id", "rodada_id", "pontos_num", "preco_num", "clube_id"]),
                        ("tabela_liga", ["rodada_id", "clube_id", "posicao", "pontos"]),
                        ("metricas_atleta", ["atleta_id", "total_jogos", "media_pontos"])):
        assert _rows(read(layer).select(*keys)) == _rows(getattr(plain, layer).select(*keys)), layer
    assert read("dim_rodadas").count() > 0 and read("fct_mercado_status").count() > 0 and read("fct_destaques_rodada").count() > 0
    before = {n: _rows(read(n)) for n in ("tabela_liga", "dim_rodadas", "bronze_atletas_mercado")}
    run_dag(spark, SF_SMALL, out, trained=False, landed=True)
    assert before == {n: _rows(read(n)) for n in before}
