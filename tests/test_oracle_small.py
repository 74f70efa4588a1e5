"""A slice of the DuckDB oracle at sf0.001 (the full gate is scripts/oracle_check.py)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from pitchlake.sources.tables import TABLES

from sf_paths import SF_SMALL

KEYS = ["a08_standings_round", "a09_standings_cumulative", "j01_enrich_with_scores", "a06_athlete_profile",
        "l14_ensemble_predict", "m08_scd2_from_history", "s02_land_athletes", "w14_run_anomalies"]


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    s = sorted(tuple(_canon(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    d = sorted(tuple(_canon(r[i]) for i in idx) for r in cur.fetchall())
    assert s == d


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "posicao" in df.columns
