"""Queries: landed payloads to bronze tables, their staging views and the facts on them."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from pitchlake.operators import merge as M
from pitchlake.plans import silver
from pitchlake.plans.landed import SOURCES, bronze, staging
from pitchlake.plans.queries import query
from pitchlake.sources import bindings as B
from pitchlake.sources import contracts as C
from pitchlake.sources import landing as L
from pitchlake.sources import seeds


def _register(source: str) -> None:
    @query(f"p01_stg_{source}")
    def _(p):
        return staging(p.t, source)

    @query(f"s20_contract_{source}")
    def _(p):
        """The staged table against its declared schema (no row: it conforms)."""
        return C.enforce_contract(staging(p.t, source), C.STAGING_CONTRACTS[source])


for _source in SOURCES:
    _register(_source)


@query("s02_rejected_payloads")
def _(p):
    """Landed pages of every seventh round are cut off: counted, not lost in silence."""
    r = F.col("_rodada_captura")
    pages = B.landed_athletes(p.t).withColumn(
        "payload", F.when(r % 7 == 0, F.expr("substring(payload, 1, length(payload) - 5)")).otherwise(F.col("payload")))
    bad = L.rejected_payloads(pages, L.ATHLETES_SCHEMA).groupBy("_rodada_captura").agg(F.count(F.lit(1)).alias("rejeitados"))
    return (pages.groupBy("_rodada_captura").agg(F.count(F.lit(1)).alias("paginas")).join(bad, "_rodada_captura", "left")
            .select("_rodada_captura", "paginas", F.coalesce("rejeitados", F.lit(0)).cast("long").alias("rejeitados")))


@query("m01_bronze_upsert")
def _(p):
    """Landed athletes merged into bronze: rounds up to 20 are there (stale), 15 and later arrive."""
    new = bronze(p.t, "atletas_mercado").drop("_raw_json")
    old = new.filter("_rodada_captura <= 20").withColumn("pontos_num", F.lit(-1.0))
    out = M.merge_upsert(old, new.filter("_rodada_captura >= 15"), ["atleta_id", "_rodada_captura"])
    return out.select("atleta_id", "_rodada_captura", "pontos_num", "preco_num", "_batch_id")


@query("j03_fct_mercado_status")
def _(p):
    return silver.fct_mercado_status(staging(p.t, "mercado_status"))


@query("p01_fct_destaques_rodada")
def _(p):
    return silver.fct_destaques_rodada(staging(p.t, "pos_rodada_destaques"))


@query("s12_seeds_from_csv")
def _(p):
    """The four seeds written as CSV and read back with their schemas; rows joined to athletes."""
    from pitchlake.session import scratch_path
    base = scratch_path(p.spark, f"seeds-{uuid.uuid4().hex[:12]}")
    for name, df in seeds.load_seeds(p.spark).items():
        df.write.option("header", "true").csv(os.path.join(base, f"seed_{name}.csv"))
    read = seeds.load_seeds(p.spark, base)
    a = staging(p.t, "atletas_mercado").groupBy("posicao_id", "status_id").agg(F.count(F.lit(1)).alias("atletas"))
    j = (a.join(read["posicoes"].select("posicao_id", "abreviacao"), "posicao_id", "left")
         .join(read["status_atleta"].select("status_id", "disponivel"), "status_id", "left"))
    n = [read[k].agg(F.count(F.lit(1))).scalar().alias(f"n_{k}") for k in ("pontuacao_scouts", "classicos")]
    return j.select("posicao_id", "status_id", "abreviacao", "disponivel", "atletas", *n)
