"""The DAG from its landed payloads: bronze tables, staging views and the layers on them.

``LandedPipeline`` reads market, scores, matches and clubs from flattened
payloads instead of the typed frames, and adds the layers that only payloads
can feed: rounds, market status and round highlights.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.plans import silver
from pitchlake.plans.pipeline import Pipeline
from pitchlake.sources import bindings as B
from pitchlake.sources import landing as L

INGEST_TS, BATCH = "2024-02-01 00:00:00", "b-0001"

#: staging view -> (landed payloads, flattener)
SOURCES = {
    "atletas_mercado": (B.landed_athletes, L.explode_athletes),
    "atletas_pontuados": (B.landed_scored, L.explode_scored),
    "clubes": (B.landed_clubs, L.explode_clubs),
    "ligas": (B.landed_leagues, L.explode_leagues),
    "mercado_status": (B.landed_status, L.flatten_status),
    "partidas": (B.landed_matches, L.explode_matches),
    "pos_rodada_destaques": (B.landed_highlights, L.flatten_highlights),
    "rodadas": (B.landed_rounds, L.explode_rounds),
}


def bronze(t, source: str) -> DataFrame:
    """A bronze table: flattened payloads with ingest time and batch."""
    landed, flatten = SOURCES[source]
    return flatten(landed(t)).withColumns({"_ingestao_timestamp": F.lit(INGEST_TS).cast("timestamp_ntz"),
                                           "_batch_id": F.lit(BATCH)})


def staging(t, source: str) -> DataFrame:
    return silver.staging_view(bronze(t, source), source)


class LandedPipeline(Pipeline):
    """The DAG whose inputs are the staging views of landed payloads."""

    def staged(self, source: str) -> DataFrame:
        """The staging view over the bronze table (the written one, once the DAG has written it)."""
        return silver.staging_view(getattr(self, f"bronze_{source}"), source)

    @cached_property
    def stg_atletas_mercado(self) -> DataFrame:
        return self.staged("atletas_mercado")

    @cached_property
    def stg_atletas_pontuados(self) -> DataFrame:
        return self.staged("atletas_pontuados")

    @cached_property
    def stg_partidas(self) -> DataFrame:
        return self.staged("partidas")

    @cached_property
    def clubes(self) -> DataFrame:
        return self.staged("clubes")

    @cached_property
    def dim_rodadas(self) -> DataFrame:
        return silver.dim_rodadas(self.staged("rodadas"), self.staged("mercado_status"))

    @cached_property
    def fct_mercado_status(self) -> DataFrame:
        return silver.fct_mercado_status(self.staged("mercado_status"))

    @cached_property
    def fct_destaques_rodada(self) -> DataFrame:
        return silver.fct_destaques_rodada(self.staged("pos_rodada_destaques"))


def _bronze_layer(source: str):
    layer = cached_property(lambda self: bronze(self.t, source))
    layer.__set_name__(LandedPipeline, f"bronze_{source}")
    return layer


for _source in SOURCES:
    setattr(LandedPipeline, f"bronze_{_source}", _bronze_layer(_source))

#: (property, partition columns) of the layers on payloads, in dependency order
BRONZE_LAYERS = tuple((f"bronze_{s}", ["_rodada_captura"] if s == "atletas_mercado" else None) for s in SOURCES)
LANDED_LAYERS = (("dim_rodadas", None), ("fct_mercado_status", None), ("fct_destaques_rodada", ["rodada_id"]))
