"""Queries: merges, history (SCD-2), change feed and data-quality rules."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from pitchlake.operators import history as H
from pitchlake.operators import merge as M
from pitchlake.operators import quality as Q
from pitchlake.operators.windows import latest_per_key
from pitchlake.plans import incremental as INC
from pitchlake.plans import silver
from pitchlake.plans.pipeline import Pipeline
from pitchlake.plans.queries import query
from pitchlake.sources import bindings as B
from pitchlake.sources import io as IO
from pitchlake.streaming.pipeline import scratch

ORDER_KEY = "o_orderkey"
SCD_ASOF = "2001-12-31"
SNAPSHOT_BEFORE = "1999-01-01"
EVENTS_ASOF = "2024-01-31"


# ------------------------------------------------------------------ merges
@query("m01_merge_upsert")
def _(p):
    return M.merge_upsert(B.merge_target(p.t), B.merge_source(p.t), ORDER_KEY)


@query("m02_merge_insert_only")
def _(p):
    return M.merge_insert_only(B.merge_target(p.t), B.merge_source(p.t), ORDER_KEY)


@query("m03_incremental_model")
def _(p):
    """Previous load of the athlete fact + look-back-1 rebuild + merge."""
    from pitchlake.plans.q_core import PREVIOUS_LOAD_BEFORE
    full = p.fct_atletas_rodada
    target = full.filter(F.col("_ingestao_timestamp") < F.lit(PREVIOUS_LOAD_BEFORE).cast("timestamp_ntz"))

    def build(pred):
        # the predicate reaches both inputs, so only the look-back rounds are rebuilt
        return silver.fct_atletas_rodada(pred(p.stg_atletas_mercado), pred(p.stg_atletas_pontuados))

    return M.run_incremental(build, target, ["atleta_id", "rodada_id"], "rodada_id", lookback=1)


class _BeforeLateScores(Pipeline):
    """The same inputs before the scores of every second athlete of round 15 arrived."""

    @cached_property
    def stg_atletas_pontuados(self):
        return super().stg_atletas_pontuados.filter("rodada_id <> 15 OR atleta_id % 2 <> 0")


@query("m03_incremental_dag")
def _(p):
    """M03 over the DAG: built before late scores arrived, refreshed after; the training table that results."""
    out = scratch(p.spark, "m03")
    INC.refresh(_BeforeLateScores(p.spark, p.sf_dir, share=False), out)
    after = Pipeline(p.spark, p.sf_dir, share=False)
    INC.refresh(after, out)
    return after.training_features


@query("m08_price_snapshot")
def _(p):
    """M08 on athletes: a version for every change of price, club or status between captures."""
    return H.scd2_build(p.stg_atletas_mercado, "atleta_id", ["preco_num", "clube_id", "status_id"], "_ingestao_timestamp",
                        "_rodada_captura", keep=["posicao_id", "media_num", "variacao_num"])


@query("m04_merge_selected_columns")
def _(p):
    return M.merge_update_columns(B.merge_target(p.t), B.merge_source(p.t), ORDER_KEY,
                                  ["o_totalprice"])


@query("m05_delete_insert")
def _(p):
    return M.delete_insert(B.merge_target(p.t), B.merge_source(p.t), ORDER_KEY)


@query("m06_insert_overwrite")
def _(p):
    """M06 on EV: a written table's last 3 daily partitions are rebuilt from a re-computation."""
    ev = p.t.events.withColumn("event_date", F.to_date("ts"))
    path = f"{scratch(p.spark, 'm06')}/events"
    IO.replace_partitions(ev, path, ["event_date"])
    fresh = ev.withColumn("value", F.col("value") + F.lit(1.0))
    return M.overwrite_recent(path, fresh, "event_date", 3).select(*ev.columns)


@query("m07_scd2_check")
def _(p):
    px = B.capture_history(p.t)
    snap = H.scd2_build(px.filter(F.col("captured_at") < F.lit(SNAPSHOT_BEFORE).cast("timestamp_ntz")),
                        "key_id", ["status", "priority"], "captured_at", "capture_seq")
    latest = latest_per_key(px, ["key_id"], ["captured_at", "capture_seq"])
    return H.scd2_apply(snap, latest, "key_id", ["status", "priority"],
                        F.lit(SCD_ASOF).cast("timestamp_ntz"), tie="capture_seq")


@query("m08_scd2_from_history")
def _(p):
    return H.scd2_build(B.capture_history(p.t), "key_id", ["status", "priority"],
                        "captured_at", "capture_seq")


@query("m09_change_feed")
def _(p):
    return M.change_feed(B.merge_target(p.t), B.merge_source(p.t), ORDER_KEY)


@query("m11_merge_source_guard")
def _(p):
    ev = p.t.events.withColumn("dia", F.to_date("ts"))
    return M.dedupe_source(ev, ["user_id", "dia"], ["ts", "event_id"])


@query("m11_duplicate_source_keys")
def _(p):
    return M.duplicate_keys(p.t.lineitem, ["l_orderkey", "l_linenumber"])


@query("st6_late_data")
def _(p):
    """ST6 (batch): late official scores re-open the last round(s) of the fact.

    The previous load is merged with the rebuilt look-back window, exactly
    like the incremental model; the result must equal a full rebuild.
    """
    from pitchlake.plans.q_core import PREVIOUS_LOAD_BEFORE
    full = p.fct_atletas_rodada
    target = full.filter(F.col("_ingestao_timestamp") < F.lit(PREVIOUS_LOAD_BEFORE).cast("timestamp_ntz"))
    late = M.incremental(full, target, "rodada_id", lookback=1)
    return M.merge_upsert(target, late, ["atleta_id", "rodada_id"]).select(
        "atleta_id", "rodada_id", "pontos_num")


# ------------------------------------------------------------------ quality
@query("q01_not_null")
def _(p):
    return Q.not_null(p.fct_partidas_proxima, "placar_mandante").select("partida_id", "rodada_id")


@query("q02_unique")
def _(p):
    return Q.unique(p.t.orders, "o_custkey")


@query("q03_accepted_values")
def _(p):
    return Q.accepted_values(p.t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"],
                             where=F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderpriority")


@query("q04_relationships")
def _(p):
    parent = p.t.orders.filter(F.col("o_orderstatus") != "P")
    return Q.relationships(p.t.lineitem, "l_orderkey", parent, "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey")


@query("q05_expression_true")
def _(p):
    return Q.expression_true(p.tabela_liga,
                             "aproveitamento_percentual >= 0 AND aproveitamento_percentual <= 100")


@query("q06_composite_unique")
def _(p):
    return Q.unique(p.t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q07_range_check")
def _(p):
    return Q.in_range(p.fct_atletas_rodada, "rodada_id", 1, 38)


@query("q08_non_negative")
def _(p):
    return Q.non_negative(p.fct_partidas, ["placar_mandante", "placar_visitante"],
                          keep=["partida_id", "rodada_id"])


EVENT_RULES = {
    "valor_positivo": "value > 0",
    "tipo_conhecido": "event_type IN ('view', 'click', 'purchase', 'signup')",
    "valor_plausivel": "value < 400",
}


@query("q09_expect_or_drop")
def _(p):
    _kept, counts = Q.expect_or_drop(p.t.events, EVENT_RULES)
    return counts


@query("q09_expect_or_drop_kept")
def _(p):
    kept, _ = Q.expect_or_drop(p.t.events, EVENT_RULES)
    return kept.select("event_id", "user_id", "event_type", "value")


@query("q10_freshness_recency")
def _(p):
    return Q.freshness(p.t.events, "ts", EVENTS_ASOF, 12, 24)


@query("q11_suite_runner")
def _(p):
    rules = {"not_null_o_orderkey": "o_orderkey IS NOT NULL",
             "accepted_o_orderstatus": "o_orderstatus IN ('F', 'O', 'P')",
             "non_negative_o_totalprice": "o_totalprice >= 0",
             "accepted_o_orderpriority": "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"}
    return Q.run_suite(p.t.orders, rules, unique_cols=["o_orderkey"],
                       fk=("o_custkey", p.t.customer, "c_custkey"))


@query("q12_validate_copy")
def _(p):
    """Q12: an upsert that re-delivers every order must reproduce the table."""
    o = p.t.orders
    copy = M.merge_upsert(o, o, ORDER_KEY)
    return Q.validate_copy(o, copy, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("j18_orphan_anti")
def _(p):
    parent = p.t.orders.filter(F.col("o_orderstatus") != "P")
    return Q.relationships(p.t.lineitem, "l_orderkey", parent, "o_orderkey") \
        .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("linhas_orfas"))


@query("q11_declared_model_tests")
def _(p):
    """Q11 on the pipeline's own models: every column test and singular test
    the reference declares, as (model, column, test, failures)."""
    from pitchlake.sources import landing as L
    models = {
        "dim_clubes": p.dim_clubes, "dim_posicoes": p.dim_posicoes, "dim_atletas": p.dim_atletas,
        "dim_rodadas": silver.dim_rodadas(L.explode_rounds(B.landed_rounds(p.t)), B.status_captures(p.t)),
        "fct_atletas_rodada": p.fct_atletas_rodada, "fct_partidas": p.fct_partidas_proxima,
        "fct_mercado_status": silver.fct_mercado_status(L.flatten_status(B.landed_status(p.t))),
        "fct_destaques_rodada": L.flatten_highlights(B.landed_highlights(p.t)),
        "metricas_atleta_acumulado": p.metricas_atleta, "tabela_liga": p.tabela_liga,
        "metricas_clube_rodada": p.metricas_clube_rodada, "feature_store_previsao": p.feature_store,
        "previsao_final": p.previsao_final_ranked,
    }
    return Q.run_declared_tests(models)
