"""Coverage scoring, model selection and the weighted ensemble.

The reference does this in pandas on the driver (``toPandas`` + row
loops).  Here every step is a distributed aggregate or column expression:
coverage is ``avg(when(hit))`` per (model, position); the selection is one
row per position (bounded by the fixed position list) and is joined back by
broadcast; the ensemble is plain column arithmetic per athlete row.
"""

from __future__ import annotations

from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.operators import count_quantiles as CQ
from pitchlake.operators.windows import rank_in_groups
from pitchlake.sources.seeds import (COVERAGE_MIN, COVERAGE_THRESHOLDS, COVERAGE_WINDOW,
                                     DEFAULT_THRESHOLD)

MODELS = ("xgboost", "lightgbm", "poisson")     # alphabetical tie order: lightgbm, poisson, xgboost
SHORT = {"xgboost": "xgb", "lightgbm": "lgb", "poisson": "poi"}


def threshold_for(position: Column, thresholds: dict | None = None,
                  default: float = DEFAULT_THRESHOLD) -> Column:
    """Per-position error tolerance from a literal map (no join needed)."""
    th = thresholds or COVERAGE_THRESHOLDS
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in th.items()))
    return F.coalesce(m[position], F.lit(float(default)))


def hit(pred: Column, real: Column, thr: Column) -> Column:
    return F.when(F.abs(pred - real) <= thr, 1.0).otherwise(0.0)


# ------------------------------------------------------------------ J11 / U02
def with_actuals(pred: DataFrame, real: DataFrame, name: str) -> DataFrame:
    """A model's predictions joined to the realised scores, labelled."""
    return (pred.select("atleta_id", "rodada_alvo", "pontuacao_prevista")
            .join(real.select("atleta_id", "rodada_alvo", "pontuacao_real", "posicao_id"),
                  ["atleta_id", "rodada_alvo"])
            .withColumn("modelo", F.lit(name)))


def with_actuals_long(preds: DataFrame, real: DataFrame) -> DataFrame:
    """J11 for all models at once: long predictions (atleta_id, rodada_alvo,
    modelo, pontuacao_prevista) joined once to the realised scores."""
    return (preds.select("atleta_id", "rodada_alvo", "pontuacao_prevista", "modelo")
            .join(real.select("atleta_id", "rodada_alvo", "pontuacao_real", "posicao_id"),
                  ["atleta_id", "rodada_alvo"]))


def stack_models(frames: dict[str, DataFrame]) -> DataFrame:
    """Concatenate model outputs with a label column (missing columns -> NULL)."""
    out = None
    for name, df in frames.items():
        d = df.withColumn("modelo", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------ A11-A15
def coverage_by_position(hist: DataFrame, window: int = COVERAGE_WINDOW) -> DataFrame:
    """Coverage and n per (model, position) over the last ``window`` rounds
    (``rodada_alvo >= max - window + 1``, inclusive, as coded)."""
    last = hist.agg(F.max("rodada_alvo")).scalar()
    h = hist.filter(F.col("rodada_alvo") >= last - (window - 1))
    thr = threshold_for(F.col("posicao_id"))
    return h.groupBy("modelo", "posicao_id").agg(
        F.avg(hit(F.col("pontuacao_prevista"), F.col("pontuacao_real"), thr)).alias("coverage"),
        F.count(F.lit(1)).alias("n"))


def coverage_pivot(cov: DataFrame) -> DataFrame:
    """Position x model coverage matrix, rounded to 3 digits."""
    return cov.groupBy("posicao_id").pivot("modelo", list(MODELS)).agg(
        F.round(F.first("coverage"), 3))


def error_metrics(hist: DataFrame, by: list[str] | None = None) -> DataFrame:
    """RMSE, MAE and R^2 per model from one pass of sums."""
    by = by or ["modelo"]
    e = F.col("pontuacao_prevista") - F.col("pontuacao_real")
    g = hist.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                              F.sum(e * e).alias("sse"), F.avg(F.abs(e)).alias("mae"),
                              F.avg("pontuacao_real").alias("_mean"),
                              F.sum(F.col("pontuacao_real") * F.col("pontuacao_real")).alias("_s2"))
    sst = F.col("_s2") - F.col("n") * F.col("_mean") * F.col("_mean")
    return g.select(*by, "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), "mae",
                    F.when(sst > 0, 1 - F.col("sse") / sst).alias("r2"))


def model_coverage(hist: DataFrame) -> DataFrame:
    """A11 per model: share of predictions within the position tolerance."""
    thr = threshold_for(F.col("posicao_id"))
    return hist.groupBy("modelo").agg(
        F.avg(hit(F.col("pontuacao_prevista"), F.col("pontuacao_real"), thr)).alias("coverage_score"))


# ------------------------------------------------------------------ L13
def select_model(cov: DataFrame, positions: DataFrame, min_cov: float = COVERAGE_MIN) -> DataFrame:
    """Per position, the single model or the ensemble weights.

    best coverage >= ``min_cov`` -> that model alone (ties: alphabetical
    first); else weights = coverage / sum; sum 0 -> uniform over the models
    present; no history -> 1/3 each.  ``positions`` lists the positions to
    decide for (one row each).
    """
    g = cov.groupBy("posicao_id").agg(
        F.array_min(F.collect_list(F.struct((-F.col("coverage")).alias("neg"), F.col("modelo").alias("m"))))
        .alias("_best"),
        F.sum("coverage").alias("_tot"),
        F.count(F.lit(1)).alias("_k"),
        *[F.max(F.when(F.col("modelo") == m, F.col("coverage"))).alias(f"cov_{SHORT[m]}") for m in MODELS],
    )
    p = positions.select("posicao_id").join(g, "posicao_id", "left")
    best_cov = -F.col("_best.neg")
    single = F.col("_best").isNotNull() & (best_cov >= min_cov)
    modelo = F.when(single, F.col("_best.m")).otherwise(F.lit("ensemble"))
    ws = []
    for m in MODELS:
        c = F.col(f"cov_{SHORT[m]}")
        w = (F.when(F.col("_best").isNull(), F.lit(1.0 / 3))
             .when(single, F.when(F.col("_best.m") == m, F.lit(1.0)))
             .when(F.col("_tot") == 0, F.when(c.isNotNull(), F.lit(1.0) / F.col("_k")))
             .otherwise(c / F.col("_tot")))
        ws.append(w.alias(f"w_{SHORT[m]}"))
    return p.select("posicao_id", modelo.alias("modelo"),
                    F.when(single, best_cov).alias("coverage_modelo"),
                    *ws, *[F.col(f"cov_{SHORT[m]}") for m in MODELS])


# ------------------------------------------------------------------ L14 / L15
def ensemble_predict(rows: DataFrame, preds: DataFrame, model_cov: DataFrame,
                     selection: DataFrame) -> DataFrame:
    """L14 + L15: the final prediction of each athlete row.

    ``rows`` (atleta_id, rodada_alvo, posicao_id) to predict; ``preds`` long
    (atleta_id, rodada_alvo, modelo, pontuacao_prevista); ``model_cov``
    (modelo, coverage_score); ``selection`` from :func:`select_model`.
    """
    wide = preds.groupBy("atleta_id", "rodada_alvo").pivot("modelo", list(MODELS)).agg(
        F.first("pontuacao_prevista"))
    for m in MODELS:
        wide = wide.withColumnRenamed(m, f"prev_{SHORT[m]}")
    covs = [model_cov.filter(F.col("modelo") == m).select(F.max("coverage_score")).scalar()
            .alias(f"mcov_{SHORT[m]}") for m in MODELS]            # three scalar subqueries
    pos = F.coalesce(F.col("posicao_id"), F.lit(4))
    x = (rows.join(wide, ["atleta_id", "rodada_alvo"], "left")
         .select("*", *covs)
         .withColumn("_pos", pos)
         .join(F.broadcast(selection.withColumnRenamed("posicao_id", "_pos")
                           .drop(*[f"cov_{SHORT[m]}" for m in MODELS])), "_pos", "left"))
    soma = None
    tot = None
    for m in MODELS:
        s = SHORT[m]
        ok = F.col(f"prev_{s}").isNotNull() & F.col(f"w_{s}").isNotNull()
        a = F.when(ok, F.col(f"prev_{s}") * F.col(f"w_{s}")).otherwise(0.0)
        b = F.when(ok, F.col(f"w_{s}")).otherwise(0.0)
        soma = a if soma is None else soma + a
        tot = b if tot is None else tot + b
    ens = F.greatest(F.when(tot > 0, soma / tot).otherwise(0.0), F.lit(0.0))
    chosen = None
    for m in MODELS:
        e = F.when(F.col("modelo") == m, F.col(f"prev_{SHORT[m]}"))
        chosen = e if chosen is None else F.coalesce(chosen, e)
    use_single = (F.col("modelo") != "ensemble") & chosen.isNotNull()
    covs_row = [F.col(f"mcov_{SHORT[m]}") for m in MODELS]
    n_cov = sum(F.when(c.isNotNull(), 1).otherwise(0) for c in covs_row)
    s_cov = sum(F.coalesce(c, F.lit(0.0)) for c in covs_row)
    return x.select(
        "atleta_id", "rodada_alvo", "posicao_id",
        *[F.col(f"prev_{SHORT[m]}") for m in MODELS],
        F.when(use_single, chosen).otherwise(ens).alias("pontuacao_prevista"),
        F.when(use_single, F.col("modelo")).otherwise(F.lit("ensemble")).alias("modelo_selecionado"),
        F.when(use_single, F.col("coverage_modelo"))
         .otherwise(F.when(n_cov > 0, s_cov / n_cov)).alias("coverage_score_modelo"),
    )


def final_ranked(final: DataFrame, athletes: DataFrame, positions: DataFrame,
                 clubs: DataFrame) -> DataFrame:
    """L16 (+J04, W04): dims, points per price and rank inside the position."""
    a = athletes.select("atleta_id", "apelido", "posicao_id", "clube_id", "preco_atual")
    po = F.broadcast(positions.select("posicao_id", F.col("abreviacao").alias("posicao")))
    c = clubs.select("clube_id", F.col("abreviacao").alias("clube"))
    j = (final.drop("posicao_id").join(a, "atleta_id").join(po, "posicao_id").join(c, "clube_id"))
    j = j.select(
        "atleta_id", "apelido", "posicao_id", "posicao", "clube", "rodada_alvo",
        "pontuacao_prevista", "modelo_selecionado", "coverage_score_modelo", "preco_atual",
        F.when(F.col("preco_atual") > 0, F.round(F.col("pontuacao_prevista") / F.col("preco_atual"), 2))
         .alias("pontos_por_cartoleta"))
    return rank_in_groups(j, ["rodada_alvo", "posicao_id"], "pontuacao_prevista", "ranking_posicao")


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int, salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each group (no global truncation first).

    Each group is dealt over ``salts`` tasks by a hash of the row; the last
    step ranks at most ``n * salts`` rows per group.
    """
    x = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    for w in (Window.partitionBy(group, "_salt"), Window.partitionBy(group)):
        x = x.withColumn("_rn", F.row_number().over(w.orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")
    return x.drop("_salt")


# ------------------------------------------------------------------ L06 / L07
#: Up to so many terms the CDF is summed from pmf(0) on; rows with more are searched by the
#: incomplete gamma and beta functions (``count_quantiles``).  Both are exact.
MAX_TERMS = 4096


def _quantiles(mean: Column, size: Column | None, var: Column, first: Column, probs) -> list[Column]:
    """Per probability the quantile of a row with mean, size (None: Poisson), variance and pmf(0).

    All rows of an Arrow batch are worked on together: no shuffle, and no term
    is interpreted row by row.
    """
    last = F.ceil(mean + 12 * F.sqrt(var) + 10)
    few = (last <= MAX_TERMS) & (mean <= 600)                   # pmf(0) does not vanish there
    args = [F.when(few, mean), F.when(few, first), F.when(few, last), F.when(~few, mean)]

    if size is None:
        def found(few_mean: pd.Series, first: pd.Series, last: pd.Series, mean: pd.Series) -> pd.DataFrame:
            return _found(probs, few_mean, first, last, mean, None)
    else:
        args.append(size)

        def found(few_mean: pd.Series, first: pd.Series, last: pd.Series, mean: pd.Series, size: pd.Series) -> pd.DataFrame:
            return _found(probs, few_mean, first, last, mean, size)
    kind = "struct<" + ",".join(f"n{i}:bigint" for i in range(len(probs))) + ">"
    got = F.pandas_udf(found, kind)(*args)
    return [got[f"n{i}"] for i in range(len(probs))]


def _found(probs, few_mean, first, last, mean, size):
    """Quantiles of the rows with either mean; the others get null."""
    out = pd.DataFrame({f"n{i}": pd.Series([pd.NA] * len(mean), dtype="Int64") for i in range(len(probs))})

    def some(column, rows):
        return None if column is None else column.to_numpy(float)[rows]

    few, many = few_mean.notna().to_numpy(), mean.notna().to_numpy()
    if few.any():
        counts = CQ.summed(probs, some(few_mean, few), some(size, few), some(first, few), some(last, few))
        for i, n in enumerate(counts):
            out.loc[few, f"n{i}"] = n
    if many.any():
        for i, p in enumerate(probs):
            out.loc[many, f"n{i}"] = CQ.quantile(p, some(mean, many), some(size, many))
    return out


def poisson_quantile(mu: Column, probs=(0.10, 0.90)) -> list[Column]:
    """Smallest k with Poisson(max(mu, 0.01)) CDF >= p, per row and at any mean."""
    m = F.greatest(mu, F.lit(0.01))
    return _quantiles(m, None, m, F.exp(-m), probs)


def negbin_quantile(mu: Column, r: Column, probs=(0.10, 0.90)) -> list[Column]:
    """Smallest k whose negative-binomial CDF (mean mu, size r) reaches p, per row and at any mean."""
    m = F.greatest(mu, F.lit(0.01))
    return _quantiles(m, r, m + m * m / r, F.exp(r * F.log(r / (r + m))), probs)


def _names(probs) -> list[str]:
    return [f"q{int(round(p * 100)):02d}" for p in probs]


def poisson_quantiles(mu: DataFrame, col: str = "mu", probs=(0.10, 0.90)) -> DataFrame:
    """L06 as a table: the quantiles of every distinct mean."""
    d = mu.select(F.col(col).alias("mu")).distinct()
    return with_poisson_interval(d, "mu", probs)


def with_poisson_interval(df: DataFrame, col: str, probs=(0.10, 0.90)) -> DataFrame:
    """Add the quantiles q10, q90 of a mean in the row."""
    return df.withColumns(dict(zip(_names(probs), poisson_quantile(F.col(col), probs), strict=True)))


# ------------------------------------------------------------------ L17 / L18
def inverse_error_weights(hist: DataFrame) -> DataFrame:
    """Per position, model weights proportional to 1 / RMSE."""
    m = error_metrics(hist, ["posicao_id", "modelo"])
    inv = F.when(F.col("rmse") > 0, 1 / F.col("rmse"))
    m = m.select("posicao_id", "modelo", inv.alias("_inv"))
    w = Window.partitionBy("posicao_id")
    return m.select("posicao_id", "modelo", (F.col("_inv") / F.sum("_inv").over(w)).alias("peso"))


def backtest(wide: DataFrame, window: int = COVERAGE_WINDOW, min_cov: float = COVERAGE_MIN,
             default_threshold: float = 3.0) -> DataFrame:
    """Walk-forward meta-model over every round after the first ``window``.

    ``wide``: one row per (athlete, round) with prev_xgb/prev_lgb/prev_poi,
    posicao_id and pontuacao_real.  For round r the coverage of each model
    and position is taken over rounds [max(1, r-window), r-1]; the selection
    follows the written spec (ties: xgboost, lightgbm, poisson; weights are
    coverage shares, all-zero -> equal thirds).  One pass: per (position,
    round) hit sums, a range window over rounds, then column arithmetic.
    """
    thr = threshold_for(F.col("posicao_id"), default=default_threshold)
    hist = wide.filter(F.col("pontuacao_real").isNotNull())
    per = hist.groupBy("posicao_id", "rodada_alvo").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(hit(F.col(f"prev_{SHORT[m]}"), F.col("pontuacao_real"), thr)).alias(f"_h_{SHORT[m]}")
          for m in MODELS])
    # every (position, round) to score, joined with its window sums
    targets = wide.select("posicao_id", "rodada_alvo").distinct()
    w = Window.partitionBy("posicao_id").orderBy("rodada_alvo").rangeBetween(-window, -1)
    allr = targets.join(per, ["posicao_id", "rodada_alvo"], "full_outer")
    allr = allr.select("posicao_id", "rodada_alvo",
                       F.sum("_n").over(w).alias("_wn"),
                       *[F.sum(f"_h_{SHORT[m]}").over(w).alias(f"_wh_{SHORT[m]}") for m in MODELS])
    cov = {m: F.coalesce(F.col(f"_wh_{SHORT[m]}") / F.col("_wn"), F.lit(0.0)) for m in MODELS}
    sel = allr.select("posicao_id", "rodada_alvo",
                      *[cov[m].alias(f"c_{SHORT[m]}") for m in MODELS])
    x = wide.filter(F.col("rodada_alvo") > window).join(sel, ["posicao_id", "rodada_alvo"])
    cx, cl, cp = F.col("c_xgb"), F.col("c_lgb"), F.col("c_poi")
    best = F.greatest(cx, cl, cp)
    tot = cx + cl + cp
    wx = F.when(tot == 0, 1 / 3.0).otherwise(cx / tot)
    wl = F.when(tot == 0, 1 / 3.0).otherwise(cl / tot)
    wp = F.when(tot == 0, 1 / 3.0).otherwise(cp / tot)
    px, pl, pp = F.col("prev_xgb"), F.col("prev_lgb"), F.col("prev_poi")

    def fmt(c):
        return F.format_string("%.2f", F.round(c, 2))
    label = F.concat(F.lit("ensemble("), fmt(wx), F.lit("/"), fmt(wl), F.lit("/"), fmt(wp), F.lit(")"))
    final = (F.when(best >= min_cov, F.when(cx == best, px).when(cl == best, pl).otherwise(pp))
             .otherwise(wx * px + wl * pl + wp * pp))
    model = (F.when(best >= min_cov, F.when(cx == best, "xgboost").when(cl == best, "lightgbm")
                    .otherwise("poisson")).otherwise(label))
    return x.select("atleta_id", "rodada_alvo", "posicao_id", "prev_xgb", "prev_lgb", "prev_poi",
                    final.alias("previsao_final"), model.alias("modelo_selecionado"), "pontuacao_real")


# ------------------------------------------------------------------ L08
def time_folds(df: DataFrame, col: str = "rodada_alvo", n_splits: int = 5) -> DataFrame:
    """Expanding-window folds over the ordered distinct rounds.

    With n distinct rounds and t = n // (n_splits + 1), fold i (1-based)
    tests rounds ranked (n - (n_splits - i + 1) t, n - (n_splits - i) t] and
    trains on every earlier round.  Only the distinct rounds are ranked (a
    tiny frame); the result is one row per (fold, round, role).
    """
    r = df.select(col).distinct()
    w = Window.orderBy(col)            # runs over the distinct rounds only
    r = r.select(col, F.row_number().over(w).alias("_i"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
    t = F.floor(F.col("_n") / (n_splits + 1))
    folds = r.select(col, "_i", "_n", t.alias("_t"),
                     F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold"))
    test_lo = F.col("_n") - (n_splits - F.col("fold") + 1) * F.col("_t")
    test_hi = F.col("_n") - (n_splits - F.col("fold")) * F.col("_t")
    role = (F.when((F.col("_i") > test_lo) & (F.col("_i") <= test_hi), "test")
            .when(F.col("_i") <= test_lo, "train"))
    return folds.select("fold", col, role.alias("papel")).filter(F.col("papel").isNotNull())


def merge_models(info: DataFrame, models: dict[str, DataFrame]) -> DataFrame:
    """Left-merge each model's output onto the rows to predict, with the
    model's short name as column suffix (prev_xgb, cov_xgb, ...).  Each model
    frame has one row per (athlete, round), so the chain of left joins on the
    same key never fans out."""
    out = info
    for name, df in models.items():
        s = SHORT.get(name, name)
        out = out.join(df.select("atleta_id", "rodada_alvo",
                                 F.col("pontuacao_prevista").alias(f"prev_{s}"),
                                 F.col("coverage_score").alias(f"cov_{s}")),
                       ["atleta_id", "rodada_alvo"], "left")
    return out
