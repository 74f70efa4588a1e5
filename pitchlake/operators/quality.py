"""Data-quality rules: each returns the violating rows or a small summary.

Row rules are plain filters (pushed to the scan); uniqueness is a
partially-aggregated ``groupBy``; foreign keys are ``left_anti`` joins.
``run_suite`` evaluates all row rules of a table in a single scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q01: rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols) -> DataFrame:
    """Q02/Q06: key values that occur more than once, with their count."""
    cols = _cols(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("qtd")).filter(F.col("qtd") > 1)


def accepted_values(df: DataFrame, col: str, values, where: str | Column | None = None) -> DataFrame:
    """Q03: rows whose value is outside the accepted set (NULLs pass)."""
    d = df if where is None else df.filter(where)
    return d.filter(~F.col(col).isin(list(values)))


def relationships(df: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose foreign key has no parent (NULL keys pass)."""
    p = parent.select(F.col(key).alias("_pk")).distinct()
    return df.filter(F.col(col).isNotNull()).join(p, F.col(col) == F.col("_pk"), "left_anti")


def expression_true(df: DataFrame, expr: str | Column) -> DataFrame:
    """Q05: rows where the predicate is false (NULL counts as a failure)."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return df.filter(~F.coalesce(e, F.lit(False)))


def in_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Q07: distinct values outside [lo, hi]."""
    return df.filter((F.col(col) < lo) | (F.col(col) > hi)).select(col).distinct()


def non_negative(df: DataFrame, cols, keep: list[str] | None = None) -> DataFrame:
    """Q08: rows with a negative value in any of ``cols`` (NULLs pass)."""
    cond = None
    for c in _cols(cols):
        x = F.col(c).isNotNull() & (F.col(c) < 0)
        cond = x if cond is None else (cond | x)
    out = df.filter(cond)
    return out.select(*(keep + _cols(cols))) if keep else out


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Q09: (rows passing every rule, one-row-per-rule drop counts).

    The counts are one aggregate of conditional sums over the same input.
    """
    conds = {name: F.coalesce(F.expr(r), F.lit(False)) for name, r in rules.items()}
    ok = None
    for c in conds.values():
        ok = c if ok is None else (ok & c)
    kept = df.filter(ok)
    agg = df.agg(*[F.sum(F.when(~c, 1).otherwise(0)).alias(n) for n, c in conds.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in conds)
    counts = agg.select(F.expr(f"stack({len(conds)}, {pairs}) as (regra, descartadas)"))
    return kept, counts


def freshness(df: DataFrame, ts: str, asof: str, warn_hours: float, error_hours: float) -> DataFrame:
    """Q10: one row: newest timestamp, its age at ``asof`` and the status."""
    a = F.lit(asof).cast("timestamp_ntz")
    g = df.agg(F.max(ts).alias("max_ts"),
               F.sum(F.when(F.col(ts) >= a - F.expr(f"INTERVAL {int(warn_hours)} HOURS"), 1)
                     .otherwise(0)).alias("linhas_recentes"))
    from pitchlake.functions.expressions import ntz_epoch_micros
    age = (ntz_epoch_micros(a) - ntz_epoch_micros(F.col("max_ts"))) / 3.6e9   # wall clock, no zone
    return g.select("max_ts", age.alias("idade_horas"), "linhas_recentes",
                    F.when(age > error_hours, "error").when(age > warn_hours, "warn")
                    .otherwise("pass").alias("status"))


def run_suite(df: DataFrame, row_rules: dict[str, str], unique_cols: list[str] | None = None,
              fk: tuple[str, DataFrame, str] | None = None) -> DataFrame:
    """Q11: failures per rule for one table.

    Row rules (``name -> predicate that must hold``) are counted in one
    aggregate; the uniqueness and foreign-key rules need their own
    group-by / anti-join and are appended as extra rows.
    """
    conds = {n: F.coalesce(F.expr(r), F.lit(False)) for n, r in row_rules.items()}
    agg = df.agg(*[F.sum(F.when(~c, 1).otherwise(0)).cast("long").alias(n) for n, c in conds.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in conds)
    out = agg.select(F.expr(f"stack({len(conds)}, {pairs}) as (regra, falhas)"))
    if unique_cols:
        u = unique(df, unique_cols).agg(F.coalesce(F.sum("qtd"), F.lit(0)).cast("long").alias("falhas"))
        out = out.unionByName(u.select(F.lit("unique_" + "_".join(unique_cols)).alias("regra"), "falhas"))
    if fk:
        col, parent, key = fk
        r = relationships(df, col, parent, key).agg(F.count(F.lit(1)).alias("falhas"))
        out = out.unionByName(r.select(F.lit(f"relationships_{col}").alias("regra"), "falhas"))
    return out


def text_digest(df: DataFrame, cols: list[str]):
    """Order-insensitive digest that any engine can compute: the sum, over rows, of the
    first 8 hex digits of the md5 of the columns' texts joined by ``|`` (null: empty)."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return df.agg(F.sum(F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")).alias("d")).scalar()


def validate_copy(a: DataFrame, b: DataFrame, digest_cols: list[str] | None = None) -> DataFrame:
    """Q12: row counts, column sets and an order-insensitive content hash.

    With ``digest_cols`` both sides' :func:`text_digest` is reported as well.
    """
    cols = sorted(a.columns)
    ha = a.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")).alias("h"))
    hb = b.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64(*[F.col(c) for c in sorted(b.columns)]).cast("decimal(38,0)")).alias("h"))
    nb, hb_ = hb.select("n").scalar(), hb.select("h").scalar()
    return ha.select(F.col("n").alias("linhas_origem"), nb.alias("linhas_copia"),
                     F.lit(sorted(a.columns) == sorted(b.columns)).alias("colunas_iguais"),
                     (F.col("n") == nb).alias("contagem_igual"),
                     F.col("h").eqNullSafe(hb_).alias("conteudo_igual"),
                     *([text_digest(a, digest_cols).alias("hash_origem"), text_digest(b, digest_cols).alias("hash_copia")]
                       if digest_cols else []))


# ----------------------------------------------------------------------------
# The column tests the reference declares on its models
# (model, column, test, argument).  accepted_values carries (values, where).
DECLARED_TESTS = (
    ("dim_clubes", "clube_id", "unique", None),
    ("dim_clubes", "clube_id", "not_null", None),
    ("dim_clubes", "nome", "not_null", None),
    ("dim_clubes", "abreviacao", "not_null", None),
    ("dim_posicoes", "posicao_id", "unique", None),
    ("dim_posicoes", "posicao_id", "not_null", None),
    ("dim_posicoes", "abreviacao", "accepted_values", (("GOL", "LAT", "ZAG", "MEI", "ATA", "TEC"), None)),
    ("dim_atletas", "atleta_id", "unique", None),
    ("dim_atletas", "atleta_id", "not_null", None),
    ("dim_atletas", "posicao_id", "not_null", None),
    ("dim_atletas", "posicao_id", "relationships", ("dim_posicoes", "posicao_id")),
    ("dim_atletas", "clube_id", "not_null", None),
    ("dim_atletas", "clube_id", "relationships", ("dim_clubes", "clube_id")),
    ("dim_atletas", "status_id", "accepted_values", ((2, 3, 5, 6, 7), None)),
    ("dim_rodadas", "rodada_id", "unique", None),
    ("dim_rodadas", "rodada_id", "not_null", None),
    ("dim_rodadas", "data_inicio", "not_null", None),
    ("fct_atletas_rodada", "atleta_id", "not_null", None),
    ("fct_atletas_rodada", "rodada_id", "not_null", None),
    ("fct_atletas_rodada", "posicao_id", "relationships", ("dim_posicoes", "posicao_id")),
    ("fct_atletas_rodada", "clube_id", "relationships", ("dim_clubes", "clube_id")),
    ("fct_partidas", "partida_id", "unique", None),
    ("fct_partidas", "partida_id", "not_null", None),
    ("fct_partidas", "rodada_id", "not_null", None),
    ("fct_partidas", "resultado_mandante", "accepted_values", (("V", "E", "D"), "placar_mandante is not null")),
    ("fct_mercado_status", "rodada_atual", "not_null", None),
    ("fct_mercado_status", "status_descricao", "accepted_values",
     (("Aberto", "Fechado", "Em Manutenção", "Fim de Rodada", "Desconhecido"), None)),
    ("fct_destaques_rodada", "rodada_id", "not_null", None),
    ("metricas_atleta_acumulado", "atleta_id", "unique", None),
    ("metricas_atleta_acumulado", "atleta_id", "not_null", None),
    ("metricas_atleta_acumulado", "tendencia_pontos", "accepted_values", (("subindo", "estavel", "caindo"), None)),
    ("tabela_liga", "clube_id", "not_null", None),
    ("tabela_liga", "rodada_id", "not_null", None),
    ("tabela_liga", "posicao", "not_null", None),
    ("tabela_liga", "aproveitamento_percentual", "expression_is_true", "between 0 and 100"),
    ("metricas_clube_rodada", "clube_id", "not_null", None),
    ("metricas_clube_rodada", "rodada_id", "not_null", None),
    ("feature_store_previsao", "atleta_id", "not_null", None),
    ("feature_store_previsao", "rodada_alvo", "not_null", None),
    ("feature_store_previsao", "mando_campo", "accepted_values", (("casa", "fora"), "mando_campo is not null")),
    ("previsao_final", "atleta_id", "not_null", None),
    ("previsao_final", "rodada_alvo", "not_null", None),
    ("previsao_final", "pontuacao_prevista", "expression_is_true", ">= 0"),
    ("previsao_final", "modelo_selecionado", "accepted_values", (("xgboost", "lightgbm", "poisson", "ensemble"), None)),
)
# The reference's singular tests: (name, model, predicate of a failing row or
# the columns that must be unique together).
SINGULAR_TESTS = (
    ("assert_atleta_unicidade", "fct_atletas_rodada", ("unique", ("atleta_id", "rodada_id"))),
    ("assert_placar_nao_negativo", "fct_partidas",
     ("fails_when", "(placar_mandante is not null and placar_mandante < 0) "
                    "or (placar_visitante is not null and placar_visitante < 0)")),
    ("assert_rodada_range", "fct_atletas_rodada", ("distinct_fails_when", "rodada_id", "rodada_id < 1 or rodada_id > 38")),
)
# ----------------------------------------------------------------------------


def run_declared_tests(models: dict[str, DataFrame], tests=DECLARED_TESTS,
                       singular=SINGULAR_TESTS) -> DataFrame:
    """Q11: every declared test of every model -> (modelo, coluna, teste, falhas).

    Per model, all row-level tests (not_null, accepted_values,
    expression_is_true) are one aggregate of conditional counts -- one scan;
    unique is a partially aggregated group-by and relationships an anti-join.
    """
    out = []
    by_model: dict[str, list] = {}
    for m, c, t, arg in tests:
        by_model.setdefault(m, []).append((c, t, arg))
    for m, ts in by_model.items():
        df = models[m]
        row_aggs, names = [], []
        for i, (c, t, arg) in enumerate(ts):
            if t == "not_null":
                fail = F.col(c).isNull()
            elif t == "accepted_values":
                vals, where = arg
                fail = ~F.coalesce(F.col(c).isin(list(vals)), F.lit(False)) & F.col(c).isNotNull()
                if where:
                    fail = fail & F.coalesce(F.expr(where), F.lit(False))
            elif t == "expression_is_true":
                fail = ~F.coalesce(F.expr(f"`{c}` {arg}"), F.lit(True))
            else:
                continue
            row_aggs.append(F.count(F.when(fail, 1)).alias(f"t{i}"))
            names.append((i, c, t))
        if row_aggs:
            a = df.agg(*row_aggs)
            pairs = ", ".join(f"'{c}', '{t}', t{i}" for i, c, t in names)
            out.append(a.select(F.expr(f"stack({len(names)}, {pairs}) as (coluna, teste, falhas)"))
                       .select(F.lit(m).alias("modelo"), "coluna", "teste", "falhas"))
        for c, t, arg in ts:
            if t == "unique":      # failures = duplicated values
                u = unique(df.filter(F.col(c).isNotNull()), c).agg(F.count(F.lit(1)).alias("falhas"))
            elif t == "relationships":
                parent, key = arg
                u = relationships(df, c, models[parent], key).agg(F.count(F.lit(1)).alias("falhas"))
            else:
                continue
            out.append(u.select(F.lit(m).alias("modelo"), F.lit(c).alias("coluna"), F.lit(t).alias("teste"),
                                "falhas"))
    for name, m, spec in singular:
        df = models[m]
        if spec[0] == "unique":
            u = unique(df, list(spec[1])).agg(F.count(F.lit(1)).alias("falhas"))
        elif spec[0] == "fails_when":
            u = df.agg(F.count(F.when(F.expr(spec[1]), 1)).alias("falhas"))
        else:
            u = df.filter(F.expr(spec[2])).select(spec[1]).distinct().agg(F.count(F.lit(1)).alias("falhas"))
        out.append(u.select(F.lit(m).alias("modelo"), F.lit("*").alias("coluna"), F.lit(name).alias("teste"),
                            "falhas"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
