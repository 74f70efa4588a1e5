"""Oracle SQL for pitchlake.plans.q_ml (the design matrix; model fits are rows-only)."""

from pitchlake.oracle.bindings_sql import _cte
from pitchlake.operators import models as MD
from pitchlake.operators.glm import ALPHA, L1
from pitchlake.operators.search import FOLDS, SPACE, TRIALS
from pitchlake.oracle.queries_sql import oracle

_cte("tf_base", """
SELECT atleta_id, rodada_id, clube_id, posicao_id, pontos_num,
       round(sum(CASE WHEN entrou_em_campo THEN pontos_num END) OVER prev, 2)
           / count(CASE WHEN entrou_em_campo THEN pontos_num END) OVER prev AS media_pontos_geral,
       round(sum(pontos_num) OVER w5, 2) / count(pontos_num) OVER w5 AS media_ultimas_5,
       round(sum(pontos_num) OVER w3, 2) / count(pontos_num) OVER w3 AS media_ultimas_3,
       stddev_samp(CASE WHEN entrou_em_campo THEN pontos_num END) OVER prev AS desvio_padrao_pontos,
       count(CASE WHEN entrou_em_campo THEN pontos_num END) OVER prev AS total_jogos,
       avg(CAST(entrou_em_campo AS INTEGER)) OVER prev AS aproveitamento_campo,
       lag(preco_num) OVER w AS preco_atual,
       lag(variacao_num) OVER w AS variacao_preco
FROM fct
WINDOW w AS (PARTITION BY atleta_id ORDER BY rodada_id),
       prev AS (PARTITION BY atleta_id ORDER BY rodada_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       w5 AS (PARTITION BY atleta_id ORDER BY rodada_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
       w3 AS (PARTITION BY atleta_id ORDER BY rodada_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""", "fct")

_cte("tf_opp", """
SELECT clube_id, rodada_id, mando_campo, adversario_id
FROM (SELECT *, row_number() OVER (PARTITION BY clube_id, rodada_id ORDER BY partida_id) AS rn
      FROM (SELECT partida_id, rodada_id, clube_casa_id AS clube_id, 'casa' AS mando_campo,
                   clube_visitante_id AS adversario_id FROM fct_partidas
            UNION ALL
            SELECT partida_id, rodada_id, clube_visitante_id, 'fora', clube_casa_id FROM fct_partidas))
WHERE rn = 1""", "fct_partidas")

_cte("training", """
SELECT b.atleta_id, b.rodada_id AS rodada_alvo, b.clube_id, b.posicao_id, b.media_pontos_geral,
       b.media_ultimas_5, b.media_ultimas_3, b.desvio_padrao_pontos,
       CASE WHEN b.media_pontos_geral > 0 THEN 1 - coalesce(b.desvio_padrao_pontos, 0) / b.media_pontos_geral
            ELSE 0 END AS consistencia_score,
       b.total_jogos, b.aproveitamento_campo, b.preco_atual, b.variacao_preco,
       t1.posicao AS clube_posicao_tabela, t1.aproveitamento_percentual AS clube_aproveitamento,
       o.adversario_id, t2.posicao AS adversario_posicao_tabela, o.mando_campo,
       d.lo IS NOT NULL AS eh_classico,
       CASE WHEN b.rodada_id = (SELECT max(rodada_id) FROM fct) THEN NULL ELSE b.pontos_num END AS pontuacao_real
FROM tf_base b
LEFT JOIN tf_opp o ON b.clube_id = o.clube_id AND b.rodada_id = o.rodada_id
LEFT JOIN tabela t1 ON b.clube_id = t1.clube_id AND b.rodada_id = t1.rodada_id + 1
LEFT JOIN tabela t2 ON o.adversario_id = t2.clube_id AND b.rodada_id = t2.rodada_id + 1
LEFT JOIN fs_derby d ON least(b.clube_id, o.adversario_id) = d.lo AND greatest(b.clube_id, o.adversario_id) = d.hi""",
     "tf_base", "tf_opp", "tabela", "fs_derby", "fct")

_FEATS = ("media_pontos_geral", "media_ultimas_5", "media_ultimas_3", "desvio_padrao_pontos",
          "consistencia_score", "total_jogos", "aproveitamento_campo", "preco_atual", "variacao_preco",
          "clube_posicao_tabela", "clube_aproveitamento", "adversario_posicao_tabela", "posicao_id")

oracle("l02_design_matrix", "SELECT atleta_id, rodada_alvo, mando_campo, pontuacao_real, "
       + ", ".join(f"coalesce(CAST({c} AS DOUBLE), CAST(0 AS DOUBLE)) AS {c}" for c in _FEATS)
       + ", CAST(CASE WHEN mando_campo = 'casa' THEN 1 ELSE 0 END AS DOUBLE) AS mando_casa"
       + ", CAST(coalesce(CAST(eh_classico AS INTEGER), 0) AS DOUBLE) AS classico FROM training",
       "training", doubles=_FEATS + ("pontuacao_real", "mando_casa", "classico"))

# every seeded draw as an md5, and the expanding folds over the ordered rounds
_U = "((('0x' || substr(md5('l09/' || t || '/{}'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"


def _drawn(name: str) -> str:
    kind, lo, hi = SPACE[name]
    u = _U.format(name)
    if kind == "log":
        return f"round(exp(ln({lo}::DOUBLE) + {u} * (ln({hi}::DOUBLE) - ln({lo}::DOUBLE))), 6) AS {name}"
    if kind == "int":
        return f"floor({lo} + {u} * {hi - lo} + 0.5)::INT AS {name}"
    return f"round({lo}::DOUBLE + {u} * ({hi}::DOUBLE - {lo}::DOUBLE), 6) AS {name}"


oracle("l09_trial_plan", f"""
SELECT fold, n_train::BIGINT AS n_train, n_valid::BIGINT AS n_valid, t::INT AS trial, {', '.join(map(_drawn, SPACE))}
FROM (SELECT f.fold::INT AS fold, sum(CASE WHEN i <= n - ({FOLDS} - f.fold + 1) * (n // {FOLDS + 1}) THEN k ELSE 0 END) AS n_train,
             sum(CASE WHEN i > n - ({FOLDS} - f.fold + 1) * (n // {FOLDS + 1}) AND i <= n - ({FOLDS} - f.fold) * (n // {FOLDS + 1}) THEN k ELSE 0 END) AS n_valid
      FROM (SELECT rodada_alvo, count(*) AS k, row_number() OVER (ORDER BY rodada_alvo) AS i, count(*) OVER () AS n
            FROM training WHERE pontuacao_real IS NOT NULL GROUP BY rodada_alvo) r, range(1, {FOLDS + 1}) f(fold)
      GROUP BY f.fold), range({TRIALS}) t(t)""", "training")

# The same convex problem solved in SQL.  One recursion step sums gradient and weighted normal equations over all
# training rows; the lambda sweeps the coordinates of the penalised quadratic model.
_COLS = MD.POISSON_COLS
_P = len(_COLS) + 1
_L1, _L2 = ALPHA * L1, ALPHA * (1 - L1)
_SWEEPS, _STEPS = 400, 14
_INPUT = {c: f"coalesce(t.{c}::DOUBLE, 0)" for c in _COLS} | {
    "prior_media": "coalesce(prior_media, 0)", "mando_casa": "(CASE WHEN mando_campo = 'casa' THEN 1 ELSE 0 END)::DOUBLE",
    "classico": "coalesce(eh_classico::INT, 0)::DOUBLE"} | {
    f"pos_{k}": f"coalesce((t.posicao_id = {k})::INT, 0)::DOUBLE" for k in range(2, 7)}
_SUMS = ", ".join([f"sum((mu - y) * x[{i}]) / count(*) AS g{i}" for i in range(1, _P + 1)]
                  + [f"sum(mu * x[{i}] * x[{j}]) / count(*) AS h{i}_{j}" for i in range(1, _P + 1) for j in range(1, i + 1)])
_G = "[" + ", ".join(f"g{i}" for i in range(1, _P + 1)) + "]"
_H = "[" + ", ".join("[" + ", ".join(f"h{max(i, j)}_{min(i, j)}" for j in range(1, _P + 1)) + "]" for i in range(1, _P + 1)) + "]"
_Q = "(g[i] + list_dot_product(h[i], list_transform(acc, lambda v, k: v - b[k])))"
_SWEEP = f"""list_reduce(list_concat([b], sweeps), lambda acc, e: list_transform(acc, lambda v, i: CASE WHEN i <> e[1]::BIGINT THEN v
  ELSE sign(h[i][i] * v - {_Q}) * greatest(0, abs(h[i][i] * v - {_Q}) - {_L1}) / (h[i][i] + {_L2}) END))"""

_cte("glm_rows", f"""
SELECT t.atleta_id, t.rodada_alvo, t.pontuacao_real, [1::DOUBLE, {', '.join(_INPUT[c] for c in _COLS)}] AS x
FROM training t LEFT JOIN (SELECT posicao_id, avg(pontuacao_real) AS prior_media FROM training GROUP BY posicao_id) p
  ON t.posicao_id = p.posicao_id""", "training")
_cte("glm_train", "SELECT x, greatest(pontuacao_real, 0)::DOUBLE AS y FROM glm_rows WHERE pontuacao_real IS NOT NULL", "glm_rows")
_cte("glm_steps", f"""
SELECT 0 AS k, list_concat([ln((SELECT avg(y) FROM glm_train))], list_transform(range({_P - 1}), lambda i: 0::DOUBLE)) AS b
UNION ALL
SELECT k + 1, {_SWEEP}
FROM (SELECT k, b, {_G} AS g, {_H} AS h,
             flatten(list_transform(range({_SWEEPS}), lambda s: list_transform(range(1, {_P + 1}), lambda j: [j::DOUBLE]))) AS sweeps
      FROM (SELECT k, any_value(b) AS b, {_SUMS}
            FROM (SELECT k, b, x, y, exp(list_dot_product(b, x)) AS mu FROM glm_steps, glm_train WHERE k < {_STEPS}) GROUP BY k))""",
     "glm_train")
_cte("glm_fit", f"SELECT b FROM glm_steps WHERE k = {_STEPS}", "glm_steps")

oracle("l05_glm_coefficients", f"SELECT unnest({['const', *_COLS]}) AS feature, unnest(b) AS coef, true AS optimal FROM glm_fit",
       "glm_fit", doubles=("coef",))

oracle("l05_poisson_glm", """
SELECT s.atleta_id, s.rodada_alvo, mu AS pontuacao_prevista, q10 AS intervalo_credibilidade_inferior, q90 AS intervalo_credibilidade_superior
FROM glm_scored s JOIN (
  SELECT atleta_id, rodada_alvo, min(k) FILTER (cdf >= 0.1)::BIGINT AS q10, min(k) FILTER (cdf >= 0.9)::BIGINT AS q90
  FROM (SELECT atleta_id, rodada_alvo, k, sum(exp(k * ln(m) - m - lgamma(k + 1))) OVER (PARTITION BY atleta_id, rodada_alvo ORDER BY k) AS cdf
        FROM (SELECT *, greatest(mu, 0.01) AS m, unnest(range(0, (mu + 12 * sqrt(mu) + 20)::BIGINT)) AS k FROM glm_scored))
  GROUP BY ALL) q ON q.atleta_id = s.atleta_id AND q.rodada_alvo = s.rodada_alvo""", "glm_fit", "glm_rows", doubles=("pontuacao_prevista",), extra=[
    ("glm_scored", "SELECT atleta_id, rodada_alvo, exp(list_dot_product(b, x)) AS mu FROM glm_rows, glm_fit WHERE pontuacao_real IS NULL")])

# the refreshed training table equals a full build on the final inputs
oracle("m03_incremental_dag", """
SELECT atleta_id, rodada_alvo, clube_id, posicao_id, media_pontos_geral, media_ultimas_5, media_ultimas_3, desvio_padrao_pontos,
       consistencia_score, total_jogos, aproveitamento_campo, preco_atual, variacao_preco, clube_posicao_tabela, clube_aproveitamento,
       adversario_id, adversario_posicao_tabela, mando_campo, eh_classico, pontuacao_real FROM training""", "training",
       doubles=("media_pontos_geral", "media_ultimas_5", "media_ultimas_3", "desvio_padrao_pontos", "consistencia_score",
                "aproveitamento_campo", "preco_atual", "variacao_preco", "clube_aproveitamento", "pontuacao_real"))
