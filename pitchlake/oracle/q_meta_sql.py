"""Oracle SQL for pitchlake.plans.q_meta."""

from pitchlake.oracle.bindings_sql import _cte, sround
from pitchlake.oracle.queries_sql import oracle

THR = ("CASE posicao_id WHEN 1 THEN 2.0 WHEN 2 THEN 2.5 WHEN 3 THEN 2.5 WHEN 4 THEN 3.0 "
       "WHEN 5 THEN 3.5 WHEN 6 THEN 2.0 ELSE {d} END")
THR25 = THR.format(d="2.5")
THR30 = THR.format(d="3.0")


def hit(pred: str, real: str, thr: str = THR25) -> str:
    return f"CASE WHEN abs({pred} - {real}) <= {thr} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


_cte("mp_real", """
SELECT atleta_id, rodada_alvo, posicao_id, pontuacao_real FROM mp_wide WHERE pontuacao_real IS NOT NULL""",
     "mp_wide")
_cte("hist", """
SELECT p.atleta_id, p.rodada_alvo, p.pontuacao_prevista, r.pontuacao_real, r.posicao_id, p.modelo
FROM (SELECT atleta_id, rodada_alvo, pontuacao_prevista, modelo FROM mp) p
JOIN mp_real r ON p.atleta_id = r.atleta_id AND p.rodada_alvo = r.rodada_alvo""", "mp", "mp_real")
_cte("cov_pos", f"""
SELECT modelo, posicao_id, avg({hit('pontuacao_prevista', 'pontuacao_real')}) AS coverage, count(*) AS n
FROM hist WHERE rodada_alvo >= (SELECT max(rodada_alvo) FROM hist) - 2
GROUP BY modelo, posicao_id""", "hist")
_cte("model_cov", f"""
SELECT modelo, avg({hit('pontuacao_prevista', 'pontuacao_real')}) AS coverage_score
FROM hist GROUP BY modelo""", "hist")
_cte("sel_g", """
SELECT posicao_id, first(modelo ORDER BY coverage DESC, modelo) AS best_m, max(coverage) AS best_cov,
       sum(coverage) AS tot, count(*) AS k,
       max(CASE WHEN modelo = 'xgboost' THEN coverage END) AS cov_xgb,
       max(CASE WHEN modelo = 'lightgbm' THEN coverage END) AS cov_lgb,
       max(CASE WHEN modelo = 'poisson' THEN coverage END) AS cov_poi
FROM cov_pos GROUP BY posicao_id""", "cov_pos")


def _w(m: str, short: str) -> str:
    return (f"CASE WHEN g.posicao_id IS NULL THEN CAST(1 AS DOUBLE) / 3 "
            f"WHEN g.best_cov >= 0.7 THEN (CASE WHEN g.best_m = '{m}' THEN CAST(1 AS DOUBLE) END) "
            f"WHEN g.tot = 0 THEN (CASE WHEN g.cov_{short} IS NOT NULL THEN CAST(1 AS DOUBLE) / g.k END) "
            f"ELSE g.cov_{short} / g.tot END AS w_{short}")


_cte("selection", f"""
SELECT s.posicao_id,
       CASE WHEN g.posicao_id IS NOT NULL AND g.best_cov >= 0.7 THEN g.best_m ELSE 'ensemble' END AS modelo,
       CASE WHEN g.posicao_id IS NOT NULL AND g.best_cov >= 0.7 THEN g.best_cov END AS coverage_modelo,
       {_w('xgboost', 'xgb')}, {_w('lightgbm', 'lgb')}, {_w('poisson', 'poi')},
       g.cov_xgb, g.cov_lgb, g.cov_poi
FROM positions_seed s LEFT JOIN sel_g g ON s.posicao_id = g.posicao_id""", "positions_seed", "sel_g")

_cte("nxt", "SELECT atleta_id, rodada_alvo, posicao_id FROM mp_wide WHERE pontuacao_real IS NULL", "mp_wide")
_cte("mcov", """
SELECT max(CASE WHEN modelo = 'xgboost' THEN coverage_score END) AS mcov_xgb,
       max(CASE WHEN modelo = 'lightgbm' THEN coverage_score END) AS mcov_lgb,
       max(CASE WHEN modelo = 'poisson' THEN coverage_score END) AS mcov_poi
FROM model_cov""", "model_cov")


def _term(s: str, what: str) -> str:
    cond = f"x.prev_{s} IS NOT NULL AND x.w_{s} IS NOT NULL"
    val = f"x.prev_{s} * x.w_{s}" if what == "soma" else f"x.w_{s}"
    return f"CASE WHEN {cond} THEN {val} ELSE CAST(0 AS DOUBLE) END"


_SOMA = " + ".join(_term(s, "soma") for s in ("xgb", "lgb", "poi"))
_TOT = " + ".join(_term(s, "tot") for s in ("xgb", "lgb", "poi"))
_CHOSEN = ("coalesce(CASE WHEN x.modelo = 'xgboost' THEN x.prev_xgb END, "
           "CASE WHEN x.modelo = 'lightgbm' THEN x.prev_lgb END, "
           "CASE WHEN x.modelo = 'poisson' THEN x.prev_poi END)")
_NCOV = " + ".join(f"CASE WHEN x.mcov_{s} IS NOT NULL THEN 1 ELSE 0 END" for s in ("xgb", "lgb", "poi"))
_SCOV = "0 + " + " + ".join(f"coalesce(x.mcov_{s}, CAST(0 AS DOUBLE))" for s in ("xgb", "lgb", "poi"))

_cte("ens_x", """
SELECT n.atleta_id, n.rodada_alvo, n.posicao_id,
       w.p_xgboost AS prev_xgb, w.p_lightgbm AS prev_lgb, w.p_poisson AS prev_poi,
       mc.mcov_xgb, mc.mcov_lgb, mc.mcov_poi,
       s.modelo, s.coverage_modelo, s.w_xgb, s.w_lgb, s.w_poi
FROM nxt n
LEFT JOIN mp_wide w ON n.atleta_id = w.atleta_id AND n.rodada_alvo = w.rodada_alvo
CROSS JOIN mcov mc
LEFT JOIN selection s ON coalesce(n.posicao_id, 4) = s.posicao_id""", "nxt", "mp_wide", "mcov", "selection")

_cte("ens", f"""
SELECT x.atleta_id, x.rodada_alvo, x.posicao_id, x.prev_xgb, x.prev_lgb, x.prev_poi,
       CASE WHEN x.modelo <> 'ensemble' AND {_CHOSEN} IS NOT NULL THEN {_CHOSEN}
            ELSE greatest(CASE WHEN ({_TOT}) > 0 THEN ({_SOMA}) / ({_TOT}) ELSE CAST(0 AS DOUBLE) END,
                          CAST(0 AS DOUBLE)) END AS pontuacao_prevista,
       CASE WHEN x.modelo <> 'ensemble' AND {_CHOSEN} IS NOT NULL THEN x.modelo ELSE 'ensemble' END
           AS modelo_selecionado,
       CASE WHEN x.modelo <> 'ensemble' AND {_CHOSEN} IS NOT NULL THEN x.coverage_modelo
            ELSE (CASE WHEN ({_NCOV}) > 0 THEN ({_SCOV}) / ({_NCOV}) END) END AS coverage_score_modelo
FROM ens_x x""", "ens_x")

_cte("ranked", f"""
SELECT f.atleta_id, a.apelido, a.posicao_id, po.abreviacao AS posicao, c.abreviacao AS clube,
       f.rodada_alvo, f.pontuacao_prevista, f.modelo_selecionado, f.coverage_score_modelo, a.preco_atual,
       CASE WHEN a.preco_atual > 0 THEN {sround("f.pontuacao_prevista / a.preco_atual", 2)} END AS pontos_por_cartoleta,
       CAST(rank() OVER (PARTITION BY f.rodada_alvo, a.posicao_id ORDER BY f.pontuacao_prevista DESC) AS INTEGER)
           AS ranking_posicao
FROM ens f
JOIN metricas_atleta a ON f.atleta_id = a.atleta_id
JOIN positions_seed po ON a.posicao_id = po.posicao_id
JOIN cl c ON a.clube_id = c.clube_id""", "ens", "metricas_atleta", "positions_seed", "cl")


def pq_sql(src: str) -> str:
    """Poisson 10 % / 90 % quantiles for each distinct mu of ``src``."""
    return f"""
SELECT mu, CAST(min(CASE WHEN cdf >= 0.1 THEN k END) AS BIGINT) AS q10,
       CAST(min(CASE WHEN cdf >= 0.9 THEN k END) AS BIGINT) AS q90
FROM (SELECT mu, k, sum(exp(-m + k * ln(m) - lgamma(k + 1))) OVER (
             PARTITION BY mu ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cdf
      FROM (SELECT mu, m, unnest(generate_series(0, CAST(ceil(m + 10 * sqrt(m) + 10) AS BIGINT))) AS k
            FROM (SELECT mu, greatest(mu, 0.01) AS m FROM (SELECT DISTINCT mu FROM {src}))))
GROUP BY mu"""


_cte("poi_tab", "SELECT atleta_id, rodada_alvo, pontuacao_prevista FROM mp WHERE modelo = 'poisson'", "mp")
_cte("pq", pq_sql("(SELECT pontuacao_prevista AS mu FROM poi_tab)"), "poi_tab")

_cte("bt_wide", """
SELECT atleta_id, rodada_alvo, posicao_id, pontuacao_real,
       p_xgboost AS prev_xgb, p_lightgbm AS prev_lgb, p_poisson AS prev_poi
FROM mp_wide WHERE p_xgboost IS NOT NULL AND p_lightgbm IS NOT NULL AND p_poisson IS NOT NULL""", "mp_wide")
_cte("bt_per", f"""
SELECT posicao_id, rodada_alvo, count(*) AS n,
       sum({hit('prev_xgb', 'pontuacao_real', THR30)}) AS hx,
       sum({hit('prev_lgb', 'pontuacao_real', THR30)}) AS hl,
       sum({hit('prev_poi', 'pontuacao_real', THR30)}) AS hp
FROM bt_wide WHERE pontuacao_real IS NOT NULL GROUP BY posicao_id, rodada_alvo""", "bt_wide")
_cte("bt_cov", """
SELECT posicao_id, rodada_alvo,
       coalesce(sum(hx) OVER w / sum(n) OVER w, CAST(0 AS DOUBLE)) AS c_xgb,
       coalesce(sum(hl) OVER w / sum(n) OVER w, CAST(0 AS DOUBLE)) AS c_lgb,
       coalesce(sum(hp) OVER w / sum(n) OVER w, CAST(0 AS DOUBLE)) AS c_poi
FROM (SELECT coalesce(t.posicao_id, p.posicao_id) AS posicao_id,
             coalesce(t.rodada_alvo, p.rodada_alvo) AS rodada_alvo, p.n, p.hx, p.hl, p.hp
      FROM (SELECT DISTINCT posicao_id, rodada_alvo FROM bt_wide) t
      FULL OUTER JOIN bt_per p ON t.posicao_id = p.posicao_id AND t.rodada_alvo = p.rodada_alvo)
WINDOW w AS (PARTITION BY posicao_id ORDER BY rodada_alvo RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
     "bt_wide", "bt_per")
_cte("backtest", f"""
SELECT atleta_id, rodada_alvo, posicao_id, prev_xgb, prev_lgb, prev_poi,
       CASE WHEN best >= 0.7 THEN CASE WHEN c_xgb = best THEN prev_xgb WHEN c_lgb = best THEN prev_lgb
                                       ELSE prev_poi END
            ELSE wx * prev_xgb + wl * prev_lgb + wp * prev_poi END AS previsao_final,
       CASE WHEN best >= 0.7 THEN CASE WHEN c_xgb = best THEN 'xgboost' WHEN c_lgb = best THEN 'lightgbm'
                                       ELSE 'poisson' END
            ELSE 'ensemble(' || printf('%.2f', {sround('wx', 2)}) || '/' || printf('%.2f', {sround('wl', 2)}) || '/'
                 || printf('%.2f', {sround('wp', 2)}) || ')' END AS modelo_selecionado,
       pontuacao_real
FROM (SELECT *, CASE WHEN tot = 0 THEN CAST(1 AS DOUBLE) / 3 ELSE c_xgb / tot END AS wx,
                CASE WHEN tot = 0 THEN CAST(1 AS DOUBLE) / 3 ELSE c_lgb / tot END AS wl,
                CASE WHEN tot = 0 THEN CAST(1 AS DOUBLE) / 3 ELSE c_poi / tot END AS wp
      FROM (SELECT b.*, c.c_xgb, c.c_lgb, c.c_poi, greatest(c.c_xgb, c.c_lgb, c.c_poi) AS best,
                   c.c_xgb + c.c_lgb + c.c_poi AS tot
            FROM bt_wide b JOIN bt_cov c ON b.posicao_id = c.posicao_id AND b.rodada_alvo = c.rodada_alvo
            WHERE b.rodada_alvo > 3))""", "bt_wide", "bt_cov")

HIST_D = ("pontuacao_prevista", "pontuacao_real")
oracle("j11_history_inner", "SELECT * FROM hist", "hist", doubles=HIST_D)

oracle("u02_label_concat", """
SELECT atleta_id, rodada_alvo, pontuacao_prevista, 'xgboost' AS modelo,
       CAST(NULL AS BIGINT) AS intervalo_credibilidade_inferior, CAST(NULL AS BIGINT) AS intervalo_credibilidade_superior
FROM mp WHERE modelo = 'xgboost'
UNION ALL
SELECT atleta_id, rodada_alvo, pontuacao_prevista, 'lightgbm', NULL, NULL FROM mp WHERE modelo = 'lightgbm'
UNION ALL
SELECT t.atleta_id, t.rodada_alvo, t.pontuacao_prevista, 'poisson', q.q10, q.q90
FROM poi_tab t LEFT JOIN pq q ON t.pontuacao_prevista = q.mu""", "mp", "poi_tab", "pq",
       doubles=("pontuacao_prevista",))

oracle("a10_position_priors", """
SELECT posicao_id, round(sum(pontuacao_real), 5) / count(pontuacao_real) AS prior_media,
       stddev_samp(pontuacao_real) AS prior_std
FROM mp_real GROUP BY posicao_id""", "mp_real", doubles=("prior_media", "prior_std"))
oracle("a11_coverage_macro", "SELECT * FROM model_cov", "model_cov", doubles=("coverage_score",))
oracle("a12_coverage_by_position", "SELECT * FROM cov_pos", "cov_pos", doubles=("coverage",))
oracle("a13_interval_coverage", """
SELECT avg(CASE WHEN h.pontuacao_real >= q.q10 AND h.pontuacao_real <= q.q90 THEN CAST(1 AS DOUBLE)
                ELSE CAST(0 AS DOUBLE) END) AS coverage_intervalo, count(*) AS n
FROM (SELECT * FROM hist WHERE modelo = 'poisson') h
JOIN (""" + pq_sql("(SELECT pontuacao_prevista AS mu FROM hist WHERE modelo = 'poisson')") + """) q
  ON h.pontuacao_prevista = q.mu""", "hist", doubles=("coverage_intervalo",))

ERR_SQL = """
SELECT {by}, n, sqrt(sse / n) AS rmse, mae,
       CASE WHEN s2 - n * mean * mean > 0 THEN 1 - sse / (s2 - n * mean * mean) END AS r2
FROM (SELECT {by}, count(*) AS n,
             sum((pontuacao_prevista - pontuacao_real) * (pontuacao_prevista - pontuacao_real)) AS sse,
             avg(abs(pontuacao_prevista - pontuacao_real)) AS mae, avg(pontuacao_real) AS mean,
             sum(pontuacao_real * pontuacao_real) AS s2
      FROM hist GROUP BY {by})"""
oracle("a14_error_metrics", ERR_SQL.format(by="modelo"), "hist", doubles=("rmse", "mae", "r2"))

oracle("a15_coverage_pivot", f"""
SELECT posicao_id,
       {sround("max(CASE WHEN modelo = 'xgboost' THEN coverage END)", 3)} AS xgboost,
       {sround("max(CASE WHEN modelo = 'lightgbm' THEN coverage END)", 3)} AS lightgbm,
       {sround("max(CASE WHEN modelo = 'poisson' THEN coverage END)", 3)} AS poisson
FROM cov_pos GROUP BY posicao_id""", "cov_pos", doubles=("xgboost", "lightgbm", "poisson"))

oracle("a16_model_distribution", """
SELECT modelo_selecionado, count(*) AS atletas FROM ens GROUP BY modelo_selecionado""", "ens")

oracle("a31_model_comparison", f"""
SELECT modelo, rodada_alvo, avg({hit('pontuacao_prevista', 'pontuacao_real')}) AS coverage,
       sqrt(avg((pontuacao_prevista - pontuacao_real) * (pontuacao_prevista - pontuacao_real))) AS rmse,
       count(*) AS n
FROM (SELECT atleta_id, rodada_alvo, posicao_id, pontuacao_real, pontuacao_prevista, modelo FROM hist
      UNION ALL
      SELECT atleta_id, rodada_alvo, posicao_id, pontuacao_real, previsao_final, 'meta'
      FROM backtest WHERE pontuacao_real IS NOT NULL)
GROUP BY modelo, rodada_alvo""", "hist", "backtest", doubles=("coverage", "rmse"))

oracle("l01_train_score_split", """
SELECT atleta_id, rodada_alvo, CASE WHEN pontuacao_real IS NOT NULL THEN 'treino' ELSE 'previsao' END AS conjunto
FROM mp_wide""", "mp_wide")

oracle("l06_poisson_interval", "SELECT * FROM pq", "pq", doubles=("mu",))

oracle("l07_overdispersed_interval", """
SELECT x.atleta_id, x.rodada_alvo, q.q10 - CAST(10 AS DOUBLE) AS limite_inferior, q.q90 - CAST(10 AS DOUBLE) AS limite_superior
FROM l07_x x JOIN l07_q q ON x.mu = q.mu AND x.r = q.r""", "mp_real", "mp", extra=[
    ("l07_mom", """SELECT posicao_id, CASE WHEN v > m THEN m * m / (v - m) ELSE 1e6 END AS r
                   FROM (SELECT posicao_id, avg(pontuacao_real + 10.0) AS m, var_samp(pontuacao_real + 10.0) AS v
                         FROM mp_real GROUP BY posicao_id)"""),
    ("l07_x", """SELECT p.atleta_id, p.rodada_alvo, p.pontuacao_prevista + 10.0 AS mu, m.r
                 FROM (SELECT * FROM mp WHERE modelo = 'poisson') p JOIN l07_mom m ON p.posicao_id = m.posicao_id"""),
    ("l07_q", """SELECT mu, r, CAST(min(CASE WHEN cdf >= 0.1 THEN k END) AS BIGINT) AS q10,
                        CAST(min(CASE WHEN cdf >= 0.9 THEN k END) AS BIGINT) AS q90
                 FROM (SELECT mu, r, k, sum(exp(lgamma(k + r) - lgamma(r) - lgamma(k + 1) + r * ln(r / (r + m))
                                              + k * ln(1 - r / (r + m)))) OVER (
                              PARTITION BY mu, r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cdf
                       FROM (SELECT mu, r, m, unnest(generate_series(0, CAST(ceil(m + 12 * sqrt(m + m * m / r) + 10)
                                                                             AS BIGINT))) AS k
                             FROM (SELECT DISTINCT mu, r, greatest(mu, 0.01) AS m FROM l07_x)))
                 GROUP BY mu, r""")], doubles=("limite_inferior", "limite_superior"))

oracle("l08_time_folds", """
SELECT fold, rodada_alvo, papel FROM (
  SELECT fold, rodada_alvo,
         CASE WHEN i > n - (5 - fold + 1) * t AND i <= n - (5 - fold) * t THEN 'test'
              WHEN i <= n - (5 - fold + 1) * t THEN 'train' END AS papel
  FROM (SELECT rodada_alvo, row_number() OVER (ORDER BY rodada_alvo) AS i, count(*) OVER () AS n,
               floor(count(*) OVER () / 6) AS t
        FROM (SELECT DISTINCT rodada_alvo FROM mp_real)),
       (SELECT CAST(unnest(generate_series(1, 5)) AS INTEGER) AS fold))
WHERE papel IS NOT NULL""", "mp_real")

oracle("l12_prediction_table", f"""
SELECT p.atleta_id, p.rodada_alvo, p.modelo, greatest(p.pontuacao_prevista, CAST(0 AS DOUBLE)) AS pontuacao_prevista,
       e.rmse, e.mae, e.r2 AS r2_score, c.coverage_score, 'pitchlake_' || p.modelo AS modelo_versao,
       p.modelo || '-r' || CAST((SELECT max(rodada_alvo) FROM mp) AS VARCHAR) AS run_id
FROM mp p
JOIN ({ERR_SQL.format(by='modelo')}) e ON p.modelo = e.modelo
JOIN model_cov c ON p.modelo = c.modelo
WHERE p.pontuacao_real IS NULL""", "mp", "hist", "model_cov",
       doubles=("pontuacao_prevista", "rmse", "mae", "r2_score", "coverage_score"))

SEL_D = ("coverage_modelo", "w_xgb", "w_lgb", "w_poi", "cov_xgb", "cov_lgb", "cov_poi")
oracle("l13_select_model", "SELECT * FROM selection", "selection", doubles=SEL_D)
ENS_D = ("prev_xgb", "prev_lgb", "prev_poi", "pontuacao_prevista", "coverage_score_modelo")
oracle("l14_ensemble_predict", "SELECT * FROM ens", "ens", doubles=ENS_D)
oracle("l15_ensemble_coverage_col",
       "SELECT atleta_id, rodada_alvo, modelo_selecionado, coverage_score_modelo FROM ens", "ens",
       doubles=("coverage_score_modelo",))
RANK_D = ("pontuacao_prevista", "coverage_score_modelo", "preco_atual", "pontos_por_cartoleta")
oracle("l16_final_pick_table", "SELECT * FROM ranked", "ranked", doubles=RANK_D)
oracle("w04_rank_in_position", "SELECT atleta_id, rodada_alvo, posicao_id, ranking_posicao FROM ranked", "ranked")
oracle("j04_dim_chain", "SELECT atleta_id, apelido, posicao, clube FROM ranked", "ranked")
oracle("t02_top_per_position", """
SELECT posicao, atleta_id, apelido, pontuacao_prevista, preco_atual, pontos_por_cartoleta, ranking_posicao
FROM ranked
QUALIFY row_number() OVER (PARTITION BY posicao ORDER BY ranking_posicao, atleta_id) <= 3""", "ranked",
       doubles=("pontuacao_prevista", "preco_atual", "pontos_por_cartoleta"))
oracle("t04_top20_value", """
SELECT atleta_id, apelido, posicao, pontuacao_prevista, preco_atual, pontos_por_cartoleta FROM ranked
WHERE pontos_por_cartoleta IS NOT NULL ORDER BY pontos_por_cartoleta DESC, atleta_id LIMIT 20""", "ranked",
       doubles=("pontuacao_prevista", "preco_atual", "pontos_por_cartoleta"))
oracle("l17_inverse_error_weights", f"""
SELECT posicao_id, modelo, inv / sum(inv) OVER (PARTITION BY posicao_id) AS peso
FROM (SELECT posicao_id, modelo, CASE WHEN rmse > 0 THEN 1 / rmse END AS inv
      FROM ({ERR_SQL.format(by='posicao_id, modelo')}))""", "hist", doubles=("peso",))
oracle("l18_backtest", "SELECT * FROM backtest", "backtest",
       doubles=("prev_xgb", "prev_lgb", "prev_poi", "previsao_final", "pontuacao_real"))

oracle("f04_binary_encode", """
SELECT atleta_id, CASE WHEN mando_campo = 'casa' THEN 1 ELSE 0 END AS mando_casa,
       coalesce(CAST(eh_classico AS INTEGER), 0) AS classico
FROM feature_store""", "feature_store")
oracle("f05_one_hot", "SELECT atleta_id, rodada_alvo, "
       + ", ".join(f"CASE WHEN posicao_id = {v} THEN 1 ELSE 0 END AS pos_{v}" for v in (2, 3, 4, 5, 6))
       + " FROM mp_real", "mp_real")

oracle("j12_three_way_left", """
SELECT n.atleta_id, n.rodada_alvo, n.posicao_id,
       x.pontuacao_prevista AS prev_xgb,
       CASE WHEN x.atleta_id IS NOT NULL THEN (SELECT coverage_score FROM model_cov WHERE modelo = 'xgboost') END AS cov_xgb,
       l.pontuacao_prevista AS prev_lgb,
       CASE WHEN l.atleta_id IS NOT NULL THEN (SELECT coverage_score FROM model_cov WHERE modelo = 'lightgbm') END AS cov_lgb,
       p.pontuacao_prevista AS prev_poi,
       CASE WHEN p.atleta_id IS NOT NULL THEN (SELECT coverage_score FROM model_cov WHERE modelo = 'poisson') END AS cov_poi
FROM nxt n
LEFT JOIN (SELECT * FROM mp WHERE modelo = 'xgboost') x ON n.atleta_id = x.atleta_id AND n.rodada_alvo = x.rodada_alvo
LEFT JOIN (SELECT * FROM mp WHERE modelo = 'lightgbm') l ON n.atleta_id = l.atleta_id AND n.rodada_alvo = l.rodada_alvo
LEFT JOIN (SELECT * FROM mp WHERE modelo = 'poisson') p ON n.atleta_id = p.atleta_id AND n.rodada_alvo = p.rodada_alvo""",
       "nxt", "mp", "model_cov",
       doubles=("prev_xgb", "cov_xgb", "prev_lgb", "cov_lgb", "prev_poi", "cov_poi"))


# both CDFs as sums of their log probabilities over every count
oracle("l07_wide_interval", """
WITH g AS (
  SELECT c_nationkey, o_orderpriority, count(*) AS n, sum(y) / count(*)::DOUBLE AS mu, (sum(y * y) - sum(y) * (sum(y) / count(*)::DOUBLE)) / (count(*) - 1) AS v
  FROM (SELECT o_custkey, o_orderpriority, floor(o_totalprice / 100)::BIGINT AS y FROM orders) o JOIN customer ON c_custkey = o_custkey
  GROUP BY ALL HAVING count(*) > 1),
s AS (SELECT *, CASE WHEN v > mu THEN mu * mu / (v - mu) ELSE 1e6::DOUBLE END AS size FROM g),
k AS (SELECT *, unnest(range(0, (mu + 15 * sqrt(greatest(v, mu)) + 50)::BIGINT)) AS k FROM s),
c AS (
  SELECT c_nationkey, o_orderpriority, k,
         sum(exp(lgamma(k + size) - lgamma(size) - lgamma(k + 1) + size * ln(size / (size + mu)) + k * ln(mu / (size + mu)))) OVER w AS nb,
         sum(exp(k * ln(mu) - mu - lgamma(k + 1))) OVER w AS po
  FROM k WINDOW w AS (PARTITION BY c_nationkey, o_orderpriority ORDER BY k)),
q AS (
  SELECT c_nationkey, o_orderpriority, min(k) FILTER (nb >= 0.1) AS nb_q10, min(k) FILTER (nb >= 0.9) AS nb_q90,
         min(k) FILTER (po >= 0.1) AS poisson_q10, min(k) FILTER (po >= 0.9) AS poisson_q90
  FROM c GROUP BY ALL)
SELECT s.c_nationkey, s.o_orderpriority, n, mu, size, nb_q10, nb_q90, poisson_q10, poisson_q90
FROM s JOIN q ON s.c_nationkey = q.c_nationkey AND s.o_orderpriority = q.o_orderpriority""", doubles=("mu", "size"))
