"""L09 and the boosters that use it: the registered search has its whole budget."""

import random
from types import SimpleNamespace

import pytest

from pitchlake.operators import models as MD
from pitchlake.operators import search as SR
from pitchlake.plans import q_ml
from pitchlake.plans.queries import BUILDERS


@pytest.fixture()
def plan(spark, monkeypatch):
    """A plan over twelve played rounds and one to predict; nothing searched yet."""
    rows = [(a, r, "casa" if a % 2 else None, float(a + r) if r < 13 else None, *[float((a * 7 + r * i) % 5) for i in range(len(MD.FEATURES))])
            for a in range(4) for r in range(1, 14)]
    matrix = spark.createDataFrame(rows, f"atleta_id int, rodada_alvo int, mando_campo string, {MD.TARGET} double, "
                                         + ", ".join(f"{c} double" for c in MD.FEATURES))
    monkeypatch.setattr(q_ml, "_SEARCHED", {})
    return SimpleNamespace(spark=spark, sf_dir="", t=SimpleNamespace(shared=lambda name, build: matrix), training_features=None)


@pytest.mark.parametrize("which, settings", [("a", SR.settings()), ("b", SR.grid_b())])
def test_every_setting_meets_every_fold_with_the_whole_budget(plan, monkeypatch, which, settings):
    """The setting that is worst on the first fold and best over all of them is found."""
    met = {i: [] for i in range(len(settings))}
    last = len(settings) - 1

    def boost(train, valid, params, label, max_trees, patience):
        trial = settings.index(params)
        met[trial].append((max_trees, patience))
        return 40 + len(met[trial]), 9.0 if trial == last and len(met[trial]) == 1 else 1.0 if trial == last else 4.0

    monkeypatch.setattr(SR, "boost", boost)
    table = {r.trial: r for r in q_ml.trials(plan, which).collect()}
    assert all(x == [(500, 30)] * 5 for x in met.values())
    assert {(r.folds_run, r.state, r.trees) for r in table.values()} == {(5, "complete", 43)}
    assert sorted(r["rank"] for r in table.values()) == [*range(1, len(settings) + 1)]
    assert table[last]["rank"] == 1 and abs(table[last].rmse - 2.6) < 1e-12


def test_boost_ends_where_a_tree_by_tree_fit_ends(monkeypatch):
    """Wherever the least error lies; an early one costs no second fit of twice the trees."""
    rng = random.Random(5)
    asked = []
    for least, most in ((1, 31), (4, 31 + 37), (29, 31 + 74), (170, 1500), (499, 2500), (None, 2500)):
        errors = [abs(i + 1 - (least or 500)) + 10 + rng.random() for i in range(500)]
        asked.clear()

        def booster(params, trees, label, errors=errors):
            asked.append(trees)
            model = SimpleNamespace(evaluateEachIteration=lambda valid, loss: errors[:trees])
            return SimpleNamespace(fit=lambda train: model)

        monkeypatch.setattr(SR, "booster", booster)
        trees, rmse = SR.boost(None, None, {}, "y")
        want = SR.stop_at(errors, 30) or errors.index(min(errors)) + 1
        assert (trees, rmse) == (want, errors[want - 1] ** 0.5)
        assert asked == sorted(set(asked)) and asked[-1] <= 500 and sum(asked) <= most, (least, asked)


def test_first_booster_has_all_the_trees_that_the_search_found(plan, monkeypatch):
    """Errors that fall for 120 trees give a last fit of 120, and every row to predict is scored."""
    plain, fitted = SR.booster, []
    monkeypatch.setattr(SR, "boost", lambda train, valid, params, label, max_trees, patience: (min(max_trees, 120), 1.0))
    monkeypatch.setattr(SR, "booster", lambda params, trees, label, seed: fitted.append(trees) or plain(params, 2, label, seed))
    scored = BUILDERS["l03_boosted_trees_a"](plan)
    assert fitted == [120] and sorted(r.atleta_id for r in scored.collect()) == [0, 1, 2, 3]
