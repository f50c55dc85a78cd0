"""The search of every model: in-task fits against their models, trees of any depth, what the registered query asks for."""

import numpy as np
import pytest

import __spark_entry__ as entry
from keepline.operators import models as L
from keepline.plans import training as plans
from keepline.training import boosting, cv, held
from keepline.training.deep_trees import grow_deep
from keepline.training.design import fold_design
from keepline.training.logistic import Fit

N = 3


@pytest.fixture(scope="module")
def design(raw):
    return fold_design(L.training_table(raw, n_folds=N), N)


@pytest.fixture(scope="module")
def rows(design):
    return held.Rows(design.shape, design.rows.select("fold", "label", "hash", "x").toArrow().to_batches(50))


def test_the_search_asks_for_every_model_and_setting(spark, monkeypatch):
    asked = {}

    def search(design, name, settings):
        asked[name] = len(settings)
        return spark.createDataFrame([(0, str(settings[0]))], "candidate int, params string"), None, None

    monkeypatch.setattr(plans, "_design", lambda spark, d: None)
    monkeypatch.setattr(cv, "search", search)
    names = [r["model_name"] for r in entry.queries()["random_search"](spark, "").collect()]
    assert asked == {"DecisionTree": 80, "RandomForest": 120, "GradientBoosting": 120, "SVC_rbf": 60, "logreg": 80,
                     "xgboost": 200, "dummy_most_frequent": 1, "dummy_stratified": 1}
    assert names == list(asked)


@pytest.mark.parametrize("name", ["DecisionTree", "RandomForest", "GradientBoosting", "SVC_rbf", "xgboost", "logreg"])
def test_counts_are_those_of_the_models(design, name):
    space = {**L.SEARCH_SPACES[name], "k_best": [10, "all"]}
    settings = [{**s, **({"n_estimators": 7} if "n_estimators" in s else {})} for s in cv.sample_settings(space, 2, 3)]
    counts = cv.left_out_counts(design, name, settings)
    again = cv.fold_counts(design, cv.fit_all(design, name, settings, list(range(N))))
    assert {f: c.tolist() for f, c in counts.items()} == {f: c.tolist() for f, c in again.items()}
    assert sum(c.sum() for c in counts.values()) == 2 * 180 and len(counts) == 2 * N


def test_dummies_and_the_table(design):
    counts = cv.left_out_counts(design, "dummy_most_frequent", [{"k_best": 15}])
    assert all(c[0] == c[1] == 0 for c in counts.values()) and sum(c.sum() for c in counts.values()) == 180
    table, best, _ = cv.search(design, "DecisionTree", [{"max_depth": 1, "k_best": 5}, {"max_depth": None, "k_best": "all"}])
    assert sorted(r["rank"] for r in table.collect()) == [1, 2] and best in ({"max_depth": 1, "k_best": 5}, {"max_depth": None, "k_best": "all"})
    assert cv.search(design, "dummy_stratified", [{"k_best": 15}])[0].count() == 1


def plain(codes, y, w, setting, at, depth=0):
    """Share of class 1 of every row by the same greedy tree, trying every split."""
    def impurity(r):
        c = np.array([w[r][y[r] == 0].sum(), w[r][y[r] == 1].sum()])
        p = c / max(c.sum(), 1e-300)
        if setting["criterion"] == "entropy":
            return -(c * np.log2(np.maximum(p, 1e-300))).sum()
        return c.sum() * (1 - (p * p).sum())

    best = (1e-9 * w[at].sum(), None)
    if (setting["max_depth"] is None or depth < setting["max_depth"]) and len(at) >= setting["min_samples_split"]:
        for j in range(codes.shape[1]):
            for c in np.unique(codes[at, j])[:-1]:
                left, right = at[codes[at, j] <= c], at[codes[at, j] > c]
                if min(len(left), len(right)) >= setting["min_samples_leaf"]:
                    gain = impurity(at) - impurity(left) - impurity(right)
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
    out = np.zeros(len(y))
    if best[1] is None:
        out[at] = w[at][y[at] == 1].sum() / w[at].sum()
        return out
    return sum(plain(codes, y, w, setting, r, depth + 1) for r in best[1])


@pytest.mark.parametrize("setting", [
    {"criterion": "gini", "max_depth": None, "min_samples_leaf": 1, "min_samples_split": 2},
    {"criterion": "entropy", "max_depth": 4, "min_samples_leaf": 6, "min_samples_split": 20, "class_weight": "balanced"}])
def test_deep_trees_equal_trying_every_split(rows, setting):
    own = rows.shape.learned[N]
    trees, _ = grow_deep(rows, N, {**setting, "k_best": 8}, False)
    codes = rows.codes(N)[:, trees.slots].astype(int)
    w = np.ones(len(rows))
    if "class_weight" in setting:
        w = np.where(rows.y == 1, own.n / (2 * own.positives), own.n / (2 * (own.n - own.positives)))
    np.testing.assert_allclose(trees.share(codes), plain(codes, rows.y, w, setting, np.arange(len(rows))), atol=1e-9)


def test_a_forest_does_not_depend_on_what_grows_together(rows, monkeypatch):
    setting = {"n_estimators": 6, "max_depth": None, "min_samples_leaf": 2, "min_samples_split": 5, "max_features": "sqrt"}
    trees, score = grow_deep(rows, 1, setting, True)
    out = trees.share(rows.codes(1)[:, trees.slots])
    np.testing.assert_allclose(out[rows.fold == 1], score)
    assert len(trees.roots) == 6 and len({t.tobytes() for t in np.split(trees.slot, trees.roots[1:])}) > 1
    assert ((out >= 0.5) == (rows.y == 1)).mean() > 0.7


def test_boosted_trees_keep_their_least_rows(design, monkeypatch):
    params = {**cv.PLAIN_BOOSTING, "n_estimators": 3, "min_samples_leaf": 35, "min_samples_split": 80, "subsample": 0.8}
    inside = boosting.fit_boosted(design, [0, N], 8, **params)
    free = boosting.fit_boosted(design, [0, N], 8, **{**params, "min_samples_leaf": 1, "min_samples_split": 2})
    monkeypatch.setattr(boosting, "fits_in_tasks", lambda design: False)
    for s, trees in boosting.fit_boosted(design, [0, N], 8, **params).items():
        assert (trees.slot == inside[s].slot).all() and inside[s].slot.tolist() != free[s].slot.tolist()
        np.testing.assert_allclose(trees.value, inside[s].value, atol=1e-9)


def test_costs_know_every_fit():
    assert all(cost({}) > 0 for cost in cv.TASK_COSTS.values()) and Fit(0, 1) == Fit(0, 1)
