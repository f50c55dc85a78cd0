"""Fits side by side: rounds, the fold design, regressions, trees, networks and the run log."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepline.constants import CHAMPION_PARAMS, MLP_GRID
from keepline.operators import models as L
from keepline.session import scratch_path
from keepline.training import boosting, cv, logistic, network, rounds, runs
from keepline.training.design import fold_design, right_closed
from keepline.training.logistic import Fit

N = 3


@pytest.fixture(scope="module")
def design(spark, raw):
    odd = raw.withColumn("Contract", F.when(F.col("customerID") == "A_3", None).otherwise(F.col("Contract")))
    return fold_design(L.training_table(odd, n_folds=N), N)


@pytest.fixture(scope="module")
def held(design):
    rows = sorted(design.rows.collect())
    return (np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]), np.array([r["fold"] for r in rows]),
            [r["row_id"] for r in rows], np.array([r["hash"] for r in rows]).view(np.uint64))


@pytest.mark.parametrize("fan_in,groups", [(64, 1), (2, 3)])
def test_sums_over_any_number_of_parts(spark, monkeypatch, fan_in, groups):
    monkeypatch.setattr(rounds, "FAN_IN", fan_in)
    rows = spark.range(100).select(
        (F.col("id") % 3).cast("int").alias("fold"), F.lit(1.0).alias("label"), F.xxhash64("id").alias("hash"),
        F.array(F.col("id").cast("double")).alias("x")).repartition(9)
    got = rounds.summed(rows, lambda b, s: np.array([b.x[b.fold == s].sum(), len(b.y)]), [0, 1, 2, 7], groups)
    assert {s: v.tolist() for s, v in got.items()} == {
        **{s: [sum(range(s, 100, 3)), 100] for s in range(3)}, 7: [0, 100]}


def test_each_fit_learns_from_the_other_folds(design, held):
    x, y, fold, _, _ = held
    for s, own in enumerate(design.shape.learned):
        used = fold != s
        assert own.n == used.sum() and own.positives == y[used].sum()
        np.testing.assert_allclose(own.fills[:2], np.nanquantile(x[used][:, :2], 0.5, axis=0, method="inverted_cdf"))
        scaled = design.shape.scaled(x, own)[used]
        k = len(own.means)
        moving = own.deviations > 0
        np.testing.assert_allclose(scaled[:, :k].mean(axis=0), 0, atol=1e-9)
        np.testing.assert_allclose(scaled[:, :k].std(axis=0)[moving], 1, atol=1e-9)
        slots = design.shape.slots(x, own)[used]
        assert (own.varying == (slots.std(axis=0) > 1e-12)).all()
        j = design.shape.names.index("Contract=Two year")
        table = np.array([[(slots[:, j] == a) & (y[used] == b) for b in (0, 1)] for a in (0, 1)]).sum(axis=2) / used.sum()
        independent = table.sum(axis=1, keepdims=True) * table.sum(axis=0)
        want = (table[table > 0] * np.log(table[table > 0] / independent[table > 0])).sum()
        assert own.information[j] == pytest.approx(want)
        assert set(own.best(5)) == set(sorted(np.flatnonzero(own.varying), key=lambda i: (-own.information[i], i))[:5])
    assert right_closed(np.array([np.nan, 0, 1, 1.5, 9]), np.array([1.0, 2.0, 3.0])).tolist() == [-1, 0, 0, 0, 1]


def test_regressions_are_optimal(design, held):
    """At the solution no coefficient's slope leaves its penalty's interval, for every setting and fold."""
    x, y, fold, _, _ = held
    settings = [{"C": 1.0}, {"C": 0.05, "l1_ratio": 0.5, "k_best": 5}, {"C": 0.2, "l1_ratio": 1.0, "class_weight": "balanced"}]
    found = logistic.fit_logistic(design, settings, [0, 1, N])
    assert len(found) == 9
    for f, beta in found.items():
        own, setting = design.shape.learned[f.left_out], settings[f.setting]
        used = fold != f.left_out
        m = np.column_stack([design.shape.scaled(x[used], own), np.ones(used.sum())])
        p = 1 / (1 + np.exp(-m @ beta))
        w = np.ones(used.sum())
        if "class_weight" in setting:
            w = np.where(y[used] == 1, own.n / (2 * own.positives), own.n / (2 * (own.n - own.positives)))
        g = m.T @ (w * (p - y[used]))
        lam, share = 1 / setting["C"], setting.get("l1_ratio", 0.0)
        kept = np.zeros(len(beta), bool)
        kept[own.best(setting.get("k_best", "all"))] = True
        assert (beta[:-1][~kept[:-1]] == 0).all() and abs(g[-1]) < 0.05
        slope = g[:-1] + lam * (1 - share) * beta[:-1]
        off = np.where(beta[:-1] != 0, np.abs(slope + lam * share * np.sign(beta[:-1])), np.maximum(np.abs(slope) - lam * share, 0))
        assert off[kept[:-1]].max() < 0.05
        assert f.setting != 2 or (beta[:-1] == 0).any()


def test_out_of_fold_scores_are_of_the_fit_without_the_fold(design, held):
    x, _, fold, ids, _ = held
    fitted = cv.fit_all(design, "logreg", [{"C": 1.0}], list(range(N)))
    oof = cv.out_of_fold(design, {f.left_out: s for f, s in fitted.items()}).collect()
    want = {i: fitted[Fit(0, k)](x[n:n + 1])[0] for n, (i, k) in enumerate(zip(ids, fold))}
    assert {r["row_id"]: r["y_proba"] for r in oof} == pytest.approx(want) and len(oof) == len(ids)
    counts = cv.fold_counts(design, fitted)
    assert sum(c.sum() for c in counts.values()) == len(ids)


PENALTIES = {**CHAMPION_PARAMS, "reg_lambda": 2.0, "reg_alpha": 0.5, "min_child_weight": 1.0, "gamma": 0.0,
             "learning_rate": 0.3, "max_depth": 2, "subsample": 1.0, "colsample_bytree": 1.0, "n_estimators": 3}


def plain_tree(codes, g, h, p, depth, rows=None):
    """The same greedy tree by trying every split."""
    rows = np.arange(len(g)) if rows is None else rows
    t = lambda v: np.sign(v) * max(abs(v) - p["reg_alpha"], 0)
    score = lambda r: t(g[r].sum()) ** 2 / (h[r].sum() + p["reg_lambda"])
    best = (1e-6, None)
    for j in range(codes.shape[1]) if depth else ():
        for c in np.unique(codes[rows, j])[:-1]:
            left, right = rows[codes[rows, j] <= c], rows[codes[rows, j] > c]
            if min(h[left].sum(), h[right].sum()) >= p["min_child_weight"]:
                gain = score(left) + score(right) - score(rows)
                if gain > best[0] + 1e-9:
                    best = (gain, (left, right))
    if best[1] is None:
        out = np.zeros(len(g))
        out[rows] = -t(g[rows].sum()) / (h[rows].sum() + p["reg_lambda"]) * p["learning_rate"]
        return out
    return sum(plain_tree(codes, g, h, p, depth - 1, r) for r in best[1])


def test_trees_equal_trying_every_split(design, held, monkeypatch):
    monkeypatch.setattr(boosting, "WRITTEN_EVERY", 2)
    x, y, fold, _, _ = held
    found = boosting.fit_boosted(design, [1, N], 6, **PENALTIES)
    for s, trees in found.items():
        own = design.shape.learned[s]
        assert list(trees.slots) == list(own.best(6)) and len(trees) == 3
        used = fold != s
        codes = design.shape.codes(x, own)[:, trees.slots][used].astype(int)
        w = np.where(y[used] == 1, PENALTIES["scale_pos_weight"], 1.0)
        g, h = w * (0.5 - y[used]), w * 0.25
        margin = np.full(used.sum(), -g.sum() / h.sum())
        assert trees.base == pytest.approx(margin[0])
        for t in range(3):
            q = 1 / (1 + np.exp(-margin))
            margin = margin + plain_tree(codes, w * (q - y[used]), w * q * (1 - q), PENALTIES, 2)
        np.testing.assert_allclose(trees.margin(codes), margin, atol=1e-9)


def test_penalties_work_on_the_leaves(design):
    def fit(**more):
        return boosting.fit_boosted(design, [N], "all", **{**PENALTIES, "n_estimators": 1, **more})[N]

    size = lambda trees: np.abs(trees.value[0][trees.slot[0] < 0]).max()
    assert size(fit(reg_lambda=50.0)) < size(fit(reg_lambda=2.0)) < size(fit(reg_lambda=0.0))
    assert size(fit(reg_alpha=1e6)) == 0
    assert (fit(gamma=1e9).slot == -1).all() and (fit(min_child_weight=1e9).slot == -1).all()
    free, some = fit(gamma=0.0), fit(gamma=5.0)
    assert (some.slot >= 0).sum() <= (free.slot >= 0).sum()
    assert (some.gain[0][[i for i in range(1, 3) if some.slot[0][i] >= 0]] >= 5.0).all()
    drawn = [fit(subsample=0.5, seed=k).value.tolist() for k in (1, 1, 2)]
    assert drawn[0] == drawn[1] != drawn[2]


def test_the_final_model_keeps_the_best_number_of_trees(design):
    params = {**PENALTIES, "learning_rate": 0.9, "n_estimators": 6}
    trees, count = cv.refit_champion(design, 5, **params)
    losses = cv.best_trees(design, boosting.fit_boosted(design, [0], 5, **params)[0], 0)[1]
    assert len(trees) == count == int(np.argmin(losses)) + 1
    table = boosting.trees_table(design.rows.sparkSession, {N: trees}, design).collect()
    assert {r["tree"] for r in table} == set(range(count)) and all((r["value"] is None) != (r["slot"] is None) for r in table)


def test_network_gradient_is_that_of_its_loss():
    rng = np.random.default_rng(0)
    sizes, x, y = [4, 5, 3, 1], rng.normal(size=(7, 4)), (rng.random(7) < 0.5).astype(float)
    flat = network._start(sizes, rng)
    keep = [(rng.random((7, n)) >= 0.3) / 0.7 for n in sizes[1:-1]]

    def loss(w):
        return network.loss_sum(network._forward(x, network._layers(w, sizes), keep)[-1][:, 0], y, 2.5) / 7

    g = network.gradient(x, y, flat, sizes, 2.5, keep)
    for i in range(0, len(flat), 3):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        assert g[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-6)


def test_networks_stop_early_and_return_to_their_best(design, held):
    x, y, fold, _, _ = held
    settings = [{**MLP_GRID[0], "hidden_layers": [8], "learning_rate": 0.05, "max_epochs": 40, "patience": 3, "k_best": 5}]
    found = network.fit_networks(design, settings, [0, 1])
    for f, net in found.items():
        assert net.epoch == int(np.argmin(net.losses)) + 1 and len(net.losses) <= max(40, net.epoch + 3)
        own, used = design.shape.learned[f.left_out], fold == f.left_out
        margin = net.margin(design.shape.scaled(x[used], own)[:, own.best(5)])
        weight = (own.n - own.positives) / own.positives
        assert network.loss_sum(margin, y[used], weight) / used.sum() == pytest.approx(min(net.losses))
    assert network.fit_networks(design, settings, [0])[Fit(0, 0)].losses == found[Fit(0, 0)].losses
    fixed = network.fit_networks(design, [{**settings[0], "max_epochs": 2}], [N], validate=False)
    assert fixed[Fit(0, N)].epoch == 2


def test_search_ranks_all_settings(design):
    table, best, scorer = cv.search(design, "logreg", [{"C": 1.0}, {"C": 1.0, "class_weight": "balanced"}])
    rows = table.orderBy("rank").collect()
    assert str(best) == rows[0]["params"] and rows[0]["mean_recall"] >= rows[1]["mean_recall"]
    for r in rows:
        assert r["mean_recall"] == pytest.approx(np.mean([r[f"split{s}_recall"] for s in range(N)]))
    assert cv.scored(design, scorer).count() == 180
    with pytest.raises(ValueError):
        cv.search(design, "logreg", [{}], "profit")


def test_spark_estimators_score_every_fold(design):
    oof = cv.spark_out_of_fold(design, "DecisionTree", 5, max_depth=2).collect()
    assert len(oof) == 180 and {r["fold"] for r in oof} == set(range(N))


def test_runs_are_seen_when_their_manifest_is_written(spark, design):
    root, start = scratch_path(spark, "runs"), datetime(2024, 1, 1)
    oof = cv.out_of_fold(design, {f.left_out: s for f, s in cv.fit_all(design, "logreg", [{}], [0, 1, 2]).items()})
    runs.commit_run(spark, root, "a", "first", {"model__C": 1.0, "none": None}, oof, start, n_folds=N, metrics={"bad": float("nan")})
    spark.read.parquet(f"{root}/oof/*").withColumn("attempt", F.lit("torn")).write.parquet(f"{root}/oof/torn")
    assert runs.read_run_oof(spark, root).count() == 180
    (run,) = runs.read_runs(spark, root).collect()
    assert run["params"] == {"model__C": "1.0", "model_name": "first", "cv_folds": str(N)}
    assert run["tags"] == {"metric_skipped_bad": "nan_or_inf"}
    worse = oof.withColumn("y_proba", F.lit(0.0))
    runs.commit_run(spark, root, "b", "second", {}, worse, start, n_folds=N)
    ranked = runs.ranked_runs(spark, root).orderBy("rank").collect()
    assert [r["run_id"] for r in ranked] == ["a", "b"] and ranked[0]["n_folds"] == N and ranked[1]["mean"] == 0
    runs.commit_run(spark, root, "a", "first", {}, worse, datetime(2024, 1, 2), n_folds=N)
    assert runs.read_runs(spark, root).count() == 2 and runs.read_run_oof(spark, root).count() == 360
    assert {r["mean"] for r in runs.ranked_runs(spark, root).collect()} == {0.0}


def test_sums_of_many_fits_are_those_of_each():
    """Loss, gradient and curvature of fits that share their products, at margins of any size, against plain sums."""
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(2500, 7)), (rng.random(2500) < 0.3).astype(float)
    beta, weights = rng.normal(size=(9, 7)) * 20, rng.uniform(0.5, 2, (9, 2))
    upper = np.triu_indices(7)
    for n_fits in (3, 9):
        for own, b, w in zip(logistic._sums(x, y, beta[:n_fits], weights[:n_fits]), beta, weights):
            margin = x @ b
            p, each = 1 / (1 + np.exp(-np.clip(margin, -500, 500))), np.where(y == 1, w[1], w[0])
            curve = (x * (each * p * (1 - p))[:, None]).T @ x
            np.testing.assert_allclose(own[0], (each * (np.logaddexp(0, margin) - y * margin)).sum(), rtol=1e-9)
            np.testing.assert_allclose(own[1:8], x.T @ (each * (p - y)), atol=1e-7)
            np.testing.assert_allclose(own[8:], curve[upper], atol=1e-7)


def test_tasks_are_sent_the_values_of_their_own_fits(spark):
    """Each group of fits gets its own values only, and the sums are those of each fit."""
    rows = spark.range(50).selectExpr("cast(id % 2 as int) as fold", "cast(1 as double) as label", "id as hash",
                                      "array(cast(id as double)) as x")
    given = {f: np.full(3, float(f)) for f in range(5)}
    found = rounds.summed(rows, lambda batch, f, own: own * batch.x.sum(), list(given), 2, given=given)
    assert {f: v.tolist() for f, v in found.items()} == {f: [1225.0 * f] * 3 for f in given}


def test_trees_add_the_values_of_the_leaves_that_rows_reach():
    """Leaves at any level, with codes up to the largest, against a plain walk; a batch is decoded once for all fits."""
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 256, (500, 6)).astype(np.uint8)
    slot, split = rng.integers(0, 6, (12, 31)).astype(np.int32), rng.integers(0, 256, (12, 31)).astype(np.int32)
    for t in range(12):
        for i in range(31):
            if i >= 15 or rng.random() < 0.2 or (i and slot[t, (i - 1) // 2] < 0):
                slot[t, i] = -1
    trees = boosting.Trees(0.5, np.arange(6), slot, split, rng.normal(size=(12, 31)), np.zeros((12, 31)))
    plain = sum(trees.value[t][boosting.walk(codes, slot[t], split[t])] for t in range(3, 12))
    assert np.array_equal(trees.added(codes, 3), plain)
    assert trees.added(codes[:0]).shape == (0,) and not trees.added(codes, 12).any()
    assert not rounds.Batch(codes[:, 0], codes[:, 0], codes[:, 0], codes, {}).memo
