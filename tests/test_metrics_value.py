import numpy as np
import pytest
from pyspark.sql import functions as F

from keepline.operators import business as B
from keepline.operators import metrics as M


def frame(spark, rows):
    return spark.createDataFrame([(i, y, float(p)) for i, (y, p) in enumerate(rows)],
                                 "row_id long, y_true int, y_proba double")


@pytest.fixture(scope="module")
def random_scores(spark):
    rng = np.random.default_rng(1)
    y = (rng.random(800) < 0.3).astype(int)
    p = np.clip((rng.random(800) + y * 0.3) / 1.3, 0, 1).round(2)
    return y, p, frame(spark, [(int(a), b) for a, b in zip(y, p)])


def test_area_and_precision_against_pairs(random_scores):
    y, p, df = random_scores
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    row = M.compute_metrics(df).first()
    assert row["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
    ap, before = 0.0, 0
    for t in sorted(set(p), reverse=True):
        tp = int(((p >= t) & (y == 1)).sum())
        ap += (tp - before) / y.sum() * tp / int((p >= t).sum())
        before = tp
    assert row["average_precision"] == pytest.approx(ap, abs=1e-12)
    hit = p >= 0.5
    assert row["recall"] == pytest.approx((hit & (y == 1)).sum() / y.sum())
    assert row["accuracy"] == pytest.approx((hit == (y == 1)).mean())


def test_one_class_only(spark):
    row = M.compute_metrics(frame(spark, [(0, 0.2), (0, 0.1)])).first()
    assert row["roc_auc"] is None and row["recall"] == 0.0 and row["accuracy"] == 1.0
    c = M.confusion_counts(frame(spark, [(0, 0.9)]))
    assert c.select(M.recall_from_confusion()).first()[0] is None


def test_sweep_equals_counting_at_every_threshold(random_scores):
    y, p, df = random_scores
    got = B.sweep_thresholds(df).orderBy("threshold").collect()
    assert len(got) == 201
    for r in got:
        hit = p >= r["threshold"]
        assert (r["tp"], r["fp"]) == (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()))
        assert r["tp"] + r["fn"] == y.sum() and r["fp"] + r["tn"] == (y == 0).sum()
        assert r["net_value"] == 10 * r["tp"] - r["fp"] - 5 * r["fn"]
    best = B.best_threshold(B.sweep_thresholds(df)).first()
    top = max(r["net_value"] for r in got)
    assert best["threshold"] == min(r["threshold"] for r in got if r["net_value"] == top)


def test_grids():
    assert B.threshold_grid("toolkit") == [0.3, 0.5, 0.7]
    assert B.threshold_grid(fixed=[0.4, 0.2]) == [0.2, 0.4]
    assert len(B.threshold_grid(arange=(0.3, 0.95, 0.05))) == len(
        np.arange(0.3, 0.95 + 1e-12, 0.05))
    assert B.threshold_grid(n=3) == [0.0, 0.5, 1.0]


def test_topk_breaks_ties_by_row(spark):
    df = frame(spark, [(1, 0.9), (0, 0.5), (1, 0.5), (1, 0.5), (0, 0.1)])
    r = B.net_value_at_topk(df, 0.5).first()
    assert (r["k"], r["tp"], r["fp"], r["fn"], r["tn"]) == (3, 2, 1, 1, 1)
    assert r["net_value"] == 19.0 and r["roi"] == 19.0
    assert B.net_value_at_topk(df, 0.01).first()["k"] == 1


def test_topk_with_every_score_equal(spark):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int")
                                  .alias("y_true"), F.lit(0.5).alias("y_proba"))
    r = B.net_value_at_topk(df, 0.1).first()
    assert (r["k"], r["tp"], r["fp"]) == (500, 250, 250)


def test_wrong_options_raise(random_scores):
    df = random_scores[2]
    with pytest.raises(ValueError):
        B.net_value_at_topk(df, 0.0)
    with pytest.raises(ValueError):
        B.best_threshold(B.sweep_thresholds(df), objective="profit")
    with pytest.raises(ValueError):
        M.bootstrap_ci(df, "row_id", "unknown")
    with pytest.raises(ValueError):
        M.confusion_normalized(df, "rows")


@pytest.mark.parametrize("option,want", [("nan", None), ("inf", float("inf")), ("zero", 0.0)])
def test_roi_without_cost(spark, option, want):
    df = frame(spark, [(1, 0.9), (0, 0.1)])
    assert B.net_value_at_threshold(df, 0.5, on_zero_cost=option).first()["roi"] == want


def test_fold_summaries(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("inf")), ("a", 3.0), ("b", None)],
                               "m string, v double")
    got = {r["m"]: tuple(r)[1:] for r in M.summarize_folds(df, "v", ["m"]).collect()}
    assert got["a"] == (2.0, pytest.approx(2 ** 0.5), 1.0, 3.0)
    assert got["b"] == (None, None, None, None)


def test_bootstrap_brackets_the_metric(random_scores):
    df = random_scores[2]
    auc = M.roc_auc(df).first()[0]
    r = M.bootstrap_ci(df, "row_id", "roc_auc", 60).first()
    assert r["n_samples"] == 60 and r["lower"] < auc < r["upper"]
    recall = M.bootstrap_ci(df, "row_id", lambda tn, fp, fn, tp: tp / (tp + fn), 40).first()
    assert 0 < recall["lower"] <= recall["mean"] <= recall["upper"] < 1


def test_ranking_and_gate(spark, random_scores):
    df = random_scores[2].withColumn("model_name", F.lit("a")).withColumn(
        "fold", (F.col("row_id") % 4).cast("int"))
    both = df.unionByName(df.withColumn("model_name", F.lit("b")).withColumn(
        "y_proba", 1 - F.col("y_proba")))
    ranked = B.business_ranking(B.business_eval(both, mode="topk", value=0.2), "net_value")
    assert {r["model_name"]: r["position"] for r in ranked.collect()} == {"a": 1, "b": 2}
    assert B.absolute_gate(ranked, "recall_mean", 2.0).count() == 0
    rows = B.business_metric_rows(both, tag="x", mode="threshold", value=0.5).collect()
    assert len(rows) == 2 * (4 * 3 + 6)
    assert "business.x.threshold_thr_0.50.recall_mean" in {r["key"] for r in rows}
