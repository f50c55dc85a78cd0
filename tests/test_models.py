import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keepline.operators import cleaning as C
from keepline.operators import encoding as E
from keepline.operators import metrics as M
from keepline.operators import models as L
from keepline.operators import scoring as G
from keepline.operators import splits as S
from keepline.session import scratch_path
from keepline.sources import tables as T


def test_folds_are_stratified_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    folds = S.stratified_kfold(df, "id", "y", 10)
    sizes = folds.groupBy("fold", "y").count().toPandas()
    assert len(sizes) == 20
    for y, part in sizes.groupby("y"):
        assert part["count"].max() - part["count"].min() <= 1
    again = S.stratified_kfold(df.repartition(3), "id", "y", 10)
    assert folds.exceptAll(again.select(*folds.columns)).count() == 0
    other = S.stratified_kfold(df, "id", "y", 10, seed=7)
    assert folds.exceptAll(other).count() > 0
    loose = S.stratified_kfold(df, "id", "y", 10, exact=False)
    assert loose.select("fold").distinct().count() == 10


def test_split_shares(spark):
    df = spark.range(500).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    got = S.stratified_split(df, "id", "y").groupBy("y").agg(F.sum("is_test")).collect()
    assert {r[0]: r[1] for r in got} == {0: 80, 1: 20}
    with pytest.raises(ValueError):
        S.stratified_split(df, "id", "y", 1.5)


def test_weights(training):
    got = training.groupBy("label").agg(F.sum("w_balanced")).collect()
    assert got[0][1] == pytest.approx(got[1][1])
    w = S.class_weights(training, "label").first()
    assert w["pos_weight"] == pytest.approx(w["n_neg"] / w["n_pos"])


def test_one_hot_ignores_unseen_levels(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    model = E.one_hot(["c"]).fit(df)
    seen = spark.createDataFrame([("a",), ("b",), (None,), ("zzz",)], "c string")
    rows = model.transform(seen).select(vector_to_array("c_oh")).collect()
    assert [list(r[0]) for r in rows] == [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0], [0.0, 0.0]]


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (6.0, 5.0)],
                               "x double, c double")
    got = np.array([r["z_x"] for r in E.standard_scale(df, ["x", "c"]).collect()])
    x = np.array([1.0, 2.0, 2.0, 6.0])
    np.testing.assert_allclose(got, (x - x.mean()) / x.std())
    assert {r["z_c"] for r in E.standard_scale(df, ["c"]).collect()} == {0.0}


def test_mutual_information_of_a_copy_is_the_entropy(spark):
    df = spark.range(400).select((F.col("id") % 4 == 0).cast("int").alias("y"),
                                 F.when(F.col("id") % 4 == 0, "p").otherwise("q").alias("same"),
                                 (F.col("id") % 2).cast("string").alias("half"),
                                 F.lit("k").alias("flat"))
    mi = {r["feature"]: r["mi"] for r in E.mutual_info_scores(
        df, "y", ["same", "half", "flat"]).collect()}
    assert mi["same"] == pytest.approx(-(0.25 * np.log(0.25) + 0.75 * np.log(0.75)))
    assert mi["flat"] == 0.0 and 0 < mi["half"] < mi["same"]


def test_landmarks_give_the_kernel(spark):
    """Exact with as many landmarks as rows, near with fewer."""
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    ring = (np.sqrt((x * x).sum(axis=1)) > 1.5).astype(float)
    df = spark.createDataFrame([(i, Vectors.dense(v), float(c)) for i, (v, c) in enumerate(zip(x, ring))],
                               ["id", "features", "label"])
    df = df.withColumn("w_none", F.lit(1.0)).withColumn("fold", F.lit(0))
    exact = L._rbf(x, x, 0.5)

    def kernel(size):
        rows = L.NystroemMap(gamma=0.5, size=size).fit(df).transform(df).orderBy("id").collect()
        m = np.stack([r["kernel"].toArray() for r in rows])
        return m @ m.T

    np.testing.assert_allclose(kernel(60), exact, atol=1e-6)
    assert np.abs(kernel(40) - exact).mean() < 0.02 < np.abs(kernel(5) - exact).mean()

    # A ring is no linear class; the machine on the kernel ranks it rightly.
    out = L.kernel_svm(size=60, gamma=0.5, C=10.0).fit(df.coalesce(1)).transform(df)
    p = np.array([r["p"] for r in out.orderBy("id").select(G.positive_probability(out).alias("p")).collect()])
    assert np.mean([a > b for a in p[ring == 1] for b in p[ring == 0]]) > 0.95


def neighbours_by_brute_force(values, classes, k):
    """The same estimate by comparing all rows with all."""
    digamma = lambda n: -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))
    rows = [(v, c) for v, c in zip(values, classes) if v is not None and classes.count(c) > 1]
    sizes = {c: sum(d == c for _, d in rows) for _, c in rows}
    total = digamma(len(rows))
    for j, (v, c) in enumerate(rows):
        own = min(k, sizes[c] - 1)
        r = sorted(abs(w - v) for i, (w, d) in enumerate(rows) if d == c and i != j)[own - 1]
        m = sum(abs(w - v) < r - 1e-9 or w == v for w, _ in rows)
        total += (digamma(own) - digamma(sizes[c]) - digamma(m)) / len(rows)
    return max(total, 0.0)


@pytest.mark.parametrize("chunk", [7, 1024])
def test_mutual_information_by_neighbours(spark, monkeypatch, chunk):
    monkeypatch.setattr(E, "_CHUNK", chunk)
    rng = np.random.default_rng(3)
    y = ["a" if u < 0.3 else "b" for u in rng.random(150)] + ["rare", "rare", "once"]
    x = [round(float(v) + (1.5 if c == "a" else 0), 3) for v, c in zip(rng.normal(size=153), y)]
    ties = [float(v) for v in rng.integers(0, 6, 153)]
    x[10] = None
    df = spark.createDataFrame(list(zip(y, x, ties)), "y string, x double, ties double").repartition(5)
    got = {r["feature"]: r["mi"] for r in E.mutual_info_neighbours(df, "y", ["x", "ties"]).collect()}
    assert got["x"] == pytest.approx(neighbours_by_brute_force(x, y, 3), abs=1e-6)
    assert got["ties"] == pytest.approx(neighbours_by_brute_force(ties, y, 3), abs=1e-6)


@pytest.fixture(scope="module")
def fitted(training):
    return L.model_pipeline("logreg", 15, n_rows=180).fit(training)


def test_encoded_rows_are_finite(training, fitted):
    out = fitted.transform(training)
    assert out.count() == 180
    assert fitted.stages[-2].getOrDefault("indices").__len__() == 15
    values = out.select(F.explode(vector_to_array("features")).alias("v"))
    assert values.where("isnan(v) or v is null or abs(v) = double('inf')").count() == 0


def test_saved_chain_scores_the_same(spark, training, fitted):
    path = scratch_path(spark, "test-pipeline")
    T.save_pipeline(fitted, path)
    a = L.scores_of(fitted, training).toPandas().sort_values("row_id")["y_proba"].to_numpy()
    b = L.scores_of(T.load_pipeline(path), training).toPandas().sort_values("row_id")[
        "y_proba"].to_numpy()
    np.testing.assert_array_equal(a, b)
    assert ((a >= 0) & (a <= 1)).all()


def test_new_levels_do_not_break_scoring(training, fitted):
    odd = training.withColumn("Contract", F.lit("Weekly")).withColumn(
        "TotalCharges", F.lit(None).cast("double"))
    p = L.scores_of(fitted, odd).agg(F.count("y_proba"), F.min("y_proba")).first()
    assert p[0] == 180 and p[1] >= 0


def test_cross_validation_beats_the_dummy(training):
    pipeline = L.model_pipeline("logreg", "all", n_rows=180, approx=True, class_weight="balanced")
    folds, summary, model = L.cross_validate(training, pipeline, 2)
    assert folds.count() == 2
    means = {r["metric"]: r["mean"] for r in summary.collect()}
    assert means["roc_auc"] > 0.6 and 0 <= means["recall"] <= 1
    assert model.transform(training).count() == 180


def test_boosted_and_kernel_models(training):
    data = L.add_champion_weight(training)
    for name, params in (("xgboost", {"n_estimators": 4, "learning_rate": 0.3}),
                         ("SVC_rbf", {"size": 32, "max_iter": 10}),
                         ("mlp", {"hidden_layers": [6], "max_epochs": 20})):
        model = L.model_pipeline(name, "all", approx=True, **params).fit(data)
        auc = M.roc_auc(L.scores_of(model, data)).first()[0]
        assert auc > 0.6, name


def test_search_is_seeded_and_finds_the_best(training):
    assert L.sample_params("xgboost", 5) == L.sample_params("xgboost", 5)
    assert L.sample_params("xgboost", 5) != L.sample_params("xgboost", 5, seed=1)
    assert all("k_best" in p for p in L.sample_params("unknown", 3, space={}))
    results, best, model = L.grid_cv(training, "DecisionTree",
                                     {"max_depth": [1, 3], "class_weight": ["balanced"]}, 2)
    rows = results.orderBy("candidate").collect()
    assert len(rows) == 2
    top = max(rows, key=lambda r: (r["mean_recall"], -r["candidate"]))
    assert str(best) == top["params"] and model.transform(training).count() == 180
    with pytest.raises(ValueError):
        L.grid_cv(training, "DecisionTree", [{}], 2, metric="profit")


def test_final_refit_picks_trees(training):
    model, trees = L.refit_final(training, "all", n_estimators=6, learning_rate=0.3)
    assert 1 <= trees <= 6 and model.stages[-1].getNumTrees == trees


def test_dummies(training):
    major = L.dummy_most_frequent(training)
    assert major.select("prediction").distinct().count() == 1
    share = training.agg(F.avg("label")).first()[0]
    rate = L.dummy_stratified(training, "customerID").agg(F.avg("prediction")).first()[0]
    assert abs(rate - share) < 0.15


def test_any_python_model(spark):
    df = spark.range(20).select(F.col("id"), (F.col("id") / 19.0).alias("x"))
    for shape in (lambda v: pd.DataFrame({"y_pred_proba": v}), lambda v: v,
                  lambda v: v.to_numpy(), lambda v: pd.DataFrame({"other": v})):
        out = G.external_model_score(df, lambda b, s=shape: s(b["x"]), ["x"])
        scored = out.withColumn("y_pred", G.apply_threshold("y_pred_proba", 0.5)).collect()
        assert all(r["y_pred"] == int(r["y_pred_proba"] >= 0.5) for r in scored)
        assert [r["y_pred_proba"] for r in sorted(scored)] == [i / 19.0 for i in range(20)]
    with pytest.raises(Exception, match="no column"):
        G.external_model_score(df, lambda b: pd.DataFrame({"a": b["x"], "b": b["x"]}),
                               ["x"]).collect()


def test_months_and_minmax(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, s double")
    got = sorted((r["g"], round(r["y_proba"], 9)) for r in G.minmax_score(df, "s", ["g"])
                 .collect())
    assert got == [("a", 0.0), ("a", 1.0), ("b", 0.0)]
    now = F.lit("2024-01-01 02:00:00").cast("timestamp")
    assert df.select(G.prediction_month(now)).first()[0] == "2023-12-01"


def test_profile_of_clean_rows(raw):
    from keepline.operators import profile as P

    clean = C.preprocess(raw)
    box = P.box_stats(clean, ["tenure"]).first()
    t = np.array([r[0] for r in clean.select("tenure").collect()])
    assert box["q1"] == np.quantile(t, 0.25) and box["outliers"] == 0
    top = P.top_levels_by_median(clean, ["Contract"], "MonthlyCharges", top=2).collect()
    assert len(top) == 2 and [r["position"] for r in sorted(top, key=lambda r: r["median"])] == [
        1, 2]
    with pytest.raises(ValueError):
        P.category_levels(clean, ["customerID"], limit=10)
