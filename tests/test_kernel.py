"""The kernel machine of all folds side by side, held against the Spark one per fold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepline.operators import models as L
from keepline.training import cv
from keepline.training import kernel as K
from keepline.training.design import fold_design


@pytest.fixture(scope="module")
def design(training):
    """With some labels turned over, as rows that a plane parts leave nothing to weigh up."""
    turned = F.when(F.xxhash64("customerID") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label"))
    return fold_design(training.withColumn("label", turned), 2)


def test_picked_slots_are_those_of_the_whole_row(design):
    x = np.array([r["x"] for r in design.rows.select("x").collect()])
    x[::7, :] = np.nan
    for of in design.shape.learned:
        whole = design.shape.scaled(x, of)
        for pick in (np.arange(whole.shape[1]), of.best(15)):
            np.testing.assert_allclose(design.shape.picked(x, of, pick), whole[:, pick], rtol=1e-12, atol=1e-12)


def test_objective_is_as_low_as_the_one_of_spark(design):
    """Same landmarks, same loss and penalty: the value reached is Spark's or lower."""
    found, fitted = K.fit_kernel(design, {"gamma": 0.05, "C": 1.0, "k_best": 15}, [0], size=24)
    rows = design.encoded(0, 15).where("fold <> 0")
    model = L.kernel_svm(size=24, gamma=0.05).fit(rows)
    np.testing.assert_array_equal(np.array(model.stages[0].getOrDefault("marks")), found[0].marks.ravel())
    mapped = model.stages[0].transform(rows).select("kernel", "label").collect()
    z, y = np.array([r["kernel"].toArray() for r in mapped]), np.array([2 * r["label"] - 1 for r in mapped])
    own = found[0]
    np.testing.assert_allclose(own.scales, 1 / z.std(axis=0, ddof=1), rtol=1e-4)

    def value(scaled, offset):
        return np.maximum(0, 1 - y * (z @ (scaled * own.scales) + offset)).mean() + (scaled @ scaled) / (2 * len(y))

    ours = fitted[0]
    theirs = model.stages[1].coefficients.toArray() / own.scales
    a = value(ours[:-1], ours[-1] - (ours[:-1] * own.scales) @ own.means)
    b = value(theirs, model.stages[1].intercept)
    assert a <= b * 1.01


def test_machines_of_all_folds_take_a_pass_a_round(spark, design):
    """One job a round, whatever the number of folds; Spark's own takes that many for each."""
    before = K.summed
    calls = []
    K.summed = lambda *a, **k: calls.append(len(a[2])) or before(*a, **k)
    try:
        oof = K.kernel_out_of_fold(design, size=24, rounds=20, gamma=0.05, k_best=15).toPandas()
    finally:
        K.summed = before
    assert len(oof) == 180 and oof["row_id"].is_unique and oof["y_proba"].between(0, 1).all()
    assert max(calls) == 2 and len(calls) < 90
    spark_own = cv.spark_out_of_fold(design, "SVC_rbf", 15, gamma=0.05, size=24, max_iter=20).toPandas()
    both = oof.merge(spark_own, on=["row_id", "fold", "y_true"])
    assert len(both) == 180
    assert np.corrcoef(both["y_proba_x"], both["y_proba_y"])[0, 1] > 0.95
