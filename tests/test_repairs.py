"""Faults that were found once and must not come back."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keepline import schemas
from keepline.operators import models as L
from keepline.operators.encoding import KBestSelector
from keepline.operators.features import apply_bins
from keepline.sources import tables


def test_bins_of_many_edges(spark):
    df = spark.range(1).select(F.sequence(F.lit(0), F.lit(5000)).cast("array<double>").alias("e"))
    row = df.select(apply_bins(F.lit(4500.5), F.col("e")).alias("b"),
                    apply_bins(F.lit(-1.0), F.col("e")).alias("low"),
                    apply_bins(F.lit(9e9), F.col("e")).alias("high")).first()
    assert (row["b"], row["low"], row["high"]) == (4500, 0, 4999)


@pytest.fixture(scope="module")
def points(spark):
    rows = [(float(i % 2), Vectors.dense([i % 2 + (i * 37 % 11) / 6, (i * 53 % 13) / 9]), 1.0) for i in range(120)]
    return spark.createDataFrame(rows, ["label", "features", "w_none"])


def test_inverse_penalty_changes_the_fit(points):
    fits = [L.logreg(C=c).fit(points).coefficients.toArray() for c in (0.01, 100.0)]
    assert abs(fits[0]).sum() < 0.5 * abs(fits[1]).sum()
    twice = L.logreg(C=0.05).fit(points.union(points)).coefficients.toArray()
    once = L.logreg(C=0.1).fit(points).coefficients.toArray()
    # The penalty follows the rows of the fit; the sample deviation differs a little.
    assert abs(twice - once).max() < 1e-2


def test_kernel_machine_uses_its_penalty(points):
    fits = [L.kernel_svm(size=16, max_iter=20, C=c).fit(points).stages[1].coefficients.toArray() for c in (0.01, 100.0)]
    assert abs(fits[0]).sum() < 0.5 * abs(fits[1]).sum()


def test_learning_rate_changes_the_network(points):
    fits = [L.mlp(hidden_layers=[3], max_epochs=5, learning_rate=r).fit(points).weights.toArray() for r in (1e-4, 1.0)]
    assert abs(fits[0] - fits[1]).max() > 1e-3


def test_selector_keeps_a_two_valued_scaled_slot(spark):
    rows = [(float(i % 2), Vectors.dense([0.9 if i % 2 else -0.3, (i * 7 % 10) / 10])) for i in range(200)]
    df = spark.createDataFrame(rows, ["label", "varying"])
    assert KBestSelector(k=1).fit(df).getOrDefault("indices") == [0]


def test_absent_and_incomplete_runs_fail(spark, tmp_path):
    path = f"{tmp_path}/oof"
    kinds = dict(spark.createDataFrame([], schemas.OOF).dtypes)
    rows = spark.range(8).select(*(
        F.lit("r1").alias(c) if c == "run_id" else (F.col("id") % 2 + 50).cast(t).alias(c) if c == "fold"
        else F.lit("1").cast(t).alias(c) for c, t in kinds.items()))
    tables.write_oof(rows, path)
    with pytest.raises(ValueError, match="no out-of-fold rows"):
        tables.read_oof(spark, path, "nobody")
    with pytest.raises(Exception, match="incomplete"):
        tables.read_oof(spark, path, "r1").collect()
