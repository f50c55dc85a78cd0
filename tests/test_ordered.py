"""Ordered helpers against plain NumPy and pandas, with one group holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keepline.functions.expressions import (
    count_edges, left_closed_bin, literal_edges, parse_double, right_closed_bin,
)
from keepline.functions.ordered import (
    column_modes, column_quantiles, exact_quantiles, running_sums, sample_edges,
)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    n = 6000
    group = np.where(rng.random(n) < 0.7, "hot", rng.choice(list("abc"), n))
    value = np.where(rng.random(n) < 0.4, 1.0, rng.lognormal(0, 4, n).round(3))
    return pd.DataFrame({"g": group, "v": value, "id": np.arange(n)})


@pytest.mark.parametrize("slots", [4, 64, 1024])
def test_running_sums_equal_a_plain_window(spark, skewed, slots):
    counts = skewed.groupby(["g", "v"]).size().rename("n").reset_index()
    df = spark.createDataFrame(counts)
    out = running_sums(df, ["g"], "v", ["n"], slots=slots).toPandas()
    want = counts.sort_values("v")
    want["cum"] = want.groupby("g")["n"].cumsum()
    want["total"] = want.groupby("g")["n"].transform("sum")
    m = out.merge(want, on=["g", "v"])
    assert len(m) == len(counts) == len(out)
    assert (m["cum_n"] == m["cum"]).all() and (m["total_n"] == m["total"]).all()


def test_running_sums_with_null_keys_and_no_keys(spark):
    df = spark.createDataFrame([(None, 2.0, 1), (None, 1.0, 2), ("x", 1.0, 4)],
                               "g string, v double, n int")
    got = {(r["g"], r["v"]): (r["cum_n"], r["total_n"])
           for r in running_sums(df, ["g"], "v", ["n"]).collect()}
    assert got == {(None, 1.0): (2, 3), (None, 2.0): (3, 3), ("x", 1.0): (4, 4)}
    rows = running_sums(df.where("g is null"), [], "v", ["n"]).orderBy("v").collect()
    assert [r["cum_n"] for r in rows] == [2, 3]


def test_ranges_are_balanced_whatever_the_distribution(spark):
    df = spark.range(20000).select(
        F.exp(-F.col("id").cast("double") / 500).alias("v"), F.lit(1).cast("long").alias("n"))
    edges = df.withColumn("e", sample_edges(df, "v", 64).scalar())
    sizes = edges.groupBy(count_edges("v", "e", 64).alias("b")).count().toPandas()["count"]
    assert sizes.max() < 20000 / 64 * 12


def test_quantiles_equal_numpy(spark, skewed):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = exact_quantiles(spark.createDataFrame(skewed), ["g"], "v", probs).toPandas()
    for g, part in skewed.groupby("g"):
        mine = got[got["g"] == g].sort_values("p")["q"].to_numpy()
        np.testing.assert_allclose(mine, np.quantile(part["v"], probs), rtol=1e-12)


def test_quantiles_skip_null_and_nan_and_keep_small_groups(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)],
                               "g string, v double")
    assert [tuple(r) for r in exact_quantiles(df, ["g"], "v", [0.5]).collect()] == [
        ("a", 0.5, 3.0)]


def test_approximate_quantiles_have_the_same_shape(spark, skewed):
    df = spark.createDataFrame(skewed)
    got = column_quantiles(df, ["v", "id"], [0.5], approx=True).toPandas()
    assert set(got["feature"]) == {"v", "id"}
    assert abs(got.set_index("feature").loc["id", "q"] - 3000) < 50


def test_modes_take_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "x"), ("a", "y")],
                               "p string, q string")
    assert {r["feature"]: r["mode"] for r in column_modes(df, ["p", "q"]).collect()} == {
        "p": "a", "q": "x"}


def test_bins_equal_pandas_cut_and_numpy_histogram(spark):
    edges = [0.0, 1.0, 2.5, 7.0]
    xs = [-3.0, 0.0, 0.5, 1.0, 1.1, 2.5, 6.9, 7.0, 9.0, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(
        "x", right_closed_bin("x", literal_edges(edges), 4).alias("r"),
        left_closed_bin("x", literal_edges(edges), 4).alias("l"))
    got = df.collect()
    clipped = pd.Series(xs, dtype=float).clip(0.0, 7.0)
    want = pd.cut(clipped, edges, include_lowest=True, labels=False).fillna(-1).astype(int)
    assert [r["r"] for r in got] == want.tolist()
    hist, _ = np.histogram([x for x in xs if x is not None], bins=edges)
    assert [sum(r["l"] == b for r in got) for b in range(3)] == hist.tolist()
    assert [r["l"] for r in got if r["x"] in (-3.0, 9.0, None)] == [None] * 3


def test_number_parser_is_strict(spark):
    texts = ["1", " 2.5 ", "1e3", ".5", "-4.", "1.0d", "abc", "", " ", "NaN", "0x1F", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(parse_double("t")).collect()] == [
        1.0, 2.5, 1000.0, 0.5, -4.0, None, None, None, None, None, None, None]
