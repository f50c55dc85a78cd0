import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepline.operators import drift as D


def long(spark, name, values):
    return spark.createDataFrame([(name, float(v) if v is not None else None) for v in values],
                                 "feature string, value double")


def test_two_bins_by_formula(spark):
    """Edges 0, 10, 20: half of the baseline on either side, one in four of the others above."""
    base = [0.0, 4.0, 10.0, 10.0, 14.0, 16.0, 20.0, 20.0]
    frame = long(spark, "x", [v for v in base for _ in range(10)])
    seen = long(spark, "x", [1.0] * 30 + [19.0] * 10 + [99.0] * 3 + [-1.0])
    got = D.psi(frame, seen, n_bins=2).first()
    below = 4 / 8
    want = (0.75 - below) * math.log(0.75 / below) + (0.25 - (1 - below)) * math.log(0.25 / (1 - below))
    assert got["psi"] == pytest.approx(want, abs=1e-9) and got["dropped"] == 4


def test_equal_samples_and_swapped_sides(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(0, 1, 2000).round(2)
    same = D.psi(long(spark, "x", values), long(spark, "x", rng.permutation(values))).first()
    assert same["psi"] == pytest.approx(0.0, abs=1e-12) and same["dropped"] == 0
    near = D.psi(long(spark, "x", values), long(spark, "x", values + 0.2)).first()["psi"]
    far = D.psi(long(spark, "x", values), long(spark, "x", values + 0.8)).first()["psi"]
    assert 0 < near < far


def test_one_value_and_no_value(spark):
    flat = D.psi(long(spark, "x", [5.0] * 30), long(spark, "x", [5.0, 5.0])).first()
    assert flat["psi"] == 0.0
    empty = D.psi(long(spark, "x", range(50)), long(spark, "x", [None])).first()
    assert empty["psi"] is None


def test_report_needs_rows_and_shared_features(spark):
    base = long(spark, "tenure", range(100)).unionByName(long(spark, "other", range(5)))
    log = spark.range(300).select((F.col("id") % 50).cast("double").alias("tenure"))
    report = D.drift_report(base, log).collect()
    assert [r["feature"] for r in report] == ["tenure"] and report[0]["n_rows"] == 300
    assert report[0]["max_psi"] == report[0]["psi"]
    assert D.drift_report(base, log.limit(10)).count() == 0


def test_alerts(spark):
    df = spark.createDataFrame([(0.05, 500), (0.15, 500), (0.3, 500), (0.3, 10), (None, 500)],
                               "max_psi double, n_rows int")
    rows = df.select(D.drift_alert(), D.drift_severity()).collect()
    assert [r[0] for r in rows] == [0, 0, 1, 1, 0]
    assert [r[1] for r in rows] == ["ok", "warning", "critical", "silent", "ok"]
    h = spark.createDataFrame([(i, v) for i, v in enumerate([0.3, 0.25, 0.3, 0.1, 0.3])],
                              "computed_at int, max_psi double")
    got = D.sustained_drift(h).orderBy("computed_at").collect()
    assert [r["retrain"] for r in got] == [0, 0, 1, 0, 0]


def test_distance_of_distributions(spark):
    rng = np.random.default_rng(8)
    e, a = rng.normal(0, 1, 500).round(1), rng.normal(0.5, 1, 400).round(1)
    grid = np.unique(np.concatenate([e, a]))
    want = max(abs((e <= g).mean() - (a <= g).mean()) for g in grid)
    got = D.ks_drift(long(spark, "x", e), long(spark, "x", a)).first()
    assert got["ks"] == pytest.approx(want, abs=1e-12)


def test_stored_days_give_the_report_of_the_log(spark):
    """Three steps, one of them run twice; a window inside; late steps read only their own days."""
    from keepline.operators import drift_state as S
    from keepline.session import scratch_path

    day = F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, cast(id % 9 as int), 5)")
    log = spark.range(900).select(day.alias("created_at"), (F.col("id") * 7 % 100).cast("double").alias("tenure"),
                                  F.when(F.col("id") % 11 > 0, (F.col("id") % 50).cast("string")).alias("TotalCharges"))
    baseline = D.drift_features(log.where("created_at < timestamp '2024-01-03'"))
    root = scratch_path(spark, "state")
    S.store_baseline(baseline, root)
    assert S.last_day(spark, root) is None
    read = [S.update_state(log, root, until) for until in ("2024-01-04", "2024-01-06", "2024-01-06", "2024-02-01")]
    assert read == [300, 200, 0, 400]
    assert str(S.last_day(spark, root)) == "2024-01-09"
    for since, until in (("2024-01-01", "2024-02-01"), ("2024-01-03", "2024-01-08")):
        rows = log.where(F.col("created_at").between(F.lit(since).cast("timestamp"), F.lit(until).cast("timestamp")))
        want = {r["feature"]: (r["psi"], r["dropped"], r["n_rows"], r["max_psi"]) for r in D.drift_report(baseline, rows).collect()}
        got = {r["feature"]: (r["psi"], r["dropped"], r["n_rows"], r["max_psi"])
               for r in S.report_from_state(spark, root, since, until).collect()}
        assert set(got) == {"tenure", "TotalCharges"} and got == {k: pytest.approx(v) for k, v in want.items()}
    q = S.quantiles_from_state(spark, root, "2024-01-01", "2024-01-03", [0.0, 0.5, 1.0]).where("feature = 'tenure'")
    assert [r["q"] for r in q.orderBy("p").collect()][::2] == [
        baseline.where("feature = 'tenure'").agg(f("value")).first()[0] for f in (F.min, F.max)]
    assert S.report_from_state(spark, root, "2025-01-01", "2025-02-01").count() == 0


def test_plans_have_no_nested_loops_and_no_single_partition(spark):
    from keepline.operators import monitoring as N
    from keepline.sources import views as V

    from keepline.functions.ordered import long_format

    orders = long_format(V.table(spark, "/root/testdata/sf0.001", "orders").withColumn(
        "month", F.date_format("o_orderdate", "yyyy-MM")), ["o_totalprice"], ["month"])
    edges = D.baseline_edges(orders.select("feature", "value"))
    counts = D.bin_counts(orders, edges, by=["month"])
    report = D.psi_from_counts(edges, D.bin_counts(orders, edges), counts, ["month"])
    history = report.select("month", F.col("psi").alias("max_psi"))
    windows = history.select("month", F.col("max_psi").alias("recall"), F.col("max_psi").alias("fp_rate"))
    for df in (D.psi(orders, orders), report, D.sustained_drift(history, "month"), N.performance_drop_alert(windows, "month")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    for df in (D.sustained_drift(history, "month"), N.performance_drop_alert(windows, "month")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Window ") <= plan.count("hashpartitioning")
