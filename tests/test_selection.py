import pytest
from pyspark.sql import functions as F

from keepline import schemas
from keepline.functions import pvalues as P
from keepline.operators import selection as S


def table(spark, **models):
    rows = [(m, i, float(v)) for m, vs in models.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "model_name string, fold int, value double")


def test_tails_at_table_values():
    for df, x in ((1, 3.841459), (2, 5.991465), (3, 7.814728), (4, 9.487729), (7, 14.06714)):
        assert P.chi2_tail(x, df) == pytest.approx(0.05, abs=1e-6)
    for k, q in ((2, 2.771808), (3, 3.314493), (5, 3.857656), (8, 4.285847)):
        assert P.studentized_range_tail(q, k) == pytest.approx(0.05, abs=1e-4)
    assert P.signed_rank_tail(range(1, 11), 0, 0) == pytest.approx(2 / 1024)
    assert P.signed_rank_tail([1.5, 1.5, 3], 0, 1) == pytest.approx(0.25)
    assert P.signed_rank_tail([], 0, 3) == 1.0
    many = P.signed_rank_tail([float(i // 2) for i in range(2, 62)], 500.0, 0)
    assert 0 < many < 1


UP = [0.80, 0.82, 0.81, 0.85, 0.79, 0.83, 0.84, 0.86, 0.78, 0.87]


def test_paired_test(spark):
    better = [v + 0.01 + i * 0.001 for i, v in enumerate(UP)]
    r = S.wilcoxon_test(table(spark, a=better, b=UP), "a", "b").first()
    assert r["stat"] == 0.0 and r["p_value"] == pytest.approx(2 / 1024) and r["significant"] == 1
    assert r["mean_diff"] > 0 and r["cohens_d"] > 0
    same = S.wilcoxon_test(table(spark, a=UP, b=UP), "a", "b").first()
    assert (same["stat"], same["p_value"], same["cohens_d"]) == (0.0, 1.0, 0.0)


def test_friedman_by_hand(spark):
    s = table(spark, a=[1, 1, 1, 1], b=[2, 2, 2, 3], c=[3, 3, 3, 2])
    r = S.friedman_test(s).first()
    assert r["friedman_stat"] == pytest.approx(6.5) and r["p_value"] == pytest.approx(0.0387742,
                                                                                    abs=1e-6)
    assert S.friedman_test(table(spark, a=[1, 2], b=[2, 1])).count() == 0
    tied = S.friedman_test(table(spark, a=[1, 1, 2], b=[1, 2, 3], c=[2, 3, 4])).first()
    # rank sums 3.5, 5.5 and 9 give 31/6; one tied pair divides by 1 - 6/72
    assert tied["friedman_stat"] == pytest.approx(31 / 6 / (1 - 6 / 72))
    pairs = S.nemenyi_test(s).collect()
    assert len(pairs) == 6
    p = {(x["model_a"], x["model_b"]): x["p_value"] for x in pairs}
    assert p["a", "b"] == p["b", "a"] and p["a", "c"] < p["b", "c"]


def test_winner_rules(spark):
    better = [v + 0.01 + i * 0.001 for i, v in enumerate(UP)]
    s = table(spark, base=UP, new=better, bad=[v - 0.2 for v in UP])
    r = S.decide_winner(s, "base").first()
    assert (r["winner"], r["loser"], r["duel_a"]) == ("new", "base", "new")
    assert r["reason"] == "challenger_significantly_better_than_baseline"
    r = S.decide_winner(s, "new").first()
    assert (r["winner"], r["loser"]) == ("new", "base")
    r = S.decide_winner(s, None, "top2_duel").first()
    assert (r["winner"], r["decision"]) == ("new", "top2_duel") and r["baseline"] is None
    close = table(spark, x=UP, y=[v + (0.001 if i % 2 else -0.0015) for i, v in enumerate(UP)])
    r = S.decide_winner(close, None, "top2_duel").first()
    assert (r["winner"], r["reason"]) == ("y", "no_sig_diff_choose_top2")
    r = S.decide_winner(s, "gone").first()
    assert r["decision"] == "top2_duel_fallback_no_baseline" and r["winner"] == "new"
    r = S.decide_winner(table(spark, base=UP), "base").first()
    assert (r["winner"], r["reason"], r["p_value"]) == ("base", "only_baseline_left", None)
    r = S.decide_winner(table(spark, x=UP), "base").first()
    assert (r["winner"], r["reason"]) == ("x", "baseline_not_eligible")
    with pytest.raises(Exception, match="two models"):
        S.decide_winner(table(spark, x=UP), None, "top2_duel").collect()


def test_gates(spark):
    s = table(spark, base=[0.5, 0.6], ok=[0.6, 0.6], low=[0.1, 0.2])
    assert {r[0] for r in S.relative_gate(s, "base", 0.02).select("model_name").collect()} == {
        "ok"}
    with pytest.raises(Exception, match="not among the models"):
        S.relative_gate(s, "gone").collect()


def test_best_run_casts_parameters(spark):
    def run(i, score, **params):
        return (i, i, None, params, {}, score)

    schema = "run_id string, run_name string, start_time timestamp, " \
        "params map<string,string>, tags map<string,string>, best_cv_score double"
    df = spark.createDataFrame([
        run("RUN123", 0.97, search_type="randomized", model__max_depth="4",
            model__n_estimators="200", model__learning_rate="0.05", select_kbest__k="15"),
        run("LOW", 0.5, search_type="randomized", model__max_depth="9"),
        run("OTHER", 0.99, search_type="grid", model__max_depth="1")], schema)
    rows = S.best_run(df).collect()
    assert {r["run_id"] for r in rows} == {"RUN123"} and rows[0]["score"] == 0.97
    v = {r["name"]: (r["text"], r["int_value"], r["double_value"]) for r in rows}
    assert v["max_depth"] == (None, 4, None) and v["n_estimators"] == (None, 200, None)
    assert v["learning_rate"] == (None, None, 0.05) and v["select_kbest__k"] == (None, 15, None)


def test_fold_metric_needs_every_fold(spark):
    rows = [("a", "recall", s, t, float(s + t)) for s in range(10) for t in (0, 1)]
    rows += [("b", "recall", s, 0, 1.0) for s in range(9)] + [("a", "recall", 99, 0, 5.0)]
    df = spark.createDataFrame(rows, "run_id string, key string, step int, t int, value double") \
        .withColumn("ts", F.timestamp_seconds("t"))
    got = S.fold_metric(df.select(*schemas.RUN_METRICS.names), "recall").collect()
    assert {r["run_id"] for r in got} == {"a"} and len(got) == 10
    assert all(r["value"] == r["fold"] + 1 for r in got)
