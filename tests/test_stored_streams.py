from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keepline import schemas
from keepline.operators import drift as D
from keepline.operators import scoring as G
from keepline.session import scratch_path
from keepline.sources import tables as T
from keepline.sources import views as V
from keepline.streaming import jobs as J
from keepline.streaming import telemetry as Y

from .conftest import SMALL


def test_customer_file_keeps_blanks(spark, raw):
    path = scratch_path(spark, "csv")
    raw.write.option("header", True).option("ignoreTrailingWhiteSpace", False).option(
        "ignoreLeadingWhiteSpace", False).csv(path)
    back = T.read_customers(spark, path)
    assert back.schema == schemas.CUSTOMERS and back.count() == 180
    assert back.where("TotalCharges = ' '").count() == raw.where("TotalCharges = ' '").count() > 0


def records(spark, rows):
    return spark.createDataFrame(
        [(datetime.fromisoformat(t), f"r{i}", None, i, "m/1", 0.5, int(p >= 0.5), p,
          '{"tenure": %d, "TotalCharges": " "}' % i) for i, (t, p) in enumerate(rows)],
        "created_at timestamp, request_id string, batch_id string, item_index int, "
        "model_uri string, threshold double, y_pred int, y_pred_proba double, features string")


def test_log_window_prunes_folders(spark):
    path = scratch_path(spark, "log")
    T.append_predictions(records(spark, [("2024-01-01 10:00:00", 0.1),
                                         ("2024-03-05 10:00:00", 0.7)]), path)
    T.append_predictions(records(spark, [("2024-03-09 23:00:00", 0.9)]), path)
    log = spark.read.schema(schemas.STORED_LOG).parquet(path)
    T.append_predictions(records(spark, []) if False else log.where("false").drop("id"), path)
    got = T.read_prediction_log(log, 7, datetime(2024, 3, 10))
    assert sorted(r["y_pred_proba"] for r in got.collect()) == [0.7, 0.9]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "created_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    flat = T.flatten_features_json(got, "tenure bigint, TotalCharges string")
    assert {r["TotalCharges"] for r in flat.collect()} == {" "}
    assert log.count() == 3


def test_incomplete_folds_fail(spark):
    rows = [("r1", "m", f, i, 1, 0.5) for f in range(3) for i in range(2)]
    path = scratch_path(spark, "oof")
    T.write_oof(spark.createDataFrame(rows, schemas.OOF), path)
    assert T.read_oof(spark, path, "r1", 3).count() == 6
    with pytest.raises(Exception, match="incomplete"):
        T.read_oof(spark, path, "r1", 4).collect()


def test_run_log_rules(spark):
    df = spark.createDataFrame([("r", "a", 1.0), ("r", "b", float("nan")),
                                ("r", "c", float("inf")), ("r", "d", None)],
                               "run_id string, key string, value double")
    good, tags = T.log_run_metrics(df)
    assert [r["key"] for r in good.collect()] == ["a"]
    assert {r["key"] for r in tags.collect()} == {"metric_skipped_b", "metric_skipped_c"}
    runs = spark.createDataFrame([("r", {"x": "1", "y": None}, {"t": "old", "u": "1"}),
                                  ("s", {}, {"t": "old"})],
                                 "run_id string, params map<string,string>, "
                                 "tags map<string,string>")
    assert T.log_run_params(runs).first()["params"] == {"x": "1"}
    new = spark.createDataFrame([("r", "t", "new")], "run_id string, key string, value string")
    got = {r["run_id"]: r["tags"] for r in T.log_run_tags(runs, new).collect()}
    assert got == {"r": {"t": "new", "u": "1"}, "s": {"t": "old"}}


def test_baseline_round_trip(spark):
    scored = spark.createDataFrame([(1, 2.0, "3", 0.5), (2, None, " ", 0.6)],
                                   "tenure int, MonthlyCharges double, TotalCharges string, "
                                   "y_pred_proba double")
    path = scratch_path(spark, "baseline")
    T.make_baseline(scored, path, "m/9")
    values, meta = T.read_baseline(spark, path)
    assert tuple(meta.first()) == ("m/9", 2) and values.count() == 8
    assert values.where("feature = 'TotalCharges'").agg(F.count("value")).first()[0] == 1


@pytest.fixture(scope="module")
def stream(spark):
    return lambda: V.telemetry_of(J.file_stream(spark, f"{SMALL}/event[s].parquet",
                                                schemas.EVENTS))


@pytest.mark.parametrize("job", [Y.request_counts, Y.latency_histogram, Y.error_rate])
def test_stream_equals_batch_on_closed_windows(spark, stream, job):
    batch = V.telemetry(spark, SMALL)
    last = batch.agg(F.max("ts") - F.expr("interval 10 minutes")).first()[0]
    want = job(batch).where(F.col("window_end") <= F.lit(str(last)).cast("timestamp"))
    got = J.drain(job(stream()), "test-stream")
    cols = [c for c in got.columns if c != "latency_sum"]
    assert got.count() > 0
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0


@pytest.mark.parametrize("job,size", [
    (Y.predicted_class_counts, "1 hour"), (Y.error_rate, "10 minutes"), (Y.sink_histogram, "1 hour")])
def test_drained_input_equals_batch_for_all_windows(spark, job, size):
    def source(streaming):
        return V.telemetry_of(J.file_rows(spark, f"{SMALL}/event[s].parquet", schemas.EVENTS, streaming))

    got, want = J.drain_all(source, job, "test-all", size), job(source(False))
    cols = [c for c in got.columns if c != "latency_sum"]
    assert got.count() == want.count() > 0
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_drained_short_input_has_only_open_windows(spark):
    path = scratch_path(spark, "short")
    spark.range(30).select(F.timestamp_seconds("id").alias("ts")).write.parquet(path)

    def source(streaming):
        return J.file_rows(spark, path, spark.read.parquet(path).schema, streaming)

    def job(df):
        timed = df.withWatermark("ts", "1 minute") if df.isStreaming else df
        w = F.window("ts", "20 seconds")
        return timed.groupBy(w.alias("w")).count().select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count")

    rows = J.drain_all(source, job, "test-short", "20 seconds").collect()
    assert sorted(r["count"] for r in rows) == [10, 20]


def test_bucket_quantiles(spark):
    df = spark.createDataFrame([(t, 0.001 * v) for t, v in enumerate(range(1, 101))],
                               "t int, latency_s double").withColumn(
        "ts", F.timestamp_seconds(F.col("t")))
    r = Y.latency_quantiles(df, keys=(), size="1 hour").first()
    assert r["p50"] == pytest.approx(0.05) and r["p95"] == pytest.approx(0.095)
    slow = df.withColumn("latency_s", F.lit(9.0))
    r = Y.latency_quantiles(slow, keys=(), size="1 hour").first()
    assert r["p95"] == 5.0 and r["alert"] == 1


def test_stream_scoring_is_idempotent_per_batch(spark, raw):
    source, base = scratch_path(spark, "requests"), scratch_path(spark, "scores")
    V.score_requests_of(raw.withColumn("customerID", F.monotonically_increasing_id()
                                       .cast("string"))).write.parquet(source)

    def score(batch):
        return G.score_requests(batch, lambda x: x.withColumn("y_pred_proba", F.lit(0.4)),
                                "m/1", index_by=None)

    for _ in range(2):
        requests = J.file_stream(spark, source, schemas.SCORE_REQUEST)
        J.stream_score(requests, score, f"{base}/log", f"{base}/bad",
                       f"{base}/checkpoint").awaitTermination()
    good = spark.read.parquet(f"{base}/log").count()
    bad = spark.read.parquet(f"{base}/bad").count()
    assert good + bad == 180 and good > 0 and bad > 0


def test_rolling_drift_equals_batch(spark):
    orders = V.table(spark, SMALL, "orders")
    log = orders.select(F.col("o_orderdate").cast("timestamp").alias("created_at"),
                        "o_totalprice")
    expected = orders.select(F.lit("o_totalprice").alias("feature"),
                             F.col("o_totalprice").alias("value"))
    edges = D.baseline_edges(expected)
    base = D.bin_counts(expected, edges)
    stream = J.file_stream(spark, f"{SMALL}/order[s].parquet", schemas.ORDERS).select(
        F.col("o_orderdate").cast("timestamp").alias("created_at"), "o_totalprice")
    counts = J.drain(J.windowed_bin_counts(stream, edges, ["o_totalprice"]), "test-drift")
    got = J.stream_drift(counts, edges, base)
    batch = J.stream_drift(J.windowed_bin_counts(log, edges, ["o_totalprice"]), edges, base)
    both = got.join(batch.withColumnRenamed("psi", "again"),
                    ["window_start", "window_end", "feature"])
    assert got.count() == both.count() > 100
    assert both.where("abs(psi - again) > 1e-9").count() == 0
