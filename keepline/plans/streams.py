"""Streaming queries: each runs its stream over all input and returns what was written."""

from pyspark.sql import functions as F

from .. import schemas
from ..constants import HTTP_BUCKETS, INFERENCE_BUCKETS, SINK_BUCKETS
from ..operators import cleaning as C
from ..operators import drift as D
from ..operators import scoring as G
from ..session import scratch_path
from ..sources import views as V
from ..streaming import jobs as J
from ..streaming import telemetry as Y
from .drifting import _prices, _OLD
from .registry import query
from .sqltext import ctes, psi_sql, r

FMT = "yyyy-MM-dd HH:mm:ss"


def _raw_events(spark, d):
    return lambda streaming: J.file_rows(spark, f"{d}/event[s].parquet", schemas.EVENTS, streaming)


def _events(spark, d):
    return lambda streaming: V.telemetry_of(_raw_events(spark, d)(streaming))


def _text_window(df):
    return df.withColumns({c: F.date_format(c, FMT) for c in ("window_start", "window_end")})


def _out(source, job, name, size="1 hour"):
    return _text_window(J.drain_all(source, job, name, size))


def _w(expr):
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _hourly(keys, figures, source="telemetry", where="true"):
    """One-hour windows of a view."""
    k = "".join(f"{x}, " for x in keys)
    return f"""select {_w("time_bucket(interval 1 hour, ts)")} as window_start,
  {_w("time_bucket(interval 1 hour, ts) + interval 1 hour")} as window_end, {k}{figures}
from {source} where {where}
group by {k}time_bucket(interval 1 hour, ts)"""


@query(ctes("telemetry") + _hourly(["method", "path", "status_code"], "count(*) as n"))
def request_counts(spark, d):
    return _out(_events(spark, d), Y.request_counts, "request-counts")


@query(ctes("telemetry") + _hourly(["path", "predicted_class"], "count(*) as n",
                                   where="predicted_class is not null"))
def predicted_class_counts(spark, d):
    return _out(_events(spark, d), Y.predicted_class_counts, "class-counts")


@query(ctes("telemetry") + _hourly(["insert_status"], "count(*) as n",
                                   where="insert_status is not null"))
def sink_status_counts(spark, d):
    return _out(_events(spark, d), Y.sink_status_counts, "sink-counts")


def _bounds(buckets):
    return ", ".join(f"cast({b} as double)" for b in buckets)


_LE = _bounds(HTTP_BUCKETS)


def _histogram(keys, buckets, value):
    """Cumulative counts per bound of one-hour windows."""
    k = "".join(f"{x}, " for x in keys)
    return ctes("telemetry") + f""", h_ as ({_hourly(keys, f'''sum({value}) as s,
  count(*) as latency_count, list({value}) as vs''', where=f"{value} is not null")})
select window_start, window_end, {k}{r('s')} as latency_sum, latency_count,
  bound, cast(len(list_filter(vs, lambda x: x <= bound)) as bigint) as n
from h_, (select unnest([{_bounds(buckets)}]) as bound)"""


@query(_histogram(["method", "path"], HTTP_BUCKETS, "latency_s"))
def latency_histogram(spark, d):
    return Y.histogram_rows(_out(_events(spark, d), Y.latency_histogram, "latency"))


@query(_histogram([], INFERENCE_BUCKETS, "inference_s"))
def inference_histogram(spark, d):
    return Y.histogram_rows(_out(_events(spark, d), Y.inference_histogram, "inference"), INFERENCE_BUCKETS)


@query(_histogram(["insert_status"], SINK_BUCKETS, "sink_s"))
def sink_histogram(spark, d):
    return Y.histogram_rows(_out(_events(spark, d), Y.sink_histogram, "sink-times"), SINK_BUCKETS)


def _quantile(q):
    return f"""case when latency_count = 0 then null
  when len(list_filter(le, lambda c: c < {q} * latency_count)) >= {len(HTTP_BUCKETS)}
    then {HTTP_BUCKETS[-1]}
  else b[i{q:.2f} + 1] + (b[i{q:.2f} + 2] - b[i{q:.2f} + 1]) * ({q} * latency_count - c[i{q:.2f} + 1])
    / nullif(cast(c[i{q:.2f} + 2] - c[i{q:.2f} + 1] as double), 0) end""".replace("i0.", "i0_")


_WINDOW10 = "time_bucket(interval 10 minute, ts)"


@query(ctes("telemetry") + f""", h_ as (select {_WINDOW10} as w, path, sum(latency_s) as s,
    count(*) as latency_count, [{", ".join(
        f"count(*) filter (latency_s <= {b})" for b in HTTP_BUCKETS)}] as le
  from telemetry group by {_WINDOW10}, path),
x_ as (select *, [cast(0.0 as double), {_LE}] as b, list_prepend(0, le) as c,
    {", ".join(f"len(list_filter(le, lambda c: c < {q} * latency_count)) as i{q:.2f}".replace(
        "i0.", "i0_") for q in (0.5, 0.95, 0.99))} from h_),
y_ as (select *, {_quantile(0.5)} as p50, {_quantile(0.95)} as p95, {_quantile(0.99)} as p99
  from x_)
select {_w('w')} as window_start, {_w('w + interval 10 minute')} as window_end, path,
  {r('s')} as latency_sum, latency_count, {r('p50')} as p50, {r('p95')} as p95,
  {r('p99')} as p99, cast(coalesce(p95 > 0.3, false) as int) as alert from y_""")
def latency_quantiles(spark, d):
    return _out(_events(spark, d), lambda df: Y.latency_quantiles(df, keys=("path",)),
                "latency-quantiles", "10 minutes")


@query(ctes("telemetry") + f""", s_ as (
  select date_trunc('minute', ts) - to_minutes(cast(i as int)) as w, status_code
  from telemetry, (select unnest(range(10)) as i)),
g_ as (select w, count(*) as n, count(*) filter (status_code between 500 and 599) as n_5xx,
    count(*) filter (status_code between 400 and 499) as n_4xx from s_ group by w)
select {_w('w')} as window_start, {_w('w + interval 10 minute')} as window_end, n, n_5xx, n_4xx,
  {r('n_5xx / cast(n as double)')} as rate_5xx, {r('n_4xx / cast(n as double)')} as rate_4xx,
  cast(n_5xx / cast(n as double) > 0.01 as int) as alert from g_""")
def error_rate(spark, d):
    return _out(_events(spark, d), Y.error_rate, "error-rate", "10 minutes")


def _checked_of(events):
    """Events read as requests: a value out of range is rejected, some text is no number."""
    eid = F.col("event_id")
    raw = events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(eid % 7 == 0, "none").otherwise(F.col("value").cast("string"))
        .alias("raw_total"),
        F.col("value").alias("MonthlyCharges"), F.lit(1.0).alias("tenure"))
    typed = raw.withColumn("TotalCharges", F.col("raw_total"))
    return C.validate_rows(C.coerce_numeric(typed, ["TotalCharges"]),
                           ranges={"MonthlyCharges": (0.0, 20.0)}, required_text=[])


@query("with t_ as (select ts, value, event_id from events) "
       + _hourly([], f"""count(*) as n,
  {r('avg(cast(not value between 0 and 20 as int))')} as rejected_rate,
  {r('avg(cast(event_id % 7 = 0 as int))')} as coerced_null_rate""", "t_"))
def invalid_input_rate(spark, d):
    events = _raw_events(spark, d)
    return _out(lambda streaming: _checked_of(events(streaming)), Y.invalid_input_rate, "invalid-input")


@query(f"""with q_ as (select o_orderkey, o_custkey % 73 as tenure,
    o_totalprice / 1000 as MonthlyCharges from orders)
select o_orderkey as customer_id, {r('least(tenure / 100.0, 1.0)')} as y_pred_proba,
  cast(least(tenure / 100.0, 1.0) >= 0.5 as int) as y_pred
from q_ where MonthlyCharges <= 400""")
def stream_score(spark, d):
    orders = J.file_stream(spark, f"{d}/order[s].parquet", schemas.ORDERS)
    requests = orders.select(
        F.col("o_orderkey").cast("string").alias("customer_id"),
        (F.col("o_custkey") % 73).cast("double").alias("tenure"),
        (F.col("o_totalprice") / 1000 * F.lit(2.5)).alias("MonthlyCharges"),
        F.lit(" ").alias("TotalCharges"))
    base = scratch_path(spark, "stream-score")

    def score(batch):
        from .training import _simple_score

        return G.score_requests(batch, _simple_score, "models:/m/1", index_by=None,
                                created_at=F.lit("2024-03-01").cast("timestamp"))

    J.stream_score(requests, score, f"{base}/log", f"{base}/rejected",
                   f"{base}/checkpoint").awaitTermination()
    log = spark.read.schema(schemas.PREDICTION_LOG).parquet(f"{base}/log")
    return log.select(F.get_json_object("features", "$.customer_id").cast("long")
                      .alias("customer_id"), "y_pred_proba", "y_pred")


_DAYS = """select strftime(date_trunc('day', o_orderdate) - to_days(cast(i as int)), '%Y-%m-%d')
    as window_start, 'o_totalprice' as feature, o_totalprice as value
  from orders, (select unnest(range(7)) as i)"""


@query("with " + psi_sql(_OLD, _DAYS, by="window_start") + f"""
select window_start, feature, {r('psi')} as psi, dropped from psi_""")
def stream_drift(spark, d):
    expected, _ = _prices(spark, d)
    edges = D.baseline_edges(expected)

    def log(streaming):
        return J.file_rows(spark, f"{d}/order[s].parquet", schemas.ORDERS, streaming).select(
            F.col("o_orderdate").cast("timestamp").alias("created_at"), "o_totalprice")

    counts = J.drain_all(log, lambda df: J.windowed_bin_counts(df, edges, ["o_totalprice"]),
                         "drift-counts", "7 days", "created_at")
    report = J.stream_drift(counts, edges, D.bin_counts(expected, edges))
    return report.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
                         "feature", "psi", "dropped")
