"""Service telemetry as windowed aggregates.

Each function takes a table or a stream with an event-time column; on a stream it adds a
watermark, so closed windows are emitted once and their state is dropped.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import HTTP_BUCKETS, INFERENCE_BUCKETS, SINK_BUCKETS
from ..functions.expressions import ratio

DELAY = "10 minutes"


def _windowed(df: DataFrame, keys, size: str, slide: str | None, delay: str, ts: str):
    timed = df.withWatermark(ts, delay) if df.isStreaming else df
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return timed.groupBy(w.alias("window"), *keys)


def _flat(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"),
                     *[c for c in df.columns if c != "window"])


def request_counts(df: DataFrame, size: str = "1 hour", slide=None, delay=DELAY, ts="ts"
                   ) -> DataFrame:
    return _flat(_windowed(df, ["method", "path", "status_code"], size, slide, delay, ts)
                 .agg(F.count(F.lit(1)).alias("n")))


def predicted_class_counts(df: DataFrame, size: str = "1 hour", slide=None, delay=DELAY,
                           ts="ts") -> DataFrame:
    rows = df.where(F.col("predicted_class").isNotNull())
    return _flat(_windowed(rows, ["path", "predicted_class"], size, slide, delay, ts)
                 .agg(F.count(F.lit(1)).alias("n")))


def sink_status_counts(df: DataFrame, size: str = "1 hour", slide=None, delay=DELAY, ts="ts"
                       ) -> DataFrame:
    rows = df.where(F.col("insert_status").isNotNull())
    return _flat(_windowed(rows, ["insert_status"], size, slide, delay, ts)
                 .agg(F.count(F.lit(1)).alias("n")))


def latency_histogram(df: DataFrame, buckets=HTTP_BUCKETS, keys=("method", "path"),
                      value: str = "latency_s", size: str = "1 hour", slide=None, delay=DELAY,
                      ts="ts") -> DataFrame:
    """Cumulative counts ``le`` per bound (an array in bucket order), with sum and count."""
    v = F.col(value)
    agg = _windowed(df, list(keys), size, slide, delay, ts).agg(
        F.array(*[F.count_if(v <= b) for b in buckets]).alias("le"),
        F.sum(v).alias("latency_sum"), F.count(v).alias("latency_count"))
    return _flat(agg)


def inference_histogram(df: DataFrame, **kw) -> DataFrame:
    """Time the model took, over all scored requests of a window."""
    return latency_histogram(df.where(F.col("inference_s").isNotNull()), INFERENCE_BUCKETS, (),
                             "inference_s", **kw)


def sink_histogram(df: DataFrame, **kw) -> DataFrame:
    """Time the prediction log took to store a record, by outcome."""
    return latency_histogram(df.where(F.col("sink_s").isNotNull()), SINK_BUCKETS, ("insert_status",),
                             "sink_s", **kw)


def histogram_rows(histogram: DataFrame, buckets=HTTP_BUCKETS) -> DataFrame:
    """One row per bound: ``bound, n``."""
    bounds = F.array(*[F.lit(float(b)) for b in buckets])
    rest = [c for c in histogram.columns if c != "le"]
    return histogram.select(*rest, F.inline(F.arrays_zip(bounds.alias("bound"),
                                                         F.col("le").alias("n"))))


def bucket_quantile(q: float, le="le", count="latency_count", buckets=HTTP_BUCKETS):
    """Quantile interpolated inside its bucket; the last bound when it lies above all."""
    target = F.lit(float(q)) * F.col(count)
    bounds = F.array(*[F.lit(float(b)) for b in [0.0, *buckets]])
    counts = F.concat(F.array(F.lit(0).cast("long")), F.col(le))
    # first bucket whose cumulative count reaches the target
    i = F.size(F.filter(F.col(le), lambda c: c < target))
    lo, hi = F.get(bounds, i), F.get(bounds, i + 1)
    below, upto = F.get(counts, i), F.get(counts, i + 1)
    inside = lo + (hi - lo) * ratio(target - below, upto - below)
    return F.when(F.col(count) == 0, F.lit(None).cast("double")).when(
        i >= len(buckets), F.lit(float(buckets[-1]))).otherwise(inside)


def latency_quantiles(df: DataFrame, quantiles=(0.5, 0.95, 0.99), limit: float = 0.3,
                      buckets=HTTP_BUCKETS, size: str = "10 minutes", **kw) -> DataFrame:
    """p50, p95 and p99 per window with an alert when p95 is above the limit."""
    hist = latency_histogram(df, buckets, size=size, **kw)
    named = hist.withColumns({f"p{round(q * 100)}": bucket_quantile(q, buckets=buckets)
                              for q in quantiles})
    return named.withColumn("alert", F.coalesce(F.col("p95") > limit, F.lit(False))
                            .cast("int")).drop("le")


def error_rate(df: DataFrame, size: str = "10 minutes", slide: str | None = "1 minute",
               limit: float = 0.01, delay=DELAY, ts="ts") -> DataFrame:
    """Share of 5xx and 4xx answers in a sliding window; alert above ``limit`` 5xx."""
    status = F.col("status_code")
    agg = _windowed(df, [], size, slide, delay, ts).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(status.between(500, 599)).alias("n_5xx"),
        F.count_if(status.between(400, 499)).alias("n_4xx"))
    return _flat(agg).withColumns({
        "rate_5xx": ratio("n_5xx", "n"), "rate_4xx": ratio("n_4xx", "n"),
        "alert": (ratio("n_5xx", "n") > limit).cast("int")})


def invalid_input_rate(checked: DataFrame, size: str = "1 hour", slide=None, delay=DELAY,
                       ts="ts", raw: str = "raw_total", coerced: str = "TotalCharges"
                       ) -> DataFrame:
    """Share of rejected rows and of values lost when read as numbers.

    ``checked`` is the output of ``validate_rows`` with the raw text beside the number.
    """
    agg = _windowed(checked, [], size, slide, delay, ts).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.size("errors") > 0).cast("double")).alias("rejected_rate"),
        F.avg((F.col(raw).isNotNull() & F.col(coerced).isNull()).cast("double"))
        .alias("coerced_null_rate"))
    return _flat(agg)
