"""Running streams: sources, sinks, scoring and rolling drift."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..constants import DRIFT_FEATURES, PSI_BINS
from ..functions.ordered import long_format
from ..operators.cleaning import coerce_numeric
from ..operators.drift import bin_counts, psi_from_counts
from ..session import scratch_path
from ..sources.tables import by_date


def file_stream(spark: SparkSession, path: str, schema: StructType,
                max_files: int | None = None) -> DataFrame:
    """Parquet files as a stream; ``path`` is a folder, or a pattern for files or folders."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_rows(spark: SparkSession, path: str, schema: StructType, streaming: bool) -> DataFrame:
    """The same files as a stream or as a table."""
    return file_stream(spark, path, schema) if streaming else spark.read.schema(schema).parquet(path)


def append_closed_windows(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each window once, after the watermark has passed its end."""
    return (stream.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all available input and read back what it wrote."""
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    query = append_closed_windows(stream, f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def rows_of_open_windows(rows: DataFrame, written: DataFrame, size: str, ts: str = "ts"
                         ) -> tuple[DataFrame, str | None]:
    """Rows of a table that can lie in a window which ends after the last written one, and the
    end of that one as text; all rows where nothing was written."""
    last = written.agg(F.date_format(F.max("window_end"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if last is None:
        return rows, None
    since = F.lit(last).cast("timestamp") - F.expr(f"interval {size}")
    return rows.where(F.col(ts).cast("timestamp") >= since), last


def drain_all(source: Callable[[bool], DataFrame], job: Callable[[DataFrame], DataFrame], name: str,
              size: str, ts: str = "ts") -> DataFrame:
    """Windows of a whole finished input: those the watermark has closed come from the stream,
    those still open at its end from one pass of the same job over their own rows.

    ``source(True)`` gives the input as a stream, ``source(False)`` as a table; ``job`` takes
    either. The watermark closes a window for all keys at once, so the open ones are exactly those
    that end later than the last one written. Their rows are found by time, so the pass reads one
    window's length before that, whatever the length of the input.
    """
    written = drain(job(source(True)), name)
    rows, last = rows_of_open_windows(source(False), written, size, ts)
    open_ = job(rows)
    if last is not None:
        open_ = open_.where(F.col("window_end") > F.lit(last).cast("timestamp"))
    return written.unionByName(open_)


def stream_score(requests: DataFrame, score: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
                 log_path: str, rejected_path: str, checkpoint: str) -> StreamingQuery:
    """Score incoming requests into the prediction log; rejected ones go to their own table.

    ``score`` returns accepted log records and rejected requests of a micro-batch. A batch
    that is replayed after a failure overwrites its own ``batch`` folder, so nothing is
    counted twice. The folder's name starts with a hash of the checkpoint, so streams with
    other checkpoints, which count batches from 0 again, leave it alone.
    """
    own = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_no: int) -> None:
        records, bad = score(batch)
        by_date(records).write.mode("overwrite").partitionBy("created_date").parquet(
            f"{log_path}/batch={own}-{batch_no}")
        bad.write.mode("overwrite").parquet(f"{rejected_path}/batch={own}-{batch_no}")

    return (requests.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def windowed_bin_counts(log: DataFrame, edges: DataFrame, features=DRIFT_FEATURES,
                        n_bins: int = PSI_BINS, size: str = "7 days", slide: str = "1 day",
                        delay: str = "1 day", ts: str = "created_at") -> DataFrame:
    """Bin counts per feature and sliding window of a flattened log (table or stream)."""
    timed = log.withWatermark(ts, delay) if log.isStreaming else log
    present = [c for c in features if c in log.columns]
    long = long_format(coerce_numeric(timed, present), present, [ts])
    counts = bin_counts(long, edges, n_bins, [F.window(ts, size, slide).alias("window")])
    return counts.select(F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"), "feature", "bin", "n")


def stream_drift(counts: DataFrame, edges: DataFrame, expected: DataFrame) -> DataFrame:
    """PSI per window and feature from the counts a stream has written.

    ``counts`` has at most one row per window, feature and bin, whatever the traffic.
    """
    return psi_from_counts(edges, expected, counts, ["window_start", "window_end"])
