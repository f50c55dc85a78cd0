"""Drift of a growing log from stored daily counts: a run reads the days it has not seen."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DRIFT_FEATURES, DRIFT_MIN_ROWS, PSI_BINS
from ..functions.ordered import long_format
from .cleaning import coerce_numeric
from .drift import baseline_edges, bin_counts, psi_from_counts

_COUNTS = "day date, feature string, bin int, n long"
_DAYS = "day date, feature string, n long, sketch binary"
_EDGES = "feature string, edges array<double>"
_EXPECTED = "feature string, bin int, n long"
#: Size of a day's quantile sketch per feature.
SKETCH = 400


def store_baseline(baseline: DataFrame, root: str, features=DRIFT_FEATURES, n_bins: int = PSI_BINS) -> None:
    """Write bin edges and counts of a long baseline once, and begin an empty state; every later run reads these short
    tables."""
    spark = baseline.sparkSession
    for name, schema in (("counts", _COUNTS), ("days", _DAYS)):
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}/start")
    wanted = baseline.where(F.col("feature").isin(list(features)))
    baseline_edges(wanted, n_bins).select("feature", "edges").coalesce(1).write.parquet(f"{root}/edges")
    edges = read_edges(spark, root)
    bin_counts(wanted, edges, n_bins).select("feature", F.col("bin").cast("int").alias("bin"), "n").coalesce(
        1).write.parquet(f"{root}/expected")


def read_edges(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_EDGES).parquet(f"{root}/edges")


def _stored(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{name}/*")


def last_day(spark: SparkSession, root: str):
    """Newest day whose counts are stored, or None."""
    return _stored(spark, root, "days", _DAYS).agg(F.max("day")).first()[0]


def update_state(log: DataFrame, root: str, until, features=DRIFT_FEATURES, n_bins: int = PSI_BINS,
                 ts: str = "created_at") -> int:
    """Add the days of a flattened log after the last stored one and before ``until`` (a closed day's end).

    One scan of those days gives counts per day, feature and bin, rows per day, and a mergeable quantile sketch per day
    and feature. A log that is stored by day is pruned to them. A step has its own folder, named by where it starts and
    ends, and writes the days table last: a step that died is not counted, and is written over when it is run again.
    Returns the number of rows read.
    """
    spark, day = log.sparkSession, F.to_date(F.col(ts))
    since = last_day(spark, root)
    fresh = log.where(F.col(ts) < F.lit(str(until)).cast("timestamp"))
    if since is not None:
        fresh = fresh.where(F.col(ts) >= F.date_add(F.lit(str(since)).cast("date"), 1).cast("timestamp"))
    present = [c for c in features if c in log.columns]
    long = long_format(coerce_numeric(fresh, present).withColumn("day", day), present, ["day"])
    counts = bin_counts(long, read_edges(spark, root), n_bins, ["day"])
    name = f"{since or 'first'}_{str(until)[:10]}"
    counts.select("day", "feature", F.col("bin").cast("int").alias("bin"), "n").coalesce(1).write.mode(
        "overwrite").parquet(f"{root}/counts/{name}")
    number = F.when(~F.isnan("value"), F.col("value"))
    days = long.groupBy("day", "feature").agg(F.count(F.lit(1)).alias("n"),
                                              F.kll_sketch_agg_double(number, SKETCH).alias("sketch"))
    days.coalesce(1).write.mode("overwrite").parquet(f"{root}/days/{name}")
    return spark.read.schema(_DAYS).parquet(f"{root}/days/{name}").groupBy("feature").agg(
        F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0


def _between(table: DataFrame, since, until) -> DataFrame:
    return table.where((F.col("day") >= F.lit(str(since)).cast("date")) & (F.col("day") < F.lit(str(until)).cast("date")))


def report_from_state(spark: SparkSession, root: str, since, until, min_rows: int = DRIFT_MIN_ROWS) -> DataFrame:
    """``feature, psi, dropped, n_rows, max_psi`` of the stored days from ``since`` to before ``until``; the log is not
    read. Counts of days only add up, so any window of whole days costs one row per day, feature and bin."""
    days, counts = _stored(spark, root, "days", _DAYS), _stored(spark, root, "counts", _COUNTS)
    known = days.select("day", "feature").distinct()
    actual = _between(counts.join(known, ["day", "feature"], "left_semi"), since, until).groupBy("feature", "bin").agg(
        F.sum("n").alias("n"))
    expected = spark.read.schema(_EXPECTED).parquet(f"{root}/expected")
    n_rows = _between(days, since, until).groupBy("feature").agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.max("n"), F.lit(0).cast("long"))).scalar()
    report = psi_from_counts(read_edges(spark, root), expected, actual)
    present = _between(days, since, until).select("feature").distinct()
    report = report.join(present, "feature", "left_semi").withColumn("n_rows", n_rows)
    most = report.agg(F.coalesce(F.max("psi"), F.lit(0.0))).scalar()
    return report.where(F.col("n_rows") >= max(min_rows, 1)).withColumn("max_psi", most)


def quantiles_from_state(spark: SparkSession, root: str, since, until, probs) -> DataFrame:
    """``feature, p, q`` of the stored days, from their merged sketches (exact for up to ``SKETCH`` values)."""
    days = _between(_stored(spark, root, "days", _DAYS), since, until)
    merged = days.groupBy("feature").agg(F.kll_merge_agg_double("sketch").alias("s"))
    found = merged.where(F.kll_sketch_get_n_double("s") > 0)
    grid = F.array(*map(F.lit, map(float, probs)))
    return found.select("feature", F.inline(F.arrays_zip(
        grid.alias("p"), F.kll_sketch_get_quantile_double("s", grid).alias("q"))))
