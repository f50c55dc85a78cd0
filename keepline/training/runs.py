"""Training runs as tables: predictions, metrics and candidates first, then one manifest row that makes them visible."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..constants import METRICS
from ..sources.tables import log_run_metrics
from .cv import fold_metrics

_MANIFEST = ("run_id string, attempt string, run_name string, start_time timestamp, params map<string,string>, "
             "tags map<string,string>")
_OOF = "run_id string, attempt string, model_name string, fold int, row_id string, y_true int, y_proba double"


def commit_run(spark: SparkSession, root: str, run_id: str, model_name: str, params: dict, oof: DataFrame,
               start_time: datetime, candidates: DataFrame | None = None, tags: dict | None = None, n_folds: int = 10,
               metrics: dict | None = None) -> str:
    """Store a run below ``root`` and return its attempt.

    Everything is written to folders of its own attempt. The manifest, one row in one file, comes last: readers take only
    attempts that a manifest names, so a job that dies before it leaves nothing visible, and one that is run again
    makes a new attempt that replaces the older one of the same run.
    """
    attempt = uuid.uuid4().hex
    mark = [F.lit(run_id).alias("run_id"), F.lit(attempt).alias("attempt")]
    rows = oof.select(*mark, F.lit(model_name).alias("model_name"), "fold", F.col("row_id").cast("string").alias("row_id"),
                      "y_true", "y_proba")
    rows.write.parquet(f"{root}/oof/{attempt}")
    stored = spark.read.schema(_OOF).parquet(f"{root}/oof/{attempt}")
    folds = fold_metrics(stored).unpivot(["fold"], METRICS, "key", "value")
    ts = F.lit(start_time).cast("timestamp").alias("ts")
    steps = folds.select(F.lit(run_id).alias("run_id"), "key", F.col("fold").alias("step"), ts, "value")
    means = steps.groupBy("run_id", "key").agg(F.avg("value").alias("value")).select(
        "run_id", F.concat(F.lit("cv_mean_"), "key").alias("key"), F.lit(0).alias("step"), ts, "value")
    history = steps.unionByName(means)
    if metrics:
        own = spark.createDataFrame([(run_id, k, 0, float(v)) for k, v in metrics.items()],
                                    "run_id string, key string, step int, value double")
        history = history.unionByName(own.select("run_id", "key", "step", ts, "value"))
    good, skipped = log_run_metrics(history)
    good.withColumn("attempt", F.lit(attempt)).coalesce(1).write.parquet(f"{root}/metrics/{attempt}")
    own_tags = {**(tags or {}), **{r["key"]: r["value"] for r in skipped.distinct().collect()}}
    if candidates is not None:
        candidates.select(*mark, "*").coalesce(1).write.parquet(f"{root}/candidates/{attempt}")
    texts = {"model_name": model_name, "cv_folds": str(n_folds), **{k: str(v) for k, v in params.items() if v is not None}}
    row = spark.createDataFrame([(run_id, attempt, model_name, start_time, texts, own_tags)], _MANIFEST)
    row.coalesce(1).write.parquet(f"{root}/runs/{attempt}")
    return attempt


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs by their newest attempt."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/runs/*")
    newest = rows.groupBy("run_id").agg(F.max_by(F.struct(*rows.columns), F.struct("start_time", "attempt")).alias("r"))
    return newest.select("r.*")


def _visible(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    rows = spark.read.schema(schema).parquet(f"{root}/{table}/*")
    return rows.join(read_runs(spark, root).select("attempt"), "attempt", "left_semi").drop("attempt")


def read_run_oof(spark: SparkSession, root: str) -> DataFrame:
    return _visible(spark, root, "oof", _OOF)


def read_run_metrics(spark: SparkSession, root: str) -> DataFrame:
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RUN_METRICS.fields)
    return _visible(spark, root, "metrics", f"{kinds}, attempt string")


def ranked_runs(spark: SparkSession, root: str, metric: str = "recall") -> DataFrame:
    """model_name, run_id, n_folds, mean and deviation of the metric over folds, rank; from the committed tables alone."""
    from pyspark.sql import Window as W

    runs = read_runs(spark, root).select("run_id", F.col("params")["model_name"].alias("model_name"))
    folds = read_run_metrics(spark, root).where(F.col("key") == metric)
    means = folds.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_folds"), F.avg("value").alias("mean"),
                                        F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))
    # One row per run.
    order = W.orderBy(F.desc("mean"), "run_id")
    return runs.join(means, "run_id").select("model_name", "run_id", "n_folds", "mean", "std", F.row_number().over(order).alias("rank"))
