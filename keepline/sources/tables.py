"""Readers and writers of the stored tables.

Logs are Parquet folders partitioned by day; readers push both the day and the exact time
into the scan. Writers append and never look at what is already there.
"""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..constants import DRIFT_FEATURES, DRIFT_WINDOW_DAYS, N_FOLDS
from ..functions.ordered import long_format
from ..operators.cleaning import coerce_numeric
from ..operators.metrics import confusion_report as _confusion


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer CSV with a header; no schema inference, so blanks survive as text."""
    return spark.read.schema(schemas.CUSTOMERS).option("header", True).csv(path)


# --- prediction log ------------------------------------------------------------------------

def log_records(scored: DataFrame, feature_cols, defaults: dict | None = None) -> DataFrame:
    """Shape scored rows as log records with the raw features as one JSON column."""
    out = scored.withColumn("features", F.to_json(
        F.struct(*feature_cols), {"ignoreNullFields": "false"}))
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, value)
    return out.select(*[
        (F.col(f.name) if f.name in out.columns else F.lit(None)).cast(f.dataType)
        .alias(f.name) for f in schemas.PREDICTION_LOG.fields if f.name != "id"
    ])


def by_date(records: DataFrame, unit: str = "day") -> DataFrame:
    """Add ``created_date`` (the day, or the first day of the month) and bring the rows of
    a date together for writing.

    Rebalancing splits a date with very many rows over several tasks and merges small ones,
    so neither a hot date nor thousands of small files come out.
    """
    dated = records.withColumn("created_date", F.date_trunc(unit, "created_at").cast("date"))
    return dated.hint("rebalance", "created_date")


def append_predictions(records: DataFrame, path: str, unit: str = "day") -> None:
    """Append log records; no input rows add no rows. A long, thin log takes month folders."""
    by_date(records, unit).write.mode("append").partitionBy("created_date").parquet(path)


def read_prediction_log(log: DataFrame, window_days: int = DRIFT_WINDOW_DAYS,
                        as_of: datetime | None = None) -> DataFrame:
    """``created_at, features, y_pred_proba`` of the last ``window_days`` days.

    The date bound is the start of the month, which holds for day and month folders alike;
    folders before it are not read.
    """
    days = F.make_dt_interval(F.lit(window_days))
    if as_of is None:
        rows = log.where(F.col("created_at") >= F.current_timestamp() - days)
        if "created_date" in log.columns:
            rows = rows.where(F.col("created_date") >= F.trunc(F.date_sub(
                F.current_date(), window_days + 1), "month"))
    else:
        start = as_of - timedelta(days=window_days)
        instant = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp")
        rows = log.where((F.col("created_at") >= instant(start))
                         & (F.col("created_at") <= instant(as_of)))
        if "created_date" in log.columns:
            rows = rows.where(F.col("created_date") >= F.lit(start.date().replace(day=1)))
    return rows.select("created_at", "features", "y_pred_proba")


def flatten_features_json(log: DataFrame, fields: str, column: str = "features") -> DataFrame:
    """Replace the JSON column by the named fields, e.g. ``"tenure string, k bigint"``."""
    return log.withColumn("_f", F.from_json(column, fields)).select(
        *[c for c in log.columns if c != column], "_f.*")


# --- drift ---------------------------------------------------------------------------------

def append_drift_metrics(summary: DataFrame, path: str) -> None:
    rows = summary.select(*[F.col(f.name).cast(f.dataType) for f in schemas.DRIFT_METRICS])
    rows.write.mode("append").parquet(path)


def make_baseline(scored: DataFrame, path: str, model_uri: str, features=None) -> None:
    """Write the long baseline and its one-row description from a scored training table."""
    cols = [c for c in (features or DRIFT_FEATURES) if c in scored.columns]
    long_format(coerce_numeric(scored, cols), cols).write.mode("overwrite").partitionBy("feature").parquet(
        f"{path}/values")
    scored.agg(F.lit(model_uri).alias("model_uri"), F.count(F.lit(1)).alias("n_rows")) \
        .write.mode("overwrite").parquet(f"{path}/meta")


def read_baseline(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(values, meta)`` of a stored baseline."""
    values = spark.read.schema(schemas.BASELINE).parquet(f"{path}/values")
    return values, spark.read.schema(schemas.BASELINE_META).parquet(f"{path}/meta")


# --- out-of-fold predictions -----------------------------------------------------------------

def write_oof(oof: DataFrame, path: str) -> None:
    oof.write.mode("append").partitionBy("model_name", "fold").parquet(path)


def read_oof(spark: SparkSession, path: str, run_id: str | None = None,
             n_folds: int = N_FOLDS) -> DataFrame:
    """Out-of-fold rows; a run without all folds, or with a label or score missing, fails
    the query that reads it, and a run that is not there fails at once.

    The check is one grouped count over (run, fold); it reads the label and score columns.
    """
    rows = spark.read.schema(schemas.OOF).parquet(path)
    if run_id is not None:
        rows = rows.where(F.col("run_id") == run_id)
        if rows.isEmpty():
            raise ValueError(f"no out-of-fold rows of run {run_id}")
    folds = rows.groupBy("run_id", "fold").agg(
        F.count("y_true").alias("a"), F.count("y_proba").alias("b"),
        F.count(F.lit(1)).alias("n"))
    runs = folds.groupBy("run_id").agg(
        F.count_if(F.col("fold").between(0, n_folds - 1)).alias("folds"),
        F.max((F.col("a") != F.col("b")).cast("int")).alias("uneven"))
    bad = runs.where((F.col("folds") != n_folds) | (F.col("uneven") == 1))
    message = bad.agg(F.max(F.concat(F.lit("incomplete out-of-fold rows in "), "run_id"))
                      .alias("m"))
    checked = rows.withColumn("_bad", message.scalar())
    ok = F.when(F.col("_bad").isNotNull(), F.raise_error(F.col("_bad"))).otherwise(F.lit(True))
    return checked.where(ok.cast("boolean")).drop("_bad")


# --- run log ---------------------------------------------------------------------------------

def log_run_params(params: DataFrame) -> DataFrame:
    """Drop NULL parameters of a ``run_id, params`` table (values are strings)."""
    return params.withColumn("params", F.map_filter("params", lambda _, v: v.isNotNull()))


def log_run_metrics(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``run_id, key, value`` into loggable rows and tags for NaN or infinite ones."""
    known = values.where(F.col("value").isNotNull())
    good = ~F.isnan("value") & (F.abs("value") < float("inf"))
    tags = known.where(~good).select(
        "run_id", F.concat(F.lit("metric_skipped_"), "key").alias("key"),
        F.lit("nan_or_inf").alias("value"))
    return known.where(good), tags


def log_run_tags(runs: DataFrame, new_tags: DataFrame) -> DataFrame:
    """Add ``run_id, key, value`` tags to the runs; a new value replaces an old one, and of
    several new values the largest counts."""
    single = new_tags.groupBy("run_id", "key").agg(F.max("value").alias("value"))
    grouped = single.groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("_new"))
    joined = runs.join(grouped, "run_id", "left")
    kept = F.map_filter("tags", lambda k, _: ~F.coalesce(
        F.map_contains_key("_new", k), F.lit(False)))
    return joined.withColumn("tags", F.when(F.col("_new").isNull(), F.col("tags")).otherwise(
        F.map_concat(kept, "_new"))).drop("_new")


def write_cv_results(results: DataFrame, path: str, metric: str) -> None:
    """Candidate table, best first, as CSV (one short row per tried setting)."""
    results.orderBy(F.col(metric).desc()).coalesce(1).write.mode("overwrite").option(
        "header", True).csv(path)


def confusion_report(df: DataFrame, path: str | None = None, y="y_true", y_pred="y_pred"
                     ) -> DataFrame:
    """The 2x2 confusion table, also written as CSV when a path is given."""
    table = _confusion(df, y, y_pred)
    if path is not None:
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return table


def save_pipeline(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
