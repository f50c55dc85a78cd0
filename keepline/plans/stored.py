"""Queries of readers, writers and the run log.

Writers put their table into a new folder below the shared scratch folder; the query
returns what a reader finds there.
"""

from datetime import datetime

from pyspark.sql import functions as F

from .. import schemas
from ..operators import metrics as M
from ..operators import models as L
from ..session import scratch_path
from ..sources import tables as T
from ..sources import views as V
from .drifting import _REPORT, _summary
from .registry import query
from .sqltext import ctes, metric_sql, r


@query(ctes("customers") + f""" select * replace ({r('MonthlyCharges')} as MonthlyCharges)
from customers""")
def read_customers(spark, d):
    path = scratch_path(spark, "customers")
    V.customers(spark, d).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return T.read_customers(spark, path)


def _stored_log(spark, d):
    path = scratch_path(spark, "prediction-log")
    T.append_predictions(V.prediction_log(spark, d).drop("id"), path, unit="month")
    return spark.read.schema(schemas.STORED_LOG).parquet(path)


@query(ctes("log") + f""" select strftime(created_at, '%Y-%m-%d') as day, count(*) as n,
  {r('avg(y_pred_proba)')} as mean_proba from log
where created_at >= timestamp '1999-01-01' - interval 365 day
  and created_at <= timestamp '1999-01-01' group by 1""")
def read_prediction_log(spark, d):
    rows = T.read_prediction_log(_stored_log(spark, d), 365, datetime(1999, 1, 1))
    return rows.groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("y_pred_proba").alias("mean_proba"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def flatten_features_json(spark, d):
    e = V.table(spark, d, "events").select("event_id", "props")
    return T.flatten_features_json(e, "k bigint", "props")


@query(ctes("log") + f""" select request_id, cast(null as varchar) as batch_id, item_index,
  model_uri, threshold, cast(y_pred_proba >= 0.5 as int) as y_pred,
  {r('y_pred_proba')} as y_pred_proba, o_custkey, {r('o_totalprice')} as o_totalprice from log""")
def append_predictions(spark, d):
    flat = T.flatten_features_json(_stored_log(spark, d),
                                   "o_custkey bigint, o_totalprice double")
    return flat.drop("id", "created_at", "created_date")


@query(_REPORT + f""" select cast(7 as int) as window_days, n_rows, feature, {r('psi')} as psi,
  {r('max_psi')} as max_psi, 'models:/m/1' as baseline_model_uri,
  'models:/m/2' as model_uri_current from re_""")
def append_drift_metrics(spark, d):
    path = scratch_path(spark, "drift-metrics")
    T.append_drift_metrics(_summary(spark, d), path)
    stored = spark.read.schema(schemas.DRIFT_METRICS).parquet(path)
    return stored.select("window_days", "n_rows", F.explode("psi").alias("feature", "psi"),
                         "max_psi", "baseline_model_uri", "model_uri_current")


def _baseline(spark, d):
    path = scratch_path(spark, "baseline")
    scored = T.flatten_features_json(
        V.feature_log(spark, d), "tenure double, MonthlyCharges double, TotalCharges string")
    T.make_baseline(scored, path, "models:/m/1")
    return T.read_baseline(spark, path)


@query(ctes("flog") + f""" select feature, count(*) as n, count(value) as n_values,
  {r('avg(value)')} as mean from flong group by feature""")
def make_baseline(spark, d):
    values, _ = _baseline(spark, d)
    return values.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"),
        F.avg("value").alias("mean"))


@query(" select 'models:/m/1' as model_uri, count(*) as n_rows from orders")
def read_baseline(spark, d):
    return _baseline(spark, d)[1]


def _stored_oof(spark, d):
    path = scratch_path(spark, "oof")
    T.write_oof(V.oof(spark, d), path)
    return path


@query(ctes("oof") + f""" select run_id, model_name, fold, row_id, y_true,
  {r('y_proba')} as y_proba from oof""")
def write_oof(spark, d):
    return spark.read.schema(schemas.OOF).parquet(_stored_oof(spark, d))


@query(ctes("oof") + f""" select fold, count(*) as n, sum(y_true)::bigint as positives,
  {r('avg(y_proba)')} as mean_proba from oof where run_id = 'run-m2' group by fold""")
def read_oof(spark, d):
    return T.read_oof(spark, _stored_oof(spark, d), "run-m2").groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y_true").alias("positives"),
        F.avg("y_proba").alias("mean_proba"))


@query(ctes("oof") + "," + metric_sql("oof", "model_name", "fold") + f"""
select model_name, {r('avg(recall)')} as mean_recall, {r('stddev_samp(recall)')} as std_recall,
  {r('avg(roc_auc)')} as mean_roc_auc, {r('stddev_samp(roc_auc)')} as std_roc_auc
from met_ group by model_name""")
def write_cv_results(spark, d):
    folds = M.compute_metrics(V.oof(spark, d), ["model_name", "fold"])
    results = folds.groupBy("model_name").agg(*[
        f(m).alias(f"{n}_{m}") for m in ("recall", "roc_auc")
        for n, f in (("mean", F.avg), ("std", F.stddev_samp))])
    path = scratch_path(spark, "cv-results")
    T.write_cv_results(results, path, "mean_recall")
    return spark.read.schema(results.schema).option("header", True).csv(path)


@query(ctes("runs") + """ select run_id, (model_name is not null)::int + (cv_folds is not null)::int
  + (n_folds is not null)::int + (best_config_name is not null)::int
  + (config_name is not null)::int + (search_type is not null)::int + 5 as n_params,
  n_folds from runs""")
def log_run_params(spark, d):
    raw = V.runs(spark, d).select("run_id", F.map_concat("params", F.create_map(
        F.lit("left_out"), F.lit(None).cast("string"))).alias("params"))
    return T.log_run_params(raw).select(
        "run_id", F.size("params").alias("n_params"), F.col("params")["n_folds"].alias("n_folds"))


_EDGE = """case when event_id % 11 = 0 then null when event_id % 13 = 0 then 'NaN'::double
  when event_id % 17 = 0 then 'Infinity'::double else value end"""


@query(f"""with v_ as (select 'run-' || event_id as run_id, event_type as key, {_EDGE} as value
  from events)
select run_id, key, {r('value')} as value, cast(null as varchar) as tag from v_
  where value is not null and not isnan(value) and not isinf(value)
union all select run_id, 'metric_skipped_' || key, null, 'nan_or_inf' from v_
  where isnan(value) or isinf(value)""")
def log_run_metrics(spark, d):
    eid = F.col("event_id")
    values = V.table(spark, d, "events").select(
        F.concat(F.lit("run-"), eid.cast("string")).alias("run_id"),
        F.col("event_type").alias("key"),
        F.when(eid % 11 == 0, None).when(eid % 13 == 0, float("nan"))
        .when(eid % 17 == 0, float("inf")).otherwise(F.col("value")).alias("value"))
    good, tags = T.log_run_metrics(values)
    return good.withColumn("tag", F.lit(None).cast("string")).unionByName(
        tags.select("run_id", "key", F.lit(None).cast("double").alias("value"),
                    F.col("value").alias("tag")))


@query(ctes("runs") + """ select run_id,
  case when hash_ % 4 = 0 then 'final' else stage end as stage,
  case when hash_ % 4 < 2 then 'team-' || hash_ % 3 end as owner
from (select *, cast(substr(run_id, 5) as bigint) as hash_ from runs)""")
def log_run_tags(spark, d):
    runs = V.runs(spark, d)
    eid = F.substring("run_id", 5, 20).cast("long")
    tags = runs.where(eid % 4 < 2).select("run_id", F.lit("owner").alias("key"), F.concat(
        F.lit("team-"), (eid % 3).cast("string")).alias("value")).unionByName(
        runs.where(eid % 4 == 0).select("run_id", F.lit("stage").alias("key"),
                                        F.lit("final").alias("value")))
    return T.log_run_tags(runs, tags).select(
        "run_id", F.col("tags")["stage"].alias("stage"), F.col("tags")["owner"].alias("owner"))


@query(ctes("oof") + """ select 'true_' || y_true as label,
  count(*) filter (y_proba < 0.5) as pred_0, count(*) filter (y_proba >= 0.5) as pred_1
from oof group by y_true""")
def confusion_report(spark, d):
    scored = V.oof(spark, d).withColumn("y_pred", (F.col("y_proba") >= 0.5).cast("int"))
    path = scratch_path(spark, "confusion")
    table = T.confusion_report(scored, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


@query()
def save_pipeline(spark, d):
    return _saved(spark, d)


@query()
def load_pipeline(spark, d):
    return _saved(spark, d)


def _saved(spark, d):
    """Largest score difference between a fitted chain and its stored copy."""
    from .training import prepared

    df = prepared(spark, d)
    model = L.model_pipeline("logreg", 15).fit(df)
    path = scratch_path(spark, "pipeline")
    T.save_pipeline(model, path)
    before = L.scores_of(model, df)
    after = L.scores_of(T.load_pipeline(path), df).select(
        "row_id", F.col("y_proba").alias("again"))
    return before.join(after, "row_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("y_proba") - F.col("again")))
        .alias("difference"))


