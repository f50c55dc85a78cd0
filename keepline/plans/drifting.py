"""Queries of drift and delayed-label monitoring."""

from pyspark.sql import functions as F

from .. import schemas
from ..functions.ordered import long_format
from ..operators import drift as D
from ..operators import drift_state as S
from ..operators import metrics as M
from ..operators import monitoring as N
from ..session import scratch_path
from ..sources import tables as T
from ..sources import views as V
from .registry import query
from .sqltext import METRIC_COLS, ctes, metric_sql, psi_sql, r

CUT = "1998-01-01"
_FIELDS = "tenure double, MonthlyCharges double, TotalCharges string"


def _prices(spark, d):
    """Old and new prices in long form; the feature is no literal, so joins on it stay equi-joins."""
    o = long_format(V.table(spark, d, "orders"), ["o_totalprice"], ["o_orderdate"])
    old = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    return o.where(old).drop("o_orderdate"), o.where(~old).drop("o_orderdate")


_OLD = f"""select 'o_totalprice' as feature, o_totalprice as value from orders
  where o_orderdate < timestamp '{CUT}'"""
_NEW = _OLD.replace("<", ">=")


@query("with " + psi_sql(_OLD, _NEW) + f" select feature, {r('psi')} as psi, dropped from psi_")
def psi(spark, d):
    return D.psi(*_prices(spark, d))


def _baseline_and_log(spark, d):
    log = T.flatten_features_json(V.feature_log(spark, d), _FIELDS)
    old = F.col("created_at") < F.lit(CUT).cast("timestamp")
    return D.drift_features(log.where(old)), log.where(~old)


_REPORT = ctes("flog") + "," + psi_sql(
    f"select feature, value from flong where created_at < timestamp '{CUT}'",
    f"select feature, value from flong where created_at >= timestamp '{CUT}'") + f""",
rows_ as (select count(*) as n from flog where created_at >= timestamp '{CUT}'),
re_ as (select feature, psi, dropped, n as n_rows, max(psi) over () as max_psi from psi_, rows_)"""


@query(_REPORT + f""" select feature, {r('psi')} as psi, dropped, n_rows,
  {r('max_psi')} as max_psi from re_""")
def drift_report(spark, d):
    base, log = _baseline_and_log(spark, d)
    return D.drift_report(base, log)


def _state(spark, d):
    """The log's days, added to the state in two steps; the second reads only days after the first."""
    base, log = _baseline_and_log(spark, d)
    root = scratch_path(spark, "drift-state")
    S.store_baseline(base, root)
    for until in ("1998-04-01", "2100-01-01"):
        S.update_state(log, root, until)
    return root


@query(_REPORT + f""" select feature, {r('psi')} as psi, dropped, n_rows,
  {r('max_psi')} as max_psi from re_""")
def drift_report_stored(spark, d):
    return S.report_from_state(spark, _state(spark, d), CUT, "2100-01-01")


@query(_REPORT + f""" select cast(7 as int) as window_days, n_rows, feature, {r('psi')} as psi,
  {r('max_psi')} as max_psi, 'models:/m/1' as baseline_model_uri,
  'models:/m/2' as model_uri_current, cast(max_psi >= 0.2 as int) as alert from re_""")
def drift_job(spark, d):
    """The whole job: stored baseline, new days, report, appended row, alert."""
    base, log = _baseline_and_log(spark, d)
    stored, root, path = (scratch_path(spark, n) for n in ("job-baseline", "job-state", "job-metrics"))
    wide = T.flatten_features_json(V.feature_log(spark, d), _FIELDS).where(
        F.col("created_at") < F.lit(CUT).cast("timestamp"))
    T.make_baseline(wide, stored, "models:/m/1")
    values, meta = T.read_baseline(spark, stored)
    S.store_baseline(values, root)
    S.update_state(log, root, "2100-01-01")
    report = S.report_from_state(spark, root, CUT, "2100-01-01")
    uri = meta.first()["model_uri"]
    T.append_drift_metrics(D.drift_summary(report, 7, uri, "models:/m/2"), path)
    rows = spark.read.schema(schemas.DRIFT_METRICS).parquet(path)
    return rows.select("window_days", "n_rows", F.explode("psi").alias("feature", "psi"), "max_psi",
                       "baseline_model_uri", "model_uri_current", D.drift_alert().alias("alert"))


def _summary(spark, d):
    base, log = _baseline_and_log(spark, d)
    return D.drift_summary(D.drift_report(base, log), 7, "models:/m/1", "models:/m/2")


@query(_REPORT + f""" select {r('max(max_psi)')} as max_psi,
  cast(max(max_psi) >= 0.2 as int) as alert from re_""")
def drift_alert(spark, d):
    return _summary(spark, d).select("max_psi", D.drift_alert().alias("alert"))


def _monthly(spark, d):
    """PSI of the price per month against the oldest orders: a drift history."""
    expected, _ = _prices(spark, d)
    edges = D.baseline_edges(expected)
    long = long_format(V.table(spark, d, "orders").withColumn(
        "month", F.date_format("o_orderdate", "yyyy-MM-01")), ["o_totalprice"], ["month"])
    counts = D.bin_counts(long, edges, by=["month"])
    rows = counts.groupBy("month").agg(F.sum("n").alias("n_rows"))
    history = D.psi_from_counts(edges, D.bin_counts(expected, edges), counts, ["month"])
    return history.select("month", F.col("psi").alias("max_psi")).join(rows, "month")


_MONTHLY = "with " + psi_sql(_OLD, """select strftime(o_orderdate, '%Y-%m-01') as month,
  'o_totalprice' as feature, o_totalprice as value from orders""", by="month") + """,
mo_ as (select month, psi as max_psi, cast(total as bigint) as n_rows
  from psi_ join (select month, total from at_) using (month))"""


@query(_MONTHLY + f""" select month, {r('max_psi')} as max_psi, case when n_rows < 200
  then 'silent' when max_psi >= 0.2 then 'critical' when max_psi >= 0.1 then 'warning'
  else 'ok' end as severity from mo_""")
def drift_severity(spark, d):
    return _monthly(spark, d).select("month", "max_psi", D.drift_severity().alias("severity"))


@query(_MONTHLY + """ select month, cast(coalesce(count(max_psi) over w = 3
  and min(max_psi) over w > 0.05, false) as int) as retrain from mo_
window w as (order by month rows between 2 preceding and current row)""")
def sustained_drift(spark, d):
    return D.sustained_drift(_monthly(spark, d), "month", limit=0.05).select("month", "retrain")


@query(ctes("flog") + f""", v_ as (select feature, value,
    count(*) filter (created_at < timestamp '{CUT}') as e,
    count(*) filter (created_at >= timestamp '{CUT}') as a
  from flong where value is not null group by all),
c_ as (select feature, sum(e) over w / cast(sum(e) over (partition by feature) as double) as ce,
    sum(a) over w / cast(sum(a) over (partition by feature) as double) as ca, e, a
  from v_ window w as (partition by feature order by value))
select feature, {r('max(abs(ce - ca))')} as ks, cast(sum(e) as bigint) as n_expected,
  cast(sum(a) as bigint) as n_actual from c_ group by feature""")
def ks_drift(spark, d):
    base, log = _baseline_and_log(spark, d)
    return D.ks_drift(base, D.drift_features(log))


@query(ctes("log") + """
select cast(least(floor(y_pred_proba * 10), 9) as int) as bin, count(*) as n from log group by 1""")
def score_histogram(spark, d):
    return D.score_histogram(V.prediction_log(spark, d))


# --- delayed labels ------------------------------------------------------------------------------

def _joined(spark, d):
    log = T.flatten_features_json(V.prediction_log(spark, d), "o_custkey bigint")
    labels = V.customer_labels(spark, d).select(
        F.col("k").alias("o_custkey"), F.col("y").alias("y_true"),
        F.col("label_time").cast("timestamp").alias("label_time"))
    return N.join_delayed_labels(log, labels, "o_custkey").withColumnRenamed(
        "y_pred_proba", "y_proba")


@query(ctes("joined") + "," + metric_sql("joined", "month")
       + f" select month, {METRIC_COLS} from met_")
def delayed_label_eval(spark, d):
    return N.delayed_label_eval(_joined(spark, d))


@query(ctes("joined") + f""" select model_uri, count(*) as n, {r('avg(y_true)')} as actual_rate,
  {r('avg(y_pred)')} as predicted_rate, {r('avg(y_proba)')} as mean_proba
from joined group by model_uri""")
def actual_vs_predicted_rate(spark, d):
    return N.actual_vs_predicted_rate(_joined(spark, d), ["model_uri"])


@query(ctes("joined") + f""" select cast(least(floor(y_proba * 10), 9) as int) as bin,
  count(*) as n, {r('avg(y_true)')} as actual_rate, {r('avg(y_proba)')} as mean_proba
from joined group by 1""")
def calibration_table(spark, d):
    return N.calibration_table(_joined(spark, d))


@query(ctes("docs") + "," + metric_sql("docs", "lang") + f"""
select lang, {METRIC_COLS}, n from met_ join (select lang, count(*) as n from docs group by 1)
  using (lang)""")
def subgroup_performance(spark, d):
    return N.subgroup_performance(V.document_scores(spark, d), "lang")


@query(ctes("joined") + f""", q_ as (select month,
    coalesce(count(*) filter (y_true = 1 and y_pred = 1)
      / nullif(cast(count(*) filter (y_true = 1) as double), 0), 0) as recall,
    coalesce(count(*) filter (y_true <> 1 and y_pred = 1)
      / nullif(cast(count(*) filter (y_true <> 1) as double), 0), 0) as fp_rate
  from joined group by month)
select month, {r('recall')} as recall, {r('fp_rate')} as fp_rate,
  {r('lag(recall) over (order by month)')} as recall_before,
  cast(coalesce((lag(recall) over (order by month) - recall)
    / nullif(lag(recall) over (order by month), 0) > 0.05, false) as int) as recall_drop,
  cast(coalesce(fp_rate > lag(fp_rate) over (order by month), false) as int) as fp_rise
from q_""")
def performance_drop_alert(spark, d):
    counts = M.confusion_counts(_joined(spark, d).withColumn(
        "month", F.date_format("created_at", "yyyy-MM-01")), ["month"])
    from ..functions.expressions import ratio

    per_month = counts.select("month", M.rates()["recall"].alias("recall"),
                              ratio("fp", F.col("fp") + F.col("tn")).alias("fp_rate"))
    return N.performance_drop_alert(per_month, "month")
