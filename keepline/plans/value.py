"""Queries of classification metrics and threshold economics."""

from pyspark.sql import functions as F

from ..functions.expressions import literal_edges
from ..operators import business as B
from ..operators import metrics as M
from ..sources import views as V
from .registry import query
from .sqltext import METRIC_COLS, ctes, metric_sql, r

BY = ["model_name", "fold"]

_CONF = """cf_ as (select model_name, fold,
  count(*) filter (y_true <> 1 and y_proba < 0.5) as tn,
  count(*) filter (y_true <> 1 and y_proba >= 0.5) as fp,
  count(*) filter (y_true = 1 and y_proba < 0.5) as fn,
  count(*) filter (y_true = 1 and y_proba >= 0.5) as tp
from oof group by model_name, fold)"""
_MET = ctes("oof") + "," + metric_sql("oof", "model_name", "fold")


@query(ctes("oof") + "," + _CONF + " select * from cf_")
def confusion_counts(spark, d):
    return M.confusion_counts(V.oof(spark, d), BY)


def _predicted(spark, d):
    return V.oof(spark, d).withColumn("y_pred", (F.col("y_proba") >= 0.5).cast("int"))


@query(ctes("oof") + f""", n_ as (select y_true as "true", cast(y_proba >= 0.5 as int) as pred,
  count(*) as n from oof group by all)
select "true", pred, {r('n / cast(sum(n) over (partition by "true") as double)')} as share
from n_""")
def confusion_normalized(spark, d):
    return M.confusion_normalized(_predicted(spark, d), "true")


def _one_rate(name):
    @query(_MET + f" select model_name, fold, {r(name)} as {name} from met_", name=name)
    def run(spark, d):
        counts = M.confusion_counts(V.oof(spark, d), BY)
        return counts.select(*BY, M.rates()[name].alias(name))


for _name in ("accuracy", "precision", "recall", "f1"):
    _one_rate(_name)


@query(ctes("oof") + "," + _CONF + f"""
select model_name, fold, {r('tp / nullif(cast(tp + fn as double), 0)')} as recall from cf_""")
def recall_from_confusion(spark, d):
    return M.confusion_counts(V.oof(spark, d), BY).select(
        *BY, M.recall_from_confusion().alias("recall"))


@query(_MET + f" select model_name, fold, {r('roc_auc')} as roc_auc from met_")
def roc_auc(spark, d):
    return M.roc_auc(V.oof(spark, d), BY)


@query(_MET + f" select model_name, fold, {r('average_precision')} as average_precision from met_")
def average_precision(spark, d):
    return M.average_precision(V.oof(spark, d), BY)


@query(_MET + f" select model_name, fold, {METRIC_COLS} from met_")
def compute_metrics(spark, d):
    return M.compute_metrics(V.oof(spark, d), BY)


_ALL = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


@query(_MET + " union all ".join(
    f" select model_name, '{m}' as metric, {r(f'avg({m})')} as mean, "
    f"{r(f'coalesce(stddev_samp({m}), 0)')} as std from met_ group by model_name" for m in _ALL))
def cv_summary(spark, d):
    return M.cv_summary(M.compute_metrics(V.oof(spark, d), BY), _ALL, ["model_name"])


_INF = "case when fp = 0 then null else (10.0 * tp - fp - 5.0 * fn) / fp end"


@query(ctes("oof") + "," + _CONF + f""", v_ as (select model_name, {_INF} as v from cf_)
select model_name, {r('avg(v)')} as mean,
  {r('case when count(v) > 1 then stddev_samp(v) when count(v) = 1 then 0 end')} as std,
  {r('min(v)')} as min, {r('max(v)')} as max from v_ group by model_name""")
def summarize_folds(spark, d):
    v = B.net_value_at_threshold(V.oof(spark, d), 0.5, BY, on_zero_cost="inf")
    return M.summarize_folds(v, "roi", ["model_name"])


_REPS = 1000
_POISSON = " ".join(f"when u >= {c!r}::double then {k + 1}" for k, c in reversed(list(enumerate(M.poisson_steps()))))


@query(ctes("oof") + f""", h_ as (select model_name, y_true, y_proba, md5('42:' || row_id) as m from oof),
i_ as (select model_name, y_true, y_proba, ('0x' || substr(m, 1, 8))::bigint as h1,
    ('0x' || substr(m, 9, 8))::bigint as h2 from h_),
u_ as (select model_name, y_true, y_proba, rep,
    ((h1 + rep * h2) % 4294967296) / 4294967296.0::double as u
  from i_ cross join (select unnest(range({_REPS})) as rep)),
w_ as (select model_name, rep, y_proba, y_true, case {_POISSON} else 0 end as w from u_),
g_ as (select model_name, rep, y_proba, sum(w) filter (y_true = 1) as pos,
    sum(w) filter (y_true <> 1) as neg from w_ where w > 0 group by all),
z_ as (select model_name, rep, y_proba, coalesce(pos, 0) as pos, coalesce(neg, 0) as neg from g_),
k_ as (select *, sum(neg) over (partition by model_name, rep order by y_proba) - neg as below
  from z_),
a_ as (select model_name, rep, sum(pos * (below + neg / 2.0)) / cast(sum(pos) * sum(neg) as double)
  as v from k_ group by all)
select model_name, {r('avg(v)')} as mean, {r('stddev_samp(v)')} as std,
  {r('quantile_cont(v, 0.025)')} as lower, {r('quantile_cont(v, 0.975)')} as upper,
  count(*) as n_samples from a_ group by model_name""")
def bootstrap_ci(spark, d):
    return M.bootstrap_ci(V.oof(spark, d), "row_id", "roc_auc", _REPS, by=["model_name"])


# --- business value ---------------------------------------------------------------------------

_GRID = "g_ as (select unnest(range(201)) / cast(200 as double) as threshold)"


@query(ctes("customers") + "," + _GRID + f"""
select threshold, count(*) as n from (select {r('threshold')} as threshold from g_),
  customers group by threshold""")
def threshold_grid(spark, d):
    grid = literal_edges(B.threshold_grid())
    return V.customers(spark, d).select(F.explode(grid).alias("threshold")).groupBy(
        "threshold").agg(F.count(F.lit(1)).alias("n"))


_SWEEP = ctes("oof") + "," + _GRID + """, sw_ as (select model_name, fold, threshold,
    count(*) filter (y_true <> 1 and y_proba < threshold) as tn,
    count(*) filter (y_true <> 1 and y_proba >= threshold) as fp,
    count(*) filter (y_true = 1 and y_proba < threshold) as fn,
    count(*) filter (y_true = 1 and y_proba >= threshold) as tp
  from oof cross join g_ group by model_name, fold, threshold),
sv_ as (select *, fp * 1.0 + fn * 5.0 as total_cost, tp * 10.0 - fp * 1.0 - fn * 5.0 as net_value
  from sw_),
be_ as (select * from sv_ qualify row_number() over (partition by model_name, fold
  order by net_value desc, threshold) = 1)"""
_SWEEP_COLS = f"""model_name, fold, {r('threshold')} as threshold, tn, fp, fn, tp,
  {r('total_cost')} as total_cost, {r('net_value')} as net_value"""


@query(_SWEEP + f" select {_SWEEP_COLS} from sv_")
def sweep_thresholds(spark, d):
    return B.sweep_thresholds(V.oof(spark, d), BY)


@query(_SWEEP + f" select {_SWEEP_COLS} from be_")
def best_threshold(spark, d):
    return B.best_threshold(B.sweep_thresholds(V.oof(spark, d), BY), BY)


_NET = """nv_ as (select *, tp * 10.0 - fp * 1.0 - fn * 5.0 as net_value, fp * 1.0 as action_cost
  from cf_)"""
_ROI = r("case when action_cost > 0 then net_value / action_cost end")


@query(ctes("oof") + "," + _CONF + "," + _NET + f"""
select model_name, fold, tn, fp, fn, tp, {r('net_value')} as net_value,
  {r('action_cost')} as action_cost, {_ROI} as roi from nv_""")
def net_value_at_threshold(spark, d):
    return B.net_value_at_threshold(V.oof(spark, d), 0.5, BY)


@query(ctes("oof") + "," + _CONF + "," + _NET + f"""
select model_name, fold, {r('''case when action_cost > 0 then net_value / action_cost
  else 0 end''')} as roi from nv_""")
def roi(spark, d):
    m = B.net_value_at_threshold(V.oof(spark, d), 0.5, BY)
    return m.select(*BY, B.roi(F.col("net_value"), F.col("action_cost"), "zero").alias("roi"))


_TOPK = """tk_ as (select *, row_number() over (partition by model_name, fold
    order by y_proba desc, row_id) <= greatest(ceil(count(*) over (partition by model_name, fold)
    * cast(0.1 as double)), 1) as treated from oof),
tc_ as (select model_name, fold, count(*) filter (treated) as k,
    count(*) filter (y_true <> 1 and not treated) as tn,
    count(*) filter (y_true <> 1 and treated) as fp,
    count(*) filter (y_true = 1 and not treated) as fn,
    count(*) filter (y_true = 1 and treated) as tp from tk_ group by model_name, fold),
tn_ as (select *, tp * 10.0 - fp * 1.0 as net_value, fp * 1.0 as action_cost from tc_)"""


@query(ctes("oof") + "," + _TOPK + f"""
select model_name, fold, k, tn, fp, fn, tp, cast(0.1 as double) as topk,
  {r('net_value')} as net_value, {r('action_cost')} as action_cost, {_ROI} as roi from tn_""")
def net_value_at_topk(spark, d):
    return B.net_value_at_topk(V.oof(spark, d), 0.1, BY)


_FV = """fv_ as (select model_name, fold, threshold, net_value,
  case when fp > 0 then net_value / fp end as roi,
  tp / nullif(cast(tp + fn as double), 0) as recall from be_)"""


def _stats(c):
    return ", ".join([
        f"{r(f'avg({c})')} as {c}_mean",
        f"{r(f'case when count({c}) > 1 then stddev_samp({c}) when count({c}) = 1 then 0 end')}"
        f" as {c}_std",
        f"{r(f'min({c})')} as {c}_min", f"{r(f'max({c})')} as {c}_max"])


_EVAL = f"""ev_ as (select model_name, {_stats('net_value')}, {_stats('roi')},
  {_stats('recall')}, {r('avg(threshold)')} as threshold_mean,
  {r('stddev_samp(threshold)')} as threshold_std, 'sweep' as mode from fv_ group by model_name)"""


@query(_SWEEP + "," + _FV + "," + _EVAL + " select * from ev_")
def business_eval(spark, d):
    return B.business_eval(V.oof(spark, d), mode="sweep")


@query(_SWEEP + "," + _FV + "," + _EVAL + """
select model_name, net_value_mean, cast(rank() over (order by net_value_mean desc) as int)
  as position from ev_""")
def business_ranking(spark, d):
    e = B.business_eval(V.oof(spark, d), mode="sweep")
    return B.business_ranking(e, "net_value").select("model_name", "net_value_mean", "position")


@query(_SWEEP + "," + _FV + "," + _EVAL + """
select model_name, recall_mean from ev_ where recall_mean >= 0.9""")
def absolute_gate(spark, d):
    e = B.business_eval(V.oof(spark, d), mode="sweep")
    return B.absolute_gate(e, "recall_mean", 0.9).select("model_name", "recall_mean")


_KEY = "business.topk_0.1000"


def _rows(m):
    return f""" select model_name, '{_KEY}.{m}' as key, fold as step, {r(m)} as value from tf_
  union all select model_name, '{_KEY}.{m}_mean', null, {r(f'avg({m})')} from tf_ group by 1
  union all select model_name, '{_KEY}.{m}_std', null, {r(f'stddev_samp({m})')} from tf_ group by 1"""


@query(ctes("oof") + "," + _TOPK + """, tf_ as (select model_name, fold, net_value,
  case when fp > 0 then net_value / fp end as roi,
  tp / nullif(cast(tp + fn as double), 0) as recall from tn_)"""
       + " union all ".join(_rows(m) for m in ("net_value", "roi", "recall")))
def business_metric_rows(spark, d):
    return B.business_metric_rows(V.oof(spark, d), mode="topk", value=0.1)
