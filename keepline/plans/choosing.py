"""Queries of run selection and model comparison."""

from pyspark.sql import functions as F

from ..operators import selection as S
from ..sources import views as V
from .registry import query
from .sqltext import ctes, r


def _scores(spark, d):
    """Fold table of five models from the metric history."""
    return S.fold_metric(V.run_metrics(spark, d), "recall").withColumnRenamed(
        "run_id", "model_name")


_SC = ctes("scores")


@query(_SC + f" select model_name as run_id, fold, {r('value')} as value from scores")
def fold_metric(spark, d):
    return S.fold_metric(V.run_metrics(spark, d), "recall")


@query(ctes("runs") + " select run_id, run_name from runs where is_cv")
def is_cv_run(spark, d):
    return V.runs(spark, d).where(S.is_cv_run()).select("run_id", "run_name")


_OOF0 = "(select run_id from run_oof where fold = 0)"


@query(ctes("runs", "run_oof") + f" select run_id from runs where run_id in {_OOF0}")
def has_any_oof(spark, d):
    return S.has_any_oof(V.runs(spark, d), V.run_oof(spark, d)).select("run_id")


_LATEST = f"""la_ as (select model_name, run_id, start_time from runs
  where is_cv and model_name <> '' and run_id in {_OOF0}
  qualify row_number() over (partition by model_name order by start_time desc, run_id desc) = 1)"""


@query(ctes("runs", "run_oof") + "," + _LATEST + " select model_name, run_id from la_")
def latest_runs(spark, d):
    return S.latest_runs(V.runs(spark, d), V.run_oof(spark, d)).select("model_name", "run_id")


@query(ctes("runs", "run_oof") + "," + _LATEST + f""",
rf_ as (select best_config_name as config from runs where model_name = 'mlp'
  and best_config_name is not null order by start_time desc, run_id desc limit 1),
wi_ as (select runs.run_id from runs, rf_ where is_cv
    and (config_name = config or run_name = config)
  order by start_time desc, runs.run_id desc limit 1),
ok_ as (select run_id from wi_ where run_id in {_OOF0})
select 'mlp' as model_name, run_id from ok_
union all select model_name, run_id from la_
  where model_name <> 'mlp' or not exists (select 1 from ok_)""")
def winning_config_run(spark, d):
    return S.winning_config_run(V.runs(spark, d), V.run_oof(spark, d)).select(
        "model_name", "run_id")


@query(ctes("runs") + " select run_id, coalesce(model_name, run_id) as name from runs")
def display_name(spark, d):
    return V.runs(spark, d).select("run_id", S.display_name().alias("name"))


_PARAMS = """pa_ as (
  select run_id, 'max_depth' as name, max_depth as raw from {src}
  union all select run_id, 'n_estimators', n_estimators from {src}
  union all select run_id, 'learning_rate', learning_rate from {src}
  union all select run_id, 'booster', booster from {src}
  union all select run_id, 'select_kbest__k', kbest from {src}),
ca_ as (select run_id, name, case when lower(raw) <> 'none' then raw end as v,
  try_cast(raw as double) as x from pa_)"""
_CAST = f"""run_id, name,
  case when x is null or name = 'booster' then v end as text,
  case when name in ('max_depth', 'n_estimators', 'select_kbest__k') then cast(trunc(x) as bigint)
    end as int_value,
  {r("case when name = 'learning_rate' then x end")} as double_value"""


@query(ctes("runs") + "," + _PARAMS.format(src="runs") + f" select {_CAST} from ca_")
def cast_param(spark, d):
    return S.run_params(V.runs(spark, d))


@query(ctes("runs") + """, br_ as (select * from runs where search_type = 'randomized'
  order by best_cv_score desc, run_id desc limit 1),""" + _PARAMS.format(src="br_")
       + f" select {r('best_cv_score')} as score, {_CAST} from ca_ join br_ using (run_id)")
def best_run(spark, d):
    return S.best_run(V.runs(spark, d))


@query(ctes("gate_metrics") + f""",
la_ as (select run_id, key, case when key = 'recall' then step end as fold,
    arg_max(value, row(step, ts, value)) as value
  from gate_metrics where key <> 'other' group by all),
pr_ as (select run_id, max(value) filter (key = 'best_cv_score') as a,
    max(value) filter (key = 'cv_mean_recall') as b, count(fold) as n,
    avg(value) filter (key = 'recall') as c from la_ group by run_id)
select run_id, {r('coalesce(a, b, case when n = 10 then c end)')} as gate_score from pr_""")
def gate_score(spark, d):
    return S.gate_score(V.gate_metrics(spark, d))


@query(_SC + f""", me_ as (select model_name, avg(value) as m from scores group by 1)
select model_name, fold, {r('value')} as value from scores where model_name in (
  select model_name from me_ where m >= (select m from me_ where model_name = 'click') * 0.9)""")
def relative_gate(spark, d):
    return S.relative_gate(_scores(spark, d), "click", -0.1)


@query(_SC + f""" select model_name, fold, {r('value')} as value from scores
where model_name in ('click', 'view')""")
def models_filter(spark, d):
    return S.models_filter(_scores(spark, d), ["click", "view"])


@query(_SC + f""" select model_name, {r('avg(value)')} as mean, {r('stddev_samp(value)')} as std,
  cast(row_number() over (order by avg(value) desc, model_name) as int) as position
from scores group by model_name""")
def technical_summary(spark, d):
    return S.technical_summary(_scores(spark, d))


_RANKS = """ra_ as (select model_name, fold, count(*) over (partition by fold, value) as t,
    rank() over (partition by fold order by value)
      + (count(*) over (partition by fold, value) - 1) / 2.0 as rk from scores),
rs_ as (select model_name, sum(rk) as s, avg(rk) as ar, count(*) as n from ra_ group by 1)"""


@query(_SC + "," + _RANKS + f""",
f_ as (select count(*) as k, max(n) as n, sum(s * s) as ss,
    (select sum(t * t - 1) from ra_) as ties from rs_),
x_ as (select k, n, (12.0 / cast(n * k * (k + 1) as double) * ss - 3.0 * n * (k + 1))
    / (1 - ties / cast(n * k * (k * k - 1) as double)) as x from f_),
p_ as (select *, exp(-x / 2) * (1 + x / 2) as p from x_)
select k, n, {r('x')} as friedman_stat, {r('p')} as p_value, cast(p < 0.05 as int) as significant
from p_""")
def friedman_test(spark, d):
    return S.friedman_test(_scores(spark, d))


# The tail of the studentized range: k phi(z) (Phi(z) - Phi(z - q))^(k - 1), summed over a fine grid of z. Phi comes from
# the series of the error function, whose terms are all positive.
_PHI = """case when {z} > 8 then 1.0 when {z} < -8 then 0.0 when {z} = 0 then 0.5 else 0.5 + sign({z}) / sqrt(pi())
  * exp(-{z} * {z} / 2) * list_sum(list_transform(range(140), lambda n: exp((2 * n + 1) * ln(abs({z}) / sqrt(2.0))
    + 2 * n * ln(2.0) + lgamma(n + 1) - lgamma(2 * n + 2)))) end"""
_NEMENYI = _SC + "," + _RANKS + f""",
q_ as (select a.model_name as model_a, b.model_name as model_b, cast(5 as bigint) as k,
    abs(a.ar - b.ar) / sqrt(30 / cast(a.n * 6 as double)) * sqrt(2) as q
  from rs_ a join rs_ b on a.model_name <> b.model_name),
d_ as (select distinct q, k from q_),
z_ as (select q, k, (i - 400) / 50.0::double as z from d_, (select unnest(range(801)) as i)),
e_ as (select q, k * exp(-z * z / 2) / sqrt(2 * pi())
    * ({_PHI.replace("{z}", "z")} - {_PHI.replace("{z}", "(z - q)")}) ** (k - 1) / 50 as v from z_),
t_ as (select q, case when q <= 0 then 1.0 else greatest(0.0, least(1.0, 1 - sum(v))) end as p from e_ group by q),
n_ as (select model_a, model_b, k, {r('q_.q')} as q, {r('p')} as p_value from q_ join t_ on q_.q = t_.q)"""


@query(_NEMENYI + """, f_ as (select count(*) as k, max(n) as n, sum(s * s) as ss,
    (select sum(t * t - 1) from ra_) as ties from rs_),
x_ as (select (12.0 / cast(n * k * (k + 1) as double) * ss - 3.0 * n * (k + 1))
    / (1 - ties / cast(n * k * (k * k - 1) as double)) as x from f_)
select n_.* from n_, x_ where exp(-x / 2) * (1 + x / 2) < 0.05""")
def nemenyi_test(spark, d):
    return S.nemenyi_test(_scores(spark, d), only_if_friedman=True)


@query(_NEMENYI + " select * from n_")
def nemenyi_p_values(spark, d):
    return S.nemenyi_test(_scores(spark, d))


def _duel(pair_sql):
    """CTEs from a two-column pair (a, b) to exact signed-rank figures."""
    return f"""pd_ as ({pair_sql}),
df_ as (select a, b, x.fold, x.value - y.value as d from pd_
  join scores x on x.model_name = a join scores y on y.model_name = b and y.fold = x.fold),
wr_ as (select *, rank() over (order by abs(d))
    + (count(*) over (partition by abs(d)) - 1) / 2.0 as rk from df_ where d <> 0),
wn_ as (select *, row_number() over (order by abs(d), fold) - 1 as bit from wr_),
ws_ as (select coalesce(sum(rk) filter (d > 0), 0) as wp, coalesce(sum(rk) filter (d < 0), 0) as wm
  from wr_),
sp_ as (select s, sum(case when (s >> bit) & 1 = 1 then rk else 0 end) as w
  from wn_, (select unnest(range(1024)) as s) group by s),
wp_ as (select least(1.0, 2 * count(*) filter (w <= (select least(wp, wm) from ws_))
  / cast(count(*) as double)) as p from sp_),
wx_ as (select a, b, (select least(wp, wm) from ws_) as stat, avg(d) as md,
    avg(d) / nullif(stddev_samp(d), 0) as cd, (select p from wp_) as p from df_ group by a, b)"""


@query(_SC + "," + _duel("select 'purchase' as a, 'click' as b") + f"""
select a as model_a, b as model_b, {r('stat')} as stat, {r('md')} as mean_diff,
  {r('coalesce(cd, 0)')} as cohens_d, {r('p')} as p_value, cast(p < 0.05 as int) as significant
from wx_""")
def wilcoxon_test(spark, d):
    return S.wilcoxon_test(_scores(spark, d), "purchase", "click")


@query(_SC + """, me_ as (select model_name, row_number() over (order by avg(value) desc,
    model_name) as pos from scores group by 1),""" + _duel(
    """select coalesce((select model_name from me_ where model_name <> 'click'
      order by pos limit 1)) as a, 'click' as b""") + f"""
select case when p < 0.05 and md > 0 then a else b end as winner,
  case when p < 0.05 and md > 0 then b else a end as loser, 'click' as baseline,
  a as duel_a, b as duel_b, 'baseline_duel' as decision,
  case when p < 0.05 and md > 0 then 'challenger_significantly_better_than_baseline'
    else 'no_sig_gain_over_baseline_choose_baseline' end as reason,
  {r('stat')} as stat, {r('p')} as p_value, {r('md')} as mean_diff, {r('cd')} as cohens_d,
  cast(p < 0.05 as int) as significant,
  (select string_agg(model_name, ',' order by pos) from me_) as ranked from wx_""")
def decide_winner(spark, d):
    return S.decide_winner(_scores(spark, d), "click").withColumn(
        "ranked", F.concat_ws(",", "ranked"))
