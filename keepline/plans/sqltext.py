"""SQL texts of the views, for the independent checks on the same tables."""

CTES = {
    "customers": ([], """
o_ as (select o_custkey as k, count(*) as n,
    sum(cast(round(o_totalprice * 100) as bigint)) as cents,
    min(o_orderdate) as f, max(o_orderdate) as l,
    count(*) filter (o_orderpriority = '1-URGENT') as p1,
    count(*) filter (o_orderpriority = '2-HIGH') as p2,
    count(*) filter (o_orderpriority = '3-MEDIUM') as p3,
    count(*) filter (o_orderpriority = '4-NOT SPECIFIED') as p4,
    count(*) filter (o_orderpriority = '5-LOW') as p5,
    count(*) filter (o_orderstatus = 'F') as sf
  from orders group by o_custkey),
m_ as (select max(o_orderdate) as mx from orders),
b_ as (select c_custkey as k, c_acctbal as bal, n_regionkey as rg, n, cents, p1, p2, p3, p4, p5,
    sf, date_diff('day', f, l) as active, date_diff('day', l, mx) as idle,
    case when c_mktsegment = 'MACHINERY' then 'No'
      when c_mktsegment in ('BUILDING', 'AUTOMOBILE') then 'DSL' else 'Fiber optic' end as inet
  from customer join nation on c_nationkey = n_nationkey join o_ on c_custkey = o_.k
  cross join m_),
customers as (select cast(k as varchar) as customerID,
  case when k % 2 = 0 then 'Female' else 'Male' end as gender,
  cast(case when k % 5 = 0 then 1 else 0 end as int) as SeniorCitizen,
  case when bal > 4500 then 'Yes' else 'No' end as Partner,
  case when rg < 2 then 'Yes' else 'No' end as Dependents,
  cast(active // 30 as int) as tenure,
  case when k % 11 = 0 then 'No' else 'Yes' end as PhoneService,
  case when k % 11 = 0 then 'No phone service' when n >= 10 then 'Yes' else 'No' end
    as MultipleLines,
  inet as InternetService,
  case when inet = 'No' then 'No internet service' when p1 >= 2 then 'Yes' else 'No' end
    as OnlineSecurity,
  case when inet = 'No' then 'No internet service' when p2 >= 2 then 'Yes' else 'No' end
    as OnlineBackup,
  case when inet = 'No' then 'No internet service' when p3 >= 2 then 'Yes' else 'No' end
    as DeviceProtection,
  case when inet = 'No' then 'No internet service' when p4 >= 2 then 'Yes' else 'No' end
    as TechSupport,
  case when inet = 'No' then 'No internet service' when p5 >= 2 then 'Yes' else 'No' end
    as StreamingTV,
  case when inet = 'No' then 'No internet service' when sf >= 4 then 'Yes' else 'No' end
    as StreamingMovies,
  case when n >= 13 then 'Two year' when n >= 10 then 'One year' else 'Month-to-month' end
    as Contract,
  case when k % 3 <> 0 then 'Yes' else 'No' end as PaperlessBilling,
  case k % 4 when 0 then 'Electronic check' when 1 then 'Mailed check'
    when 2 then 'Bank transfer (automatic)' else 'Credit card (automatic)' end
    as PaymentMethod,
  cast(floor(cents / cast(n * 2500 as double)) as double) / cast(100 as double)
    as MonthlyCharges,
  case when k % 97 = 0 then ' '
    else cast(cast(floor(cents / cast(2500 as double)) as bigint) as varchar) end
    as TotalCharges,
  case when idle > 300 then 'Yes' else 'No' end as Churn
from b_)"""),
    "dirty": (["customers"], """
dirty as (select
  case when kk % 41 <> 0 then customerID end as customerID,
  case when kk % 23 <> 0 then gender end as gender, SeniorCitizen,
  case when kk % 37 = 0 then 'Maybe' else Partner end as Partner, Dependents,
  case when kk % 31 <> 0 then tenure end as tenure, PhoneService, MultipleLines,
  InternetService, case when kk % 43 = 0 then ' ' else OnlineSecurity end as OnlineSecurity,
  OnlineBackup, DeviceProtection, TechSupport, StreamingTV, StreamingMovies,
  case when kk % 29 <> 0 then Contract end as Contract, PaperlessBilling, PaymentMethod,
  case when kk % 53 <> 0 then MonthlyCharges end as MonthlyCharges,
  case when kk % 59 = 0 then 'n/a' else TotalCharges end as TotalCharges,
  case when kk % 61 <> 0 then Churn end as Churn
from (select *, cast(customerID as bigint) as kk from customers))"""),
    "clean": (["customers"], """
num_ as (select * exclude (TotalCharges, Partner, Dependents, PhoneService, PaperlessBilling,
    Churn), coalesce(try_cast(trim(TotalCharges) as double), MonthlyCharges) as TotalCharges,
    case Partner when 'Yes' then 1.0 when 'No' then 0.0 end as Partner,
    case Dependents when 'Yes' then 1.0 when 'No' then 0.0 end as Dependents,
    case PhoneService when 'Yes' then 1.0 when 'No' then 0.0 end as PhoneService,
    case PaperlessBilling when 'Yes' then 1.0 when 'No' then 0.0 end as PaperlessBilling,
    case Churn when 'Yes' then 1.0 when 'No' then 0.0 end as Churn
  from customers),
clean as (select * from num_)"""),
    "c": (["customers"], """
c as (select cast(customerID as bigint) as k, case when Churn = 'Yes' then 1 else 0 end as y
  from customers)"""),
    "oof": (["c"], """
oof as (select concat('run-m', cast(m as varchar)) as run_id,
  concat('m', cast(m as varchar)) as model_name,
  cast((row_number() over (partition by m, y order by md5(concat('42:', cast(k as varchar))), k)
    - 1) % 10 as int) as fold,
  k as row_id, cast(y as int) as y_true,
  ((9 - m) * ((k * 7919 + m * 104729) % 1000) + (m + 1) * 1000 * y) / cast(10000 as double)
    as y_proba
from c cross join (select unnest([0, 1, 2, 3]) as m))"""),
    "log": ([], """
log as (select o_orderkey as id, o_orderdate as created_at, 'r' || o_orderkey as request_id,
  cast(0 as int) as item_index, 'models:/m/' || (1 + o_orderkey % 2) as model_uri,
  cast(0.5 as double) as threshold,
  (o_orderkey * 7919 % 1000) / cast(1000 as double) as y_pred_proba, o_custkey, o_totalprice
from orders)"""),
    "labels_": ([], """
labels_ as (select o_custkey as k,
  case when date_diff('day', max(o_orderdate), (select max(o_orderdate) from orders)) > 300
    then 1 else 0 end as y, max(o_orderdate) as label_time
from orders group by o_custkey)"""),
    "joined": (["log", "labels_"], """
joined as (select log.*, y as y_true, y_pred_proba as y_proba,
    case when y_pred_proba >= 0.5 then 1 else 0 end as y_pred,
    strftime(created_at, '%Y-%m-01') as month
  from log join labels_ on o_custkey = k and label_time > created_at)"""),
    "run_metrics": ([], """
run_metrics as (select event_type as run_id, 'recall' as key,
  cast(user_id % 10 as int) as step, ts, value from events)"""),
    "scores": (["run_metrics"], """
steps_ as (select run_id as model_name, step as fold, arg_max(value, row(ts, value)) as value
  from run_metrics where step between 0 and 9 group by all),
scores as (select model_name, fold, value from steps_
  qualify count(*) over (partition by model_name) = 10)"""),
    "gate_metrics": (["run_metrics"], """
gate_metrics as (select run_id, step, ts, value,
  case when run_id = 'click' and step = 3 then 'best_cv_score'
    when run_id = 'view' and step = 4 then 'cv_mean_recall'
    when run_id = 'error' and step = 5 then 'other' else 'recall' end as key
from run_metrics)"""),
    "runs": ([], """
runs0_ as (select *, case event_type when 'signup' then 'mlp' when 'click' then 'logreg'
    when 'view' then 'xgboost' when 'purchase' then 'RandomForest' end as model,
    event_type = 'signup' and event_id % 7 = 0 as refit,
    'mlp_config_' || (user_id % 6) as config from events),
runs as (select 'run-' || event_id as run_id,
  case when event_type = 'signup' and not refit then config
    else event_type || '_randomsearch' end as run_name,
  ts as start_time, model as model_name,
  case when not refit and event_id % 3 = 0 then '10' end as cv_folds,
  case when not refit then case when event_id % 3 = 1 then '10' else '5' end end as n_folds,
  case when refit then config end as best_config_name,
  case when event_type = 'signup' and not refit and event_id % 2 = 0 then config end
    as config_name,
  case when event_type = 'view' then 'randomized' end as search_type,
  cast(2 + event_id % 7 as varchar) as max_depth,
  (100 + event_id) || '.0' as n_estimators,
  case when event_id % 4 = 0 then 'None' else '0.0' || (1 + event_id % 9) end
    as learning_rate,
  'gbtree' as booster,
  case when event_id % 5 = 0 then 'all' else cast(15 + event_id % 3 * 5 as varchar) end as kbest,
  event_type as stage, value as best_cv_score,
  coalesce(cv_folds = '10', false) or coalesce(n_folds = '10', false) as is_cv
from runs0_)"""),
    "run_oof": ([], """
run_oof as (select 'run-' || l_orderkey as run_id,
  (l_linenumber + l_orderkey) % 10 as fold from lineitem)"""),
    "telemetry": ([], """
telemetry as (select ts, case when event_id % 3 = 0 then 'GET' else 'POST' end as method,
  event_type as path,
  cast(case when event_id % 50 = 0 then 500 when event_id % 20 = 0 then 422 else 200 end as int)
    as status_code,
  value / 1000 as latency_s,
  cast(case when event_id % 20 <> 0 then user_id % 2 end as int) as predicted_class,
  case when event_id % 20 <> 0 then
    case when event_id % 33 = 0 then 'error' else 'success' end end as insert_status,
  case when event_id % 20 <> 0 then value / 2000 end as inference_s,
  case when event_id % 20 <> 0 then value / 7000 end as sink_s
from events)"""),
    "requests": (["customers"], """
requests as (select kk,
  customerID as customer_id, gender, cast(SeniorCitizen as double) as SeniorCitizen,
  case when Partner = 'Yes' then 1.0 else 0.0 end as Partner,
  case when Dependents = 'Yes' then 1.0 else 0.0 end as Dependents,
  case when kk % 13 = 0 then -1.0 else cast(tenure as double) end as tenure,
  case when PhoneService = 'Yes' then 1.0 else 0.0 end as PhoneService,
  case when kk % 29 = 0 then 2.0 when PaperlessBilling = 'Yes' then 1.0 else 0.0 end
    as PaperlessBilling,
  case when kk % 19 <> 0 then MonthlyCharges end as MonthlyCharges,
  TotalCharges
from (select *, cast(customerID as bigint) as kk from customers))"""),
    "flog": ([], """
flog as (select o_orderdate as created_at,
  (o_orderkey * 7919 % 1000) / cast(1000 as double) as y_pred_proba,
  cast(o_custkey % 73 as double) as tenure,
  cast(floor(o_totalprice / 4000) + 1 as double) as MonthlyCharges,
  case when o_orderkey % 50 = 0 then null else floor(o_totalprice) end as TotalCharges
from orders),
flong as (select created_at, 'tenure' as feature, tenure as value from flog
  union all select created_at, 'MonthlyCharges', MonthlyCharges from flog
  union all select created_at, 'TotalCharges', TotalCharges from flog
  union all select created_at, 'y_pred_proba', y_pred_proba from flog)"""),
    "docs": ([], """
docs as (select doc_id, lang, source, quality as y_true,
  (n_chars % 1000) / cast(1000 as double) as y_proba
from labels join documents using (doc_id))"""),
}


def ctes(*names: str) -> str:
    """``with`` clause of the named views and what they build on."""
    order: list[str] = []

    def add(n):
        for dep in CTES[n][0]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "with " + ",".join(CTES[n][1] for n in order)


def r(expr: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round(cast({expr} as double), {digits}) + cast(0 as double))"


def quartiles(x: str) -> dict:
    return {n: r(f"quantile_cont({x}, {p})")
            for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))}


def psi_sql(expected: str, actual: str, n_bins: int = 10, by: str = "") -> str:
    """CTEs ending in ``psi_(<by>, feature, psi, dropped)`` for two long sources."""
    ps = ", ".join(f"cast({i / n_bins} as double)" for i in range(n_bins + 1))
    g = f"{by}, " if by else ""
    gg = f"gr_.{by}, " if by else ""
    also = f" and gr_.{by} = ab_.{by}" if by else ""
    return f"""
ex_ as ({expected}), ac_ as ({actual}),
ed_ as (select feature, list_sort(list_distinct(quantile_cont(value, [{ps}]))) as e
  from ex_ where value is not null group by feature),
nb_ as (select feature, e, len(e) - 1 as nb from ed_),
eb_ as (select feature, case when value >= e[1] and value <= e[len(e)] then
    least(len(list_filter(e, lambda x: x <= value)) - 1, nb - 1) end as bin, count(*) as n
  from ex_ join nb_ using (feature) where value is not null group by all),
ab_ as (select {g}feature, case when value >= e[1] and value <= e[len(e)] then
    least(len(list_filter(e, lambda x: x <= value)) - 1, nb - 1) end as bin, count(*) as n
  from ac_ join nb_ using (feature) where value is not null group by all),
at_ as (select {g}feature, sum(n) filter (bin is not null) as inside, sum(n) as total
  from ab_ group by all),
et_ as (select feature, sum(n) filter (bin is not null) as inside from eb_ group by feature),
gr_ as (select {g}at_.feature, nb, at_.inside as a_in, et_.inside as e_in, at_.total,
    unnest(range(nb)) as bin
  from at_ join nb_ on at_.feature = nb_.feature join et_ on at_.feature = et_.feature),
sh_ as (select {gg}gr_.feature, nb, total, a_in, gr_.bin,
    least(greatest(coalesce(eb_.n, 0) / cast(greatest(e_in, 1) as double), 1e-6), 1.0) as e,
    least(greatest(coalesce(ab_.n, 0) / cast(greatest(coalesce(a_in, 0), 1) as double), 1e-6),
      1.0) as a
  from gr_ left join eb_ on gr_.feature = eb_.feature and gr_.bin = eb_.bin
  left join ab_ on gr_.feature = ab_.feature and gr_.bin = ab_.bin{also}),
psi_ as (select {g}feature, case when nb < 2 then 0.0 else sum((a - e) * ln(a / e)) end as psi,
    cast(total - coalesce(a_in, 0) as bigint) as dropped
  from sh_ group by {g}feature, nb, total, a_in)"""


METRIC_SQL = """
rk_ as (select {g}, y_true, y_proba,
    rank() over (partition by {g} order by y_proba)
      + (count(*) over (partition by {g}, y_proba) - 1) / 2.0 as rk from {src}),
st_ as (select {g}, y_proba, count(*) filter (y_true = 1) as pos, count(*) as n
  from {src} group by {g}, y_proba),
cu_ as (select {g}, pos, sum(pos) over w as tp, sum(n) over w as tot
  from st_ window w as (partition by {g} order by y_proba desc)),
ap_ as (select {g}, sum(pos * (tp / cast(tot as double))) / nullif(sum(pos), 0) as ap
  from cu_ group by {g}),
cm_ as (select {g}, count(*) filter (y_true = 1) as p, count(*) filter (y_true <> 1) as n,
    count(*) filter (y_true = 1 and y_proba >= 0.5) as tp,
    count(*) filter (y_true <> 1 and y_proba >= 0.5) as fp,
    (sum(rk) filter (y_true = 1)
      - count(*) filter (y_true = 1) * (count(*) filter (y_true = 1) + 1) / 2.0)
      / nullif(cast(count(*) filter (y_true = 1) * count(*) filter (y_true <> 1) as double), 0)
      as auc
  from rk_ group by {g}),
met_ as (select {g}, (tp + n - fp) / cast(p + n as double) as accuracy,
    coalesce(tp / nullif(cast(tp + fp as double), 0), 0) as precision,
    coalesce(tp / nullif(cast(p as double), 0), 0) as recall,
    coalesce(2 * tp / nullif(cast(tp + fp + p as double), 0), 0) as f1,
    auc as roc_auc, coalesce(ap, 0) as average_precision
  from cm_ join ap_ using ({g}))"""


def metric_sql(source: str, *by: str) -> str:
    """CTEs ending in ``met_`` with the six metrics of a view per group."""
    return METRIC_SQL.format(g=", ".join(by), src=source)


METRIC_COLS = ", ".join(
    f"{r(m)} as {m}" for m in
    ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"))
