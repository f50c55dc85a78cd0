"""Queries of the descriptive statistics."""

from pyspark.sql import functions as F

from ..constants import CATEGORICAL_COLS
from ..operators import cleaning as C
from ..operators import profile as P
from ..sources import views as V
from .registry import query
from .sqltext import ctes, quartiles, r

_NUM = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
_CAT = ["gender", "Partner", "InternetService", "Contract", "PaymentMethod"]
_ALL = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
        "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
        "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
        "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn"]
_STRINGS = [c for c in _ALL if c not in ("SeniorCitizen", "tenure", "MonthlyCharges")]

_SRC = ctes("dirty") + """, s_ as (select * exclude (TotalCharges),
  try_cast(trim(TotalCharges) as double) as TotalCharges from dirty)
"""


def _typed(spark, d):
    return C.coerce_numeric(V.dirty_customers(spark, d), ["TotalCharges"])


def _each(columns, select, source="s_"):
    return " union all ".join(" " + select(c) + f" from {source}" for c in columns)


def _describe(c):
    q = quartiles(c)
    return (f"select '{c}' as feature, count({c}) as count, {r(f'avg({c})')} as mean, "
            f"{r(f'stddev_samp({c})')} as std, {r(f'min({c})')} as min, {q['q25']} as q25, "
            f"{q['q50']} as q50, {q['q75']} as q75, {r(f'max({c})')} as max")


@query(_SRC + _each(_NUM, _describe))
def describe_numeric(spark, d):
    return P.describe_numeric(_typed(spark, d), _NUM)


@query(_SRC + " union all ".join(
    f" {_describe(c).replace('select', 'select Churn,', 1)} from s_ group by Churn"
    for c in _NUM))
def describe_by_target(spark, d):
    return P.describe_by_target(_typed(spark, d), "Churn", _NUM)


_TYPES = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double"}


@query(ctes("dirty") + _each(
    _ALL, lambda c: f"select '{c}' as \"column\", '{_TYPES.get(c, 'string')}' as dtype, "
    f"count({c}) as non_null", "dirty"))
def describe_schema(spark, d):
    return P.describe_schema(V.dirty_customers(spark, d))


def _missing(c):
    return f"({c} is null or {c} in ('', ' '))" if c in _STRINGS else f"({c} is null)"


@query(ctes("dirty") + _each(
    _ALL, lambda c: f"select '{c}' as \"column\", count(*) filter ({_missing(c)}) as "
    f"missing_count, {r(f'count(*) filter ({_missing(c)}) / cast(count(*) as double) * 100', 2)}"
    " as missing_percentage", "dirty"))
def missing_report(spark, d):
    return P.missing_report(V.dirty_customers(spark, d))


@query(ctes("dirty") + " select Churn, count(*) as n from dirty where "
       + " or ".join(_missing(c) for c in _ALL) + " group by Churn")
def target_in_missing_rows(spark, d):
    return P.target_in_missing_rows(V.dirty_customers(spark, d), "Churn")


def _counts(c):
    return (f" select '{c}' as \"column\", cast({c} as varchar) as level, count(*) as n "
            f"from dirty where {c} is not null group by {c}")


@query(ctes("dirty") + " union all ".join(_counts(c) for c in _CAT))
def value_counts(spark, d):
    return P.value_counts(V.dirty_customers(spark, d), _CAT)


def _hist(c, bins=50):
    return f""" select '{c}' as feature, cast(least(coalesce(floor(
  (cast({c} as double) - lo) * {bins} / nullif(hi - lo, 0)), 0), {bins - 1}) as int) as bin,
  count(*) as n
from s_, (select cast(min({c}) as double) as lo, cast(max({c}) as double) as hi from s_)
where {c} is not null group by all"""


@query(_SRC + " union all ".join(_hist(c) for c in _NUM))
def numeric_histogram(spark, d):
    return P.numeric_histogram(_typed(spark, d), _NUM, 50)


_LEVELS = ["MultipleLines", "PaymentMethod", "tenure"]


def _top(c):
    return f""" select '{c}' as "column", t.level, t.n, {r('quantile_cont(MonthlyCharges, 0.5)')}
  as median from s_ join (select cast({c} as varchar) as level, count(*) as n from s_
    where {c} is not null group by 1 order by n desc, level limit 12) t
  on cast(s_.{c} as varchar) = t.level group by t.level, t.n"""


@query(_SRC + ", t_ as (" + " union all ".join(_top(c) for c in _LEVELS) + """)
select "column", level, n, median, cast(row_number() over (partition by "column"
  order by median, level) as int) as position from t_""")
def top_levels_by_median(spark, d):
    return P.top_levels_by_median(_typed(spark, d), _LEVELS, "MonthlyCharges")


def _box(c):
    return f""" select '{c}' as feature, {r('q1')} as q1, {r('q2')} as median, {r('q3')} as q3,
  {r('q1 - 1.5 * (q3 - q1)')} as lower_fence, {r('q3 + 1.5 * (q3 - q1)')} as upper_fence,
  count(*) filter ({c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as outliers
from s_, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as q2,
  quantile_cont({c}, 0.75) as q3 from s_) group by all"""


@query(_SRC + " union all ".join(_box(c) for c in _NUM))
def box_stats(spark, d):
    return P.box_stats(_typed(spark, d), _NUM)


@query(_SRC + " union all ".join(
    f" select '{c}' as \"column\", count(*) filter (abs(({c} - m) / s) > 3) as outliers from s_,"
    f" (select avg({c}) as m, stddev_pop({c}) as s from s_)" for c in _NUM))
def zscore_outliers(spark, d):
    return P.zscore_outliers(_typed(spark, d), _NUM)


@query(ctes("dirty") + _each(
    _STRINGS, lambda c: f"select '{c}' as \"column\", count(*) filter (trim({c}) = '') as blanks",
    "dirty"))
def blank_counts(spark, d):
    return P.blank_counts(V.dirty_customers(spark, d))


@query("""with c_ as (select 'c_acctbal' as "column", count(*) filter (c_acctbal < 0) as negatives
  from customer union all select 'c_nationkey', count(*) filter (c_nationkey < 0) from customer)
select * from c_""")
def negative_counts(spark, d):
    return P.negative_counts(V.table(spark, d, "customer"), ["c_acctbal", "c_nationkey"])


@query(ctes("dirty") + _each(
    _STRINGS, lambda c: f"select '{c}' as \"column\", count(distinct {c}) as levels, "
    f"cast(count(distinct {c}) > 10 as int) as too_many", "dirty"))
def cardinality_report(spark, d):
    return P.cardinality_report(V.dirty_customers(spark, d))


@query(ctes("dirty") + """
 select 'tenure_negative' as rule, count(*) filter (tenure < 0) as violations from dirty
 union all select 'monthly_not_positive', count(*) filter (MonthlyCharges <= 0) from dirty
 union all select 'total_not_numeric',
   count(*) filter (try_cast(trim(TotalCharges) as double) is null) from dirty""")
def consistency_rules(spark, d):
    return P.consistency_rules(V.dirty_customers(spark, d))


def _shape(c):
    return f""" select '{c}' as "column", m as mean, sk as skew, ku as kurtosis from (select
  avg({c}) as m, avg(pow({c} - mu, 3)) / pow(avg(pow({c} - mu, 2)), 1.5) as sk,
  avg(pow({c} - mu, 4)) / pow(avg(pow({c} - mu, 2)), 2) - 3 as ku
  from s_, (select avg({c}) as mu from s_))"""


@query(_SRC + ", h_ as (" + " union all ".join(_shape(c) for c in _NUM) + f""")
select "column", {r('mean')} as mean, {r('skew')} as skew, {r('kurtosis')} as kurtosis,
  case when abs(skew) < 0.5 then 'normal' when skew > 0 then 'right' else 'left' end as shape
from h_""")
def distribution_shape(spark, d):
    return P.distribution_shape(_typed(spark, d), _NUM)


_YN = ["SeniorCitizen", "Partner", "Dependents", "PhoneService", "PaperlessBilling"]
_Y = "case Churn when 'Yes' then 1.0 when 'No' then 0.0 end"


def _corr(name, expr):
    return f" select '{name}' as feature, {r(f'corr({expr}, {_Y})')} as r from s_"


@query(_SRC.rstrip() + ", " * (not _SRC.rstrip().endswith(",")) + f"""l_ as (select unnest([{", ".join(
    f"{{'c': '{c}', 'v': {c}}}" for c in CATEGORICAL_COLS)}], recursive := true), {_Y} as y from s_),
v_ as (select c, v, row_number() over (partition by c order by v) as i from (select distinct c, v from l_
  where v is not null)),
d_ as (select l_.c || '_' || v_.v as feature, corr(cast(l_.v is not distinct from v_.v as int), y) as r
  from l_ join v_ on l_.c = v_.c where i > 1 group by 1)
select replace(feature, '.', '_') as feature, {r('r')} as r from d_ union all """ + " union all ".join(
    [_corr(c, c if c == "SeniorCitizen" else
           f"case {c} when 'Yes' then 1.0 when 'No' then 0.0 end") for c in _YN]
    + [_corr(c, f"cast({c} as double)") for c in ("tenure", "MonthlyCharges", "TotalCharges")]))
def target_correlation(spark, d):
    df = _typed(spark, d)
    levels = P.category_levels(df, CATEGORICAL_COLS)
    return P.target_correlation(df, "Churn", _YN, levels,
                                ["tenure", "MonthlyCharges", "TotalCharges"])


@query(ctes("customers") + f"""
select Contract as level, Churn as target, count(*) as n,
  {r('count(*) / cast(sum(count(*)) over (partition by Contract) as double) * 100', 2)}
    as percent
from customers group by Contract, Churn""")
def churn_rate_by_category(spark, d):
    df = V.customers(spark, d)
    return P.churn_rate_by_category(df, "Contract", "Churn").select(
        "level", "target", F.col("n"), "percent")
