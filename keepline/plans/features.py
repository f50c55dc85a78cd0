"""Queries of feature engineering, encoding, splits and class balance."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..constants import FLAG_SOURCES
from ..functions.ordered import column_quantiles
from ..operators import cleaning as C
from ..operators import encoding as E
from ..operators import features as X
from ..operators import splits as S
from ..session import materialize
from ..sources import views as V
from .registry import query
from .sqltext import ctes, r


def _clean(spark, d):
    return C.impute_total_from_monthly(V.customers(spark, d))


def _ps(q):
    return ", ".join(f"cast({i / q} as double)" for i in range(q + 1))


def _edges(c, q, source="clean"):
    return f"(select list_sort(list_distinct(quantile_cont({c}, [{_ps(q)}]))) from {source})"


def _bin(c, e):
    return (f"cast(case when {c} is null then -1 else greatest(len(list_filter({e}, "
            f"lambda x: x < least(greatest({c}, {e}[1]), {e}[len({e})]))) - 1, 0) end as int)")


@query(ctes("clean") + " union all ".join(
    f""" select '{c}' as feature, cast(i as int) as position, {r('e[i + 1]')} as edge
from (select e, unnest(range(len(e))) as i from (select {_edges(c, q)} as e))"""
    for c, q in (("MonthlyCharges", 5), ("TotalCharges", 10))))
def quantile_edges(spark, d):
    e = X.quantile_edges(_clean(spark, d), {"MonthlyCharges": 5, "TotalCharges": 10})
    return e.select("feature", F.posexplode("edges").alias("position", "edge"))


@query(ctes("dirty", "clean") + f""", ed_ as (select {_edges('MonthlyCharges', 5)} as e)
select customerID, {_bin('MonthlyCharges', 'e')} as bin from dirty, ed_""")
def apply_bins(spark, d):
    edges = X.quantile_edges(_clean(spark, d), {"MonthlyCharges": 5}).select("edges").scalar()
    df = V.dirty_customers(spark, d).withColumn("edges", edges)
    return df.select("customerID", X.apply_bins("MonthlyCharges", F.col("edges")).alias("bin"))


def _expr_query(name, sql, expr):
    @query(ctes("clean") + f" select customerID, {sql} as v from clean", name=name)
    def run(spark, d):
        return _clean(spark, d).select("customerID", expr().alias("v"))


_expr_query("total_charges_per_month", r("TotalCharges / (tenure + 1e-6)"),
            X.total_charges_per_month)
_expr_query("ltv", r("MonthlyCharges * tenure"), X.ltv)
_expr_query("one_plus_year_customer", "cast(coalesce(tenure > 12, false) as int)",
            X.one_plus_year_customer)
_expr_query("monthly_charges_squared", r("MonthlyCharges * MonthlyCharges"),
            X.monthly_charges_squared)


def _flag_sql(c):
    if c == "InternetService":
        return f"cast({c} is distinct from 'No' as int) as {c}_flag"
    return f"cast({c} is not distinct from 'Yes' as int) as {c}_flag"


_FLAGS = ", ".join(_flag_sql(c) for c in FLAG_SOURCES)


@query(ctes("customers") + f" select customerID, {_FLAGS} from customers")
def service_flags(spark, d):
    return V.customers(spark, d).select(
        "customerID", *[e.alias(n) for n, e in X.service_flags().items()])


@query(ctes("customers", "clean") + f""", ed_ as (select {_edges('MonthlyCharges', 5)} as em,
  {_edges('TotalCharges', 10)} as et),
raw_ as (select * exclude (TotalCharges), try_cast(trim(TotalCharges) as double) as TotalCharges
  from customers)
select customerID, {r('TotalCharges / (tenure + 1e-6)')} as TotalChargesPerMonth,
  {r('MonthlyCharges * tenure')} as ltv, {_bin('MonthlyCharges', 'em')} as MonthlyCharges_group,
  {_bin('TotalCharges', 'et')} as TotalCharges_group,
  cast(coalesce(tenure > 12, false) as int) as onePlusYearCustomer,
  {r('MonthlyCharges * MonthlyCharges')} as MonthlyCharges_squared, {_FLAGS}
from raw_, ed_""")
def TelcoFeatures(spark, d):  # noqa: N802
    raw = V.customers(spark, d)
    out = X.TelcoFeatures().fit(raw).transform(raw)
    return out.select(
        "customerID", "TotalChargesPerMonth", "ltv", "MonthlyCharges_group",
        "TotalCharges_group", "onePlusYearCustomer", "MonthlyCharges_squared",
        *[f"{c}_flag" for c in FLAG_SOURCES])


_LEVELS = ["Month-to-month", "One year", "Two year"]


@query(ctes("dirty") + ", f_ as (select customerID, coalesce(Contract, (select Contract from "
       "dirty where Contract is not null group by 1 order by count(*) desc, 1 limit 1)) as c "
       "from dirty) select customerID, " + ", ".join(
           f"cast(c = '{v}' as int) as contract_{i}" for i, v in enumerate(_LEVELS)) + " from f_")
def one_hot(spark, d):
    df = V.dirty_customers(spark, d).select("customerID", "Contract")
    out = E.one_hot(["Contract"]).fit(df).transform(df)
    slot = vector_to_array("Contract_oh")
    return out.select("customerID", *[F.get(slot, F.lit(i)).cast("int").alias(f"contract_{i}")
                                      for i in range(3)])


def _z(c):
    return f"""{r(f'(c_{c} - avg(c_{c}) over ()) / nullif(stddev_pop(c_{c}) over (), 0)')}
    as z_{c}"""


@query(ctes("dirty") + f""", f_ as (select customerID,
  coalesce(tenure, (select quantile_cont(tenure, 0.5) from dirty)) as c_tenure,
  coalesce(MonthlyCharges, (select quantile_cont(MonthlyCharges, 0.5) from dirty))
    as c_MonthlyCharges from dirty)
select customerID, {_z('tenure')}, {_z('MonthlyCharges')} from f_""")
def standard_scale(spark, d):
    df = V.dirty_customers(spark, d).select("customerID", "tenure", "MonthlyCharges")
    return E.standard_scale(df, ["tenure", "MonthlyCharges"]).select(
        "customerID", "z_tenure", "z_MonthlyCharges")


def _engineered(spark, d):
    clean = materialize(C.preprocess(V.customers(spark, d)), "clean").withColumn(
        "label", F.col("Churn").cast("double"))
    return X.TelcoFeatures().fit(clean).transform(clean)


@query()
def build_preprocessor(spark, d):
    df = _engineered(spark, d)
    out = E.build_preprocessor(df.columns).fit(df).transform(df)
    return out.select("customerID", F.posexplode(vector_to_array("encoded"))
                      .alias("slot", "value"))


@query()
def drop_constant(spark, d):
    df = _engineered(spark, d).withColumn("PaymentMethod", F.lit("one level"))
    out = E.build_preprocessor(df.columns).fit(df).transform(df)
    kept = E.drop_constant().fit(out).transform(out)
    return kept.groupBy(F.size(vector_to_array("encoded")).alias("slots_before"),
                        F.size(vector_to_array("varying")).alias("slots_after")).agg(
        F.count(F.lit(1)).alias("n"))


_MI_CAT, _MI_NUM = ["Contract", "PaymentMethod", "gender"], ["tenure", "MonthlyCharges"]
_MI_SQL = (ctes("clean") + ", " + ", ".join(
    f"e_{c} as (select {_edges(c, 10)} as e)" for c in _MI_NUM) + ", l_ as ("
    + " union all ".join(
        [f"select '{c}' as feature, {c} as level, Churn as y from clean" for c in _MI_CAT]
        + [f"select '{c}', cast({_bin(c, 'e')} as varchar), Churn from clean, e_{c}"
           for c in _MI_NUM]) + """),
n__ as (select feature, level, y, count(*) as n from l_ group by all),
t_ as (select feature, n / cast(sum(n) over (partition by feature) as double) as p,
    n * sum(n) over (partition by feature) / cast(sum(n) over (partition by feature, level)
      * sum(n) over (partition by feature, y) as double) as q from n__),
mi_ as (select feature, greatest(sum(p * ln(q)), 0) as mi from t_ group by feature) """)


def _mi(spark, d):
    return E.mutual_info_scores(_clean(spark, d), "Churn", _MI_CAT, _MI_NUM)


@query(_MI_SQL + f"select feature, {r('mi')} as mi from mi_")
def mutual_info_scores(spark, d):
    return _mi(spark, d)


def _psi(n):
    return f"(coalesce(list_sum(list_transform(range(1, {n}), lambda j: 1.0::double / j)), 0) - 0.5772156649015329)"


@query(ctes("clean") + ", i_ as (select row_number() over () as i, * from clean), l_ as (" + " union all ".join(
    f"select '{c}' as feature, i, cast({c} as double) as v, Churn as y from i_ where {c} is not null" for c in _MI_NUM)
    + f"""),
g_ as (select *, count(*) over (partition by feature, y) as nc from l_ qualify nc > 1),
d_ as (select a.feature, a.i, a.v, a.nc, least(3, a.nc - 1) as k, list_sort(list(abs(a.v - b.v))) as ds
  from g_ a join g_ b on a.feature = b.feature and a.y = b.y and a.i <> b.i group by all),
r_ as (select feature, i, v, nc, k, ds[k] as r from d_),
mm_ as (select r_.feature, r_.i, r_.nc, r_.k, count(*) filter (abs(g_.v - r_.v) < r - 1e-9 or g_.v = r_.v) as m
  from r_ join g_ on g_.feature = r_.feature group by all),
mi_ as (select feature, {_psi('count(*)')} + avg({_psi('k')}) - avg({_psi('nc')}) - avg({_psi('m')}) as mi
  from mm_ group by feature)
select feature, {r('greatest(mi, 0)')} as mi from mi_""")
def mutual_info_neighbours(spark, d):
    return E.mutual_info_neighbours(_clean(spark, d), "Churn", _MI_NUM)


@query(_MI_SQL + f"select feature, {r('mi')} as mi from mi_ order by mi_.mi desc, feature limit 3")
def select_k_best(spark, d):
    return E.select_k_best(_mi(spark, d), 3)


@query()
def to_float32(spark, d):
    df = _engineered(spark, d)
    out = E.build_preprocessor(df.columns).fit(df).transform(df)
    return out.select("customerID", F.size(E.to_float32("encoded")).alias("width"),
                      F.aggregate(E.to_float32("encoded"), F.lit(0.0),
                                  lambda a, x: a + x).alias("total"))


# --- splits and class balance ---------------------------------------------------------------

_RANK = ("row_number() over (partition by y order by md5(concat('42:', cast(k as varchar))), k)")


def _labels(spark, d):
    return V.customers(spark, d).select(
        F.col("customerID").cast("long").alias("k"),
        F.when(F.col("Churn") == "Yes", 1).otherwise(0).alias("y"))


def _split_sql(size, flag):
    return ctes("c") + f""" select k, y, cast({_RANK} <=
  round(count(*) over (partition by y) * {size}) as int) as {flag} from c"""


@query(_split_sql(0.2, "is_test"))
def stratified_split(spark, d):
    return S.stratified_split(_labels(spark, d), "k", "y")


@query(ctes("c") + f" select k, y, cast(({_RANK} - 1) % 10 as int) as fold from c")
def stratified_kfold(spark, d):
    return S.stratified_kfold(_labels(spark, d), "k", "y")


@query(_split_sql(0.1, "is_validation"))
def stratified_holdout(spark, d):
    return S.stratified_holdout(_labels(spark, d), "k", "y")


@query(ctes("dirty") + """
select Churn as class, count(*) as n,
  (round(count(*) / cast(sum(count(*)) over () as double), 4) + cast(0 as double)) as ratio
from dirty group by Churn""")
def class_distribution(spark, d):
    return S.class_distribution(V.dirty_customers(spark, d), "Churn")


@query(ctes("dirty") + f""", n_ as (select count(*) as n from dirty where Churn is not null
  group by Churn)
select {r('min(n) / cast(max(n) as double)')} as ratio,
  cast(min(n) / cast(max(n) as double) < 0.5 as int) as imbalanced from n_""")
def imbalance_ratio(spark, d):
    return S.imbalance_ratio(V.dirty_customers(spark, d), "Churn")


@query(ctes("c") + f"""
select count(*) filter (y = 1) as n_pos, count(*) filter (y = 0) as n_neg,
  {r('count(*) filter (y = 0) / cast(greatest(count(*) filter (y = 1), 1) as double)')}
    as pos_weight from c""")
def class_weights(spark, d):
    return S.class_weights(_labels(spark, d), "y")


@query(ctes("customers") + f"""
select Contract, p, {r('q')} as q from (
  select Contract, unnest([0.0, 0.1, 0.5, 0.9, 1.0]) as p,
    unnest(quantile_cont(MonthlyCharges, [0.0, 0.1, 0.5, 0.9, 1.0])) as q
  from customers group by Contract)""".replace("select Contract, p,",
                                                "select Contract, cast(p as double) as p,"))
def exact_quantiles(spark, d):
    return column_quantiles(V.customers(spark, d), ["MonthlyCharges"], [0.0, 0.1, 0.5, 0.9, 1.0],
                            ["Contract"]).drop("feature")
