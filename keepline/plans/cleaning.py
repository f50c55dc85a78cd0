"""Queries of the cleaning operators."""

from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..sources import views as V
from .registry import query
from .sqltext import ctes, r

_NUMBER = "try_cast(trim(TotalCharges) as double)"


@query(ctes("dirty") + f"""
select customerID, cast(tenure as double) as tenure, {r('MonthlyCharges')} as MonthlyCharges,
  {r(_NUMBER)} as TotalCharges from dirty""")
def coerce_numeric(spark, d):
    df = C.coerce_numeric(V.dirty_customers(spark, d), ["tenure", "TotalCharges"])
    return df.select("customerID", "tenure", "MonthlyCharges", "TotalCharges")


@query(ctes("dirty") + " select customerID, gender from dirty where customerID is not null")
def drop_null_key(spark, d):
    return C.drop_null_key(V.dirty_customers(spark, d)).select("customerID", "gender")


@query(ctes("dirty") + """
select customerID, cast(case Partner when 'Yes' then 1 when 'No' then 0 end as int) as Partner,
  cast(case Churn when 'Yes' then 1 when 'No' then 0 end as int) as Churn from dirty""")
def yes_no_to_int(spark, d):
    return C.yes_no_to_int(V.dirty_customers(spark, d)).select("customerID", "Partner", "Churn")


_TEXT = ["customerID", "gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
         "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
         "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
         "TotalCharges", "Churn"]
_NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges"]


@query(ctes("dirty") + " union all ".join(
    [f" select '{c}' as \"column\", 'categorical' as kind, "
     f"cast(coalesce(bool_or({c} is null or trim({c}) = ''), false) as int) as has_missing "
     "from dirty" for c in _TEXT]
    + [f" select '{c}', 'numeric', cast(coalesce(bool_or({c} is null), false) as int) from dirty"
       for c in _NUMERIC]))
def profile_null_columns(spark, d):
    return C.profile_null_columns(V.dirty_customers(spark, d))


@query(ctes("dirty") + f"""
select customerID, {r(f'coalesce({_NUMBER}, MonthlyCharges)')} as TotalCharges from dirty""")
def impute_total_from_monthly(spark, d):
    return C.impute_total_from_monthly(V.dirty_customers(spark, d)).select(
        "customerID", "TotalCharges")


@query(ctes("dirty") + f"""
select customerID,
  {r('coalesce(tenure, (select quantile_cont(tenure, 0.5) from dirty))')} as tenure,
  {r('coalesce(MonthlyCharges, (select quantile_cont(MonthlyCharges, 0.5) from dirty))')}
    as MonthlyCharges from dirty""")
def impute_median(spark, d):
    df = C.impute_median(V.dirty_customers(spark, d), ["tenure", "MonthlyCharges"])
    return df.select("customerID", "tenure", "MonthlyCharges")


def _mode(c):
    return (f"coalesce({c}, (select {c} from dirty where {c} is not null group by {c} "
            f"order by count(*) desc, {c} limit 1)) as {c}")


@query(ctes("dirty") + f"""
select customerID, {_mode('gender')}, {_mode('Contract')}, {_mode('OnlineSecurity')}
from dirty""")
def impute_mode(spark, d):
    cols = ["gender", "Contract", "OnlineSecurity"]
    return C.impute_mode(V.dirty_customers(spark, d), cols).select("customerID", *cols)


def _fill(c):
    return r(f"coalesce({c}, (select quantile_cont({c}, 0.5) from n_))") + f" as {c}"


def _fill_mode(c):
    return (f"coalesce({c}, (select {c} from n_ where {c} is not null group by {c} "
            f"order by count(*) desc, {c} limit 1)) as {c}")


@query(ctes("dirty") + f""", n_ as (select customerID, gender, Contract, OnlineSecurity,
    cast(tenure as double) as tenure, MonthlyCharges,
    coalesce({_NUMBER}, MonthlyCharges) as TotalCharges,
    case Partner when 'Yes' then 1.0 when 'No' then 0.0 end as Partner,
    case Churn when 'Yes' then 1.0 when 'No' then 0.0 end as Churn
  from dirty where customerID is not null)
select customerID, {_fill_mode('gender')}, {_fill_mode('Contract')},
  {_fill_mode('OnlineSecurity')}, {_fill('tenure')}, {_fill('MonthlyCharges')},
  {_fill('TotalCharges')}, {_fill('Partner')}, {_fill('Churn')} from n_""")
def preprocess(spark, d):
    return C.preprocess(V.dirty_customers(spark, d)).select(
        "customerID", "gender", "Contract", "OnlineSecurity", "tenure", "MonthlyCharges",
        "TotalCharges", "Partner", "Churn")


@query(ctes("customers") + " select Contract, gender, customerID from customers")
def select_existing_columns(spark, d):
    return C.select_existing_columns(
        V.customers(spark, d), ["Contract", "not_there", "gender", "customerID"])


_CHECKS = """concat_ws(',',
  case when tenure is null then 'missing:tenure' end,
  case when MonthlyCharges is null then 'missing:MonthlyCharges' end,
  case when not PaperlessBilling between 0 and 1 then 'range:PaperlessBilling' end,
  case when not tenure between 0 and 200 then 'range:tenure' end,
  case when not MonthlyCharges between 0 and 1000 then 'range:MonthlyCharges' end)"""


@query(ctes("requests") + f"""
select customer_id, {_CHECKS} as errors from requests""")
def validate_rows(spark, d):
    from ..operators.scoring import prepare_requests

    return prepare_requests(V.score_requests(spark, d)).select(
        "customer_id", F.concat_ws(",", "errors").alias("errors"))


@query(ctes("customers") + """
select customerID as customer_id, count(*) as n from customers group by 1""")
def normalize_customer_id(spark, d):
    raw = V.score_requests(spark, d)
    return raw.groupBy(C.normalize_customer_id("customer_id").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n"))


@query(ctes("requests") + f"""
select gender, tenure, {r('MonthlyCharges')} as MonthlyCharges, TotalCharges from requests""")
def to_model_input(spark, d):
    return C.to_model_input(V.score_requests(spark, d)).select(
        "gender", "tenure", "MonthlyCharges", "TotalCharges")
