"""Explicit schemas of the stored tables."""

from pyspark.sql import types as T

_STR, _INT, _LONG, _DBL, _TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType(),
)


def _struct(**cols):
    return T.StructType([T.StructField(n, t) for n, t in cols.items()])


# TotalCharges stays a string so that blanks survive the read.
CUSTOMERS = _struct(
    customerID=_STR, gender=_STR, SeniorCitizen=_INT, Partner=_STR, Dependents=_STR,
    tenure=_INT, PhoneService=_STR, MultipleLines=_STR, InternetService=_STR,
    OnlineSecurity=_STR, OnlineBackup=_STR, DeviceProtection=_STR, TechSupport=_STR,
    StreamingTV=_STR, StreamingMovies=_STR, Contract=_STR, PaperlessBilling=_STR,
    PaymentMethod=_STR, MonthlyCharges=_DBL, TotalCharges=_STR, Churn=_STR,
)

PREDICTION_LOG = _struct(
    id=_LONG, created_at=_TS, request_id=_STR, batch_id=_STR, item_index=_INT,
    model_uri=_STR, threshold=_DBL, y_pred=_INT, y_pred_proba=_DBL, features=_STR,
)

# as written: partitioned by day
STORED_LOG = T.StructType(PREDICTION_LOG.fields + [T.StructField("created_date", T.DateType())])

DRIFT_METRICS = T.StructType([
    T.StructField("computed_at", _TS),
    T.StructField("window_days", _INT),
    T.StructField("n_rows", _LONG),
    T.StructField("psi", T.MapType(_STR, _DBL)),
    T.StructField("max_psi", _DBL),
    T.StructField("baseline_model_uri", _STR),
    T.StructField("model_uri_current", _STR),
])

OOF = _struct(
    run_id=_STR, model_name=_STR, fold=_INT, row_id=_LONG, y_true=_INT, y_proba=_DBL,
)

RUNS = T.StructType([
    T.StructField("run_id", _STR),
    T.StructField("run_name", _STR),
    T.StructField("start_time", _TS),
    T.StructField("params", T.MapType(_STR, _STR)),
    T.StructField("tags", T.MapType(_STR, _STR)),
])

RUN_METRICS = _struct(run_id=_STR, key=_STR, step=_INT, ts=_TS, value=_DBL)

BASELINE = _struct(feature=_STR, value=_DBL)

BASELINE_META = _struct(model_uri=_STR, n_rows=_LONG)

SCORE_REQUEST = _struct(
    customer_id=_STR, gender=_STR, SeniorCitizen=_DBL, Partner=_DBL, Dependents=_DBL,
    tenure=_DBL, PhoneService=_DBL, MultipleLines=_STR, InternetService=_STR,
    OnlineSecurity=_STR, OnlineBackup=_STR, DeviceProtection=_STR, TechSupport=_STR,
    StreamingTV=_STR, StreamingMovies=_STR, Contract=_STR, PaperlessBilling=_DBL,
    PaymentMethod=_STR, MonthlyCharges=_DBL, TotalCharges=_STR,
)

EVENTS = _struct(
    event_id=_LONG, ts=T.TimestampNTZType(), user_id=_LONG, event_type=_STR, value=_DBL,
    props=_STR,
)

ORDERS = _struct(
    o_orderkey=_LONG, o_custkey=_LONG, o_orderstatus=_STR, o_totalprice=_DBL,
    o_orderdate=T.TimestampNTZType(), o_orderpriority=_STR,
)
