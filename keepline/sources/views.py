"""Views that read the test tables in the shapes the operators expect.

Every view is a plain DataFrame plan over the Parquet tables; nothing is computed here.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import seeded_hash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(name: str):
    return F.col(name).cast("timestamp")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders, in the 21-column customer shape."""
    orders = table(spark, sf_dir, "orders")
    last_day = orders.agg(F.max("o_orderdate")).scalar()
    priorities = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    per_customer = orders.groupBy("o_custkey").agg(
        F.expr("count(1) as n"),
        F.expr("sum(cast(round(o_totalprice * 100) as bigint)) as cents"),
        F.expr("min(o_orderdate) as f"),
        F.expr("max(o_orderdate) as l"),
        *[F.expr(f"count_if(o_orderpriority = '{p}') as p{p[0]}") for p in priorities],
        F.expr("count_if(o_orderstatus = 'F') as sf"),
    )
    base = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(per_customer, F.expr("c_custkey = o_custkey"))
        .withColumn("idle", F.datediff(last_day, "l"))
        .selectExpr("*", "c_custkey as k", """case when c_mktsegment = 'MACHINERY' then 'No'
            when c_mktsegment in ('BUILDING', 'AUTOMOBILE') then 'DSL'
            else 'Fiber optic' end as inet""")
    )

    def yes_no(cond, name):
        return f"if({cond}, 'Yes', 'No') as {name}"

    def service(cond, name):
        return (f"case when inet = 'No' then 'No internet service' "
                f"when {cond} then 'Yes' else 'No' end as {name}")

    return base.selectExpr(
        "cast(k as string) as customerID",
        "if(k % 2 = 0, 'Female', 'Male') as gender",
        "if(k % 5 = 0, 1, 0) as SeniorCitizen",
        yes_no("c_acctbal > 4500", "Partner"),
        yes_no("n_regionkey < 2", "Dependents"),
        "cast(datediff(l, f) div 30 as int) as tenure",
        yes_no("k % 11 <> 0", "PhoneService"),
        "case when k % 11 = 0 then 'No phone service' when n >= 10 then 'Yes' else 'No' end"
        " as MultipleLines",
        "inet as InternetService",
        service("p1 >= 2", "OnlineSecurity"),
        service("p2 >= 2", "OnlineBackup"),
        service("p3 >= 2", "DeviceProtection"),
        service("p4 >= 2", "TechSupport"),
        service("p5 >= 2", "StreamingTV"),
        service("sf >= 4", "StreamingMovies"),
        "case when n >= 13 then 'Two year' when n >= 10 then 'One year'"
        " else 'Month-to-month' end as Contract",
        yes_no("k % 3 <> 0", "PaperlessBilling"),
        "case k % 4 when 0 then 'Electronic check' when 1 then 'Mailed check'"
        " when 2 then 'Bank transfer (automatic)' else 'Credit card (automatic)' end"
        " as PaymentMethod",
        "cast(floor(cents / cast(n * 2500 as double)) as double) / 100D as MonthlyCharges",
        "if(k % 97 = 0, ' ', cast(cast(floor(cents / 2500D) as bigint) as string))"
        " as TotalCharges",
        yes_no("idle > 300", "Churn"),
    )


def customer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, y, label_time``: the outcome and the day it became known (last order)."""
    orders = table(spark, sf_dir, "orders")
    last_day = orders.agg(F.max("o_orderdate")).scalar()
    return (
        orders.groupBy(F.col("o_custkey").alias("k"))
        .agg(F.max("o_orderdate").alias("label_time"))
        .select("k", F.when(F.datediff(last_day, "label_time") > 300, 1).otherwise(0)
                .alias("y"), "label_time")
    )


def oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold scores of four models over ten stratified folds.

    The fold rank is taken once per class (all models share it), in hash-prefix slices so
    that no class goes through a single task.
    """
    from ..operators.splits import stratified_kfold

    c = customers(spark, sf_dir).select(
        F.col("customerID").cast("long").alias("k"),
        F.when(F.col("Churn") == "Yes", 1).otherwise(0).alias("y"))
    folds = stratified_kfold(c, "k", "y")
    m = F.col("m")
    return folds.withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        F.concat(F.lit("run-m"), m.cast("string")).alias("run_id"),
        F.concat(F.lit("m"), m.cast("string")).alias("model_name"),
        "fold",
        F.col("k").alias("row_id"),
        F.col("y").alias("y_true"),
        (((9 - m) * ((F.col("k") * 7919 + m * 104729) % 1000)
          + (m + 1) * 1000 * F.col("y")).cast("double") / 10000.0).alias("y_proba"),
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    p = (key * 7919 % 1000).cast("double") / 1000.0
    return o.select(
        key.alias("id"),
        _ts("o_orderdate").alias("created_at"),
        F.concat(F.lit("r"), key.cast("string")).alias("request_id"),
        F.lit(None).cast("string").alias("batch_id"),
        F.lit(0).alias("item_index"),
        F.concat(F.lit("models:/m/"), (1 + key % 2).cast("string")).alias("model_uri"),
        F.lit(0.5).alias("threshold"),
        F.when(p >= 0.5, 1).otherwise(0).alias("y_pred"),
        p.alias("y_pred_proba"),
        F.to_json(F.struct("o_custkey", "o_totalprice")).alias("features"),
    )


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log whose JSON holds the drift features (TotalCharges as raw text)."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    total = F.when(key % 50 == 0, " ").otherwise(
        F.floor("o_totalprice").cast("long").cast("string"))
    return o.select(
        _ts("o_orderdate").alias("created_at"),
        ((key * 7919 % 1000).cast("double") / 1000.0).alias("y_pred_proba"),
        F.to_json(F.struct(
            (F.col("o_custkey") % 73).cast("double").alias("tenure"),
            (F.floor(F.col("o_totalprice") / 4000) + 1).cast("double").alias("MonthlyCharges"),
            total.alias("TotalCharges"),
        )).alias("features"),
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric history: five runs, ten steps, many values per step."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"),
        F.lit("recall").alias("key"),
        (F.col("user_id") % 10).cast("int").alias("step"),
        _ts("ts").alias("ts"),
        "value",
    )


def gate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``run_metrics`` but with summary keys on some runs and a gap in one of them."""
    step = F.col("step")
    return run_metrics(spark, sf_dir).withColumn(
        "key",
        F.when((F.col("run_id") == "click") & (step == 3), "best_cv_score")
        .when((F.col("run_id") == "view") & (step == 4), "cv_mean_recall")
        .when((F.col("run_id") == "error") & (step == 5), "other")
        .otherwise("recall"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event: model, folds, search settings as string parameters."""
    e = table(spark, sf_dir, "events")
    eid, uid, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    model = (F.when(kind == "signup", "mlp").when(kind == "click", "logreg")
             .when(kind == "view", "xgboost").when(kind == "purchase", "RandomForest"))
    refit = (kind == "signup") & (eid % 7 == 0)
    config = F.concat(F.lit("mlp_config_"), (uid % 6).cast("string"))
    params = {
        "model_name": model,
        "cv_folds": F.when(~refit & (eid % 3 == 0), "10"),
        "n_folds": F.when(~refit & (eid % 3 == 1), "10").when(~refit, "5"),
        "best_config_name": F.when(refit, config),
        "config_name": F.when((kind == "signup") & ~refit & (eid % 2 == 0), config),
        "search_type": F.when(kind == "view", "randomized"),
        "model__max_depth": (2 + eid % 7).cast("string"),
        "model__n_estimators": F.concat((100 + eid).cast("string"), F.lit(".0")),
        "model__learning_rate": F.when(eid % 4 == 0, "None").otherwise(
            F.concat(F.lit("0.0"), (1 + eid % 9).cast("string"))),
        "model__booster": F.lit("gbtree"),
        "select_kbest__k": F.when(eid % 5 == 0, "all").otherwise(
            (15 + eid % 3 * 5).cast("string")),
    }
    filled = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), v)])
    return e.select(
        F.concat(F.lit("run-"), eid.cast("string")).alias("run_id"),
        F.when((kind == "signup") & ~refit, config).otherwise(
            F.concat(kind, F.lit("_randomsearch"))).alias("run_name"),
        _ts("ts").alias("start_time"),
        F.map_filter(filled, lambda _, v: v.isNotNull()).alias("params"),
        F.create_map(F.lit("stage"), kind).alias("tags"),
        F.col("value").alias("best_cv_score"),
    )


def run_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold rows of the runs above; some runs lack fold 0."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("run-"), F.col("l_orderkey").cast("string")).alias("run_id"),
        ((F.col("l_linenumber") + F.col("l_orderkey")) % 10).cast("int").alias("fold"),
        F.col("l_partkey").alias("row_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y_true"),
        F.col("l_discount").alias("y_proba"),
    )


def telemetry_of(events: DataFrame) -> DataFrame:
    """Service telemetry from an events table or stream."""
    eid = F.col("event_id")
    return events.select(
        _ts("ts").alias("ts"),
        F.when(eid % 3 == 0, "GET").otherwise("POST").alias("method"),
        F.col("event_type").alias("path"),
        F.when(eid % 50 == 0, 500).when(eid % 20 == 0, 422).otherwise(200)
        .alias("status_code"),
        (F.col("value") / 1000).alias("latency_s"),
        F.when(eid % 20 != 0, (F.col("user_id") % 2).cast("int")).alias("predicted_class"),
        F.when(eid % 20 != 0, F.when(eid % 33 == 0, "error").otherwise("success"))
        .alias("insert_status"),
        F.when(eid % 20 != 0, F.col("value") / 2000).alias("inference_s"),
        F.when(eid % 20 != 0, F.col("value") / 7000).alias("sink_s"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_of(table(spark, sf_dir, "events"))


def score_requests_of(cust: DataFrame) -> DataFrame:
    """Scoring requests in the request shape, some of them broken on purpose."""
    k = F.col("customerID").cast("long")

    def flag(c):
        return F.when(F.col(c) == "Yes", 1.0).otherwise(0.0).alias(c)

    return cust.select(
        F.when(k % 17 == 0, F.concat(F.lit(" \"'"), "customerID", F.lit("'\" ")))
        .otherwise(F.col("customerID")).alias("customer_id"),
        "gender",
        F.col("SeniorCitizen").cast("double").alias("SeniorCitizen"),
        flag("Partner"), flag("Dependents"),
        F.when(k % 13 == 0, -1.0).otherwise(F.col("tenure").cast("double")).alias("tenure"),
        flag("PhoneService"),
        *[F.col(c) for c in ("MultipleLines", "InternetService", "OnlineSecurity",
                             "OnlineBackup", "DeviceProtection", "TechSupport",
                             "StreamingTV", "StreamingMovies", "Contract")],
        F.when(k % 29 == 0, 2.0).when(F.col("PaperlessBilling") == "Yes", 1.0)
        .otherwise(0.0).alias("PaperlessBilling"),
        "PaymentMethod",
        F.when(k % 19 != 0, F.col("MonthlyCharges")).alias("MonthlyCharges"),
        "TotalCharges",
    )


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_requests_of(customers(spark, sf_dir))


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary labels of documents with language and source, and a simple score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id", "lang", "source", F.col("quality").alias("y_true"),
        ((F.col("n_chars") % 1000).cast("double") / 1000.0).alias("y_proba"))


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with gaps, blanks and unknown words spread over the rows."""
    k = F.col("customerID").cast("long")
    return customers(spark, sf_dir).select(
        F.when(k % 41 != 0, F.col("customerID")).alias("customerID"),
        F.when(k % 23 != 0, F.col("gender")).alias("gender"),
        "SeniorCitizen",
        F.when(k % 37 == 0, "Maybe").otherwise(F.col("Partner")).alias("Partner"),
        "Dependents",
        F.when(k % 31 != 0, F.col("tenure")).alias("tenure"),
        "PhoneService", "MultipleLines", "InternetService",
        F.when(k % 43 == 0, " ").otherwise(F.col("OnlineSecurity")).alias("OnlineSecurity"),
        "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
        F.when(k % 29 != 0, F.col("Contract")).alias("Contract"),
        "PaperlessBilling", "PaymentMethod",
        F.when(k % 53 != 0, F.col("MonthlyCharges")).alias("MonthlyCharges"),
        F.when(k % 59 == 0, "n/a").otherwise(F.col("TotalCharges")).alias("TotalCharges"),
        F.when(k % 61 != 0, F.col("Churn")).alias("Churn"),
    )
