import pytest
from pyspark.sql import functions as F

from keepline.constants import FEATURE_COLS
from keepline.operators import cleaning as C
from keepline.operators import features as X
from keepline.operators import scoring as G


def test_cleaned_table(raw):
    clean = C.preprocess(raw)
    assert clean.count() == 180
    assert clean.where("customerID is null").count() == 0
    assert clean.schema["TotalCharges"].dataType.simpleString() == "double"
    assert clean.where("TotalCharges is null").count() == 0
    for c in ("Partner", "Dependents", "PaperlessBilling"):
        assert {r[0] for r in clean.select(c).distinct().collect()} <= {0.0, 1.0}


def test_blank_total_takes_the_monthly_charge(raw):
    blanks = raw.where("TotalCharges = ' '").select("customerID", "MonthlyCharges")
    filled = C.preprocess(raw).select("customerID", "TotalCharges").join(blanks, "customerID")
    assert filled.count() > 0
    assert filled.where("TotalCharges <> MonthlyCharges").count() == 0


def test_missing_columns_raise(raw):
    with pytest.raises(ValueError):
        C.preprocess(raw.drop("TotalCharges"))
    with pytest.raises(ValueError):
        X.TelcoFeatures().fit(raw.drop("MonthlyCharges"))
    with pytest.raises(RuntimeError):
        X.TelcoFeaturesModel().transform(raw)


def test_blanks_stay_unless_asked(spark):
    df = spark.createDataFrame([("a", "x"), ("b", " "), ("c", None), ("d", "x")],
                               "id string, v string")
    keep = [r[0] for r in C.impute_mode(df, ["v"]).orderBy("id").select("v").collect()]
    fill = [r[0] for r in C.impute_mode(df, ["v"], True).orderBy("id").select("v").collect()]
    assert keep == ["x", " ", "x", "x"] and fill == ["x"] * 4


def test_features(raw):
    clean = C.preprocess(raw)
    model = X.TelcoFeatures().fit(clean)
    out = model.transform(clean)
    assert out.count() == 180
    limits = out.agg(F.min("MonthlyCharges_group"), F.max("MonthlyCharges_group"),
                     F.min("TotalCharges_group"), F.max("TotalCharges_group")).first()
    assert tuple(limits) == (0, 4, 0, 9)
    assert out.where("TotalChargesPerMonth is null or ltv is null").count() == 0
    unseen = out.drop("TotalCharges_group").withColumn("TotalCharges", F.lit(None).cast("double"))
    assert model.transform(unseen).where("TotalCharges_group <> -1").count() == 0


def test_single_value_edges(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert X.quantile_edges(df, {"v": 5}).first()["edges"] == [3.0, 5.0]


def test_request_rules(spark):
    base = {c: "x" for c in ("gender", "MultipleLines", "InternetService", "OnlineSecurity",
                             "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
                             "StreamingMovies", "Contract", "PaymentMethod")}
    base |= {"SeniorCitizen": 0.0, "Partner": 1.0, "Dependents": 0.0, "PhoneService": 1.0,
             "PaperlessBilling": 1.0, "tenure": 3.0, "MonthlyCharges": 50.0,
             "TotalCharges": "150"}
    cases = {"good": {}, "blank": {"TotalCharges": " "}, "none": {"TotalCharges": None},
             "negative": {"tenure": -1.0}, "absent": {"MonthlyCharges": None},
             "flag": {"Partner": 2.0}, "text": {"gender": None}}
    from keepline import schemas

    rows = [{**base, **v, "customer_id": f' "{k}" '} for k, v in cases.items()]
    df = spark.createDataFrame(
        [tuple(r[f.name] for f in schemas.SCORE_REQUEST) for r in rows], schemas.SCORE_REQUEST)
    got = {r["customer_id"]: r["errors"] for r in G.prepare_requests(df).collect()}
    assert got["good"] == got["blank"] == got["none"] == []
    assert got["negative"] == ["range:tenure"] and got["flag"] == ["range:Partner"]
    assert got["absent"] == ["missing:MonthlyCharges"] and got["text"] == ["missing:gender"]

    records, bad = G.score_requests(
        df, lambda x: x.withColumn("y_pred_proba", F.lit(0.7)), "m/1", request_id="r")
    assert bad.count() == 4
    log = records.orderBy("item_index").collect()
    assert [r["item_index"] for r in log] == [0, 1, 2]
    assert all(r["y_pred"] == 1 and r["request_id"] == "r" for r in log)
    assert '"TotalCharges":" "' in log[0]["features"]


def test_existing_columns_keep_the_wanted_order(raw):
    got = C.select_existing_columns(raw, ["tenure", "nope", "gender"]).columns
    assert got == ["tenure", "gender"]
    assert set(FEATURE_COLS) <= set(raw.columns)


def test_customer_id_quotes(spark):
    df = spark.createDataFrame([(" \"'a b'\" ",), ("plain",), ("'q\"",)], "v string")
    assert [r[0] for r in df.select(C.normalize_customer_id("v")).collect()] == [
        "a b", "plain", "q"]
