import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", "/tmp/keepline-tests")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def customer_rows(copies: int = 30):
    """Hand-made customers: six kinds, each repeated with its own id and charges."""
    out = []
    for i in range(copies):
        for j, (net, contract, churn) in enumerate((
            ("Fiber optic", "Month-to-month", "Yes"), ("DSL", "One year", "No"),
            ("No", "Two year", "No"), ("Fiber optic", "Month-to-month", "No"),
            ("DSL", "Month-to-month", "Yes"), ("Fiber optic", "Two year", "No"),
        )):
            svc = "No internet service" if net == "No" else ("Yes" if (i + j) % 2 else "No")
            monthly = 20.0 + 7.5 * j + (i * 13 % 11)
            tenure = (i * 5 + j * 11) % 72
            total = " " if tenure == 0 else f"{monthly * tenure:.2f}"
            out.append((
                f"{'ABCDEF'[j]}_{i}", "Female" if i % 2 else "Male", int(i % 5 == 0),
                "Yes" if j % 2 else "No", "Yes" if i % 3 == 0 else "No", tenure,
                "No" if j == 2 else "Yes",
                "No phone service" if j == 2 else ("Yes" if i % 2 else "No"), net, svc, svc,
                svc, svc, svc, svc, contract, "Yes" if i % 2 else "No",
                ("Electronic check", "Mailed check", "Credit card (automatic)",
                 "Bank transfer (automatic)")[i % 4], monthly, total, churn))
    return out


@pytest.fixture(scope="session")
def raw(spark):
    from keepline import schemas

    return spark.createDataFrame(customer_rows(), schemas.CUSTOMERS)


@pytest.fixture(scope="session")
def training(spark, raw):
    from keepline.operators.models import training_table

    return training_table(raw, n_folds=2)
