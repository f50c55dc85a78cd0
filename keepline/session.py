"""Session helpers: where intermediate tables may be written."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Rows of whole texts go to Python in batches of so many, as several batches are held at once on both sides.
FEW_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what is run, not only planned, meanwhile."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``; where that is unset, a folder
    beside the warehouse tables, which all executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table that is read many times to the shared folder and read it back.

    The plan of the result starts at the written files, so a lost executor costs only the
    files it was reading.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
