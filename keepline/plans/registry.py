"""Registry of named queries; each may carry the SQL that must give the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.expressions import round_doubles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(spark, sf_dir)`` under its name; doubles are rounded to six digits."""
    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            CHECKS[key] = sql
        return fn

    return register
