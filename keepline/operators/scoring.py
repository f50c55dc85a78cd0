"""Scores, classes and the scoring job."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cleaning import (
    accepted, coerce_numeric, normalize_customer_id, rejected, to_model_input, validate_rows,
)

PROBA = "y_pred_proba"


def sigmoid(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return 1.0 / (1.0 + F.exp(-c))


def positive_probability(scored: DataFrame) -> Column:
    """Probability of class 1 from whatever the model gave: its probability vector, else
    the sigmoid of its margin, else the prediction itself."""
    cols = scored.columns
    if "probability" in cols:
        return F.get(vector_to_array("probability"), F.lit(1))
    if "rawPrediction" in cols:
        return sigmoid(F.get(vector_to_array("rawPrediction"), F.lit(1)))
    if "margin" in cols:
        return sigmoid("margin")
    return F.col("prediction").cast("double")


def minmax_score(df: DataFrame, score: str, by=(), output: str = "y_proba") -> DataFrame:
    """Scale decision scores to [0, 1] within each group.

    Two figures per group are computed first and joined back, so a large group is never
    gathered in one task.
    """
    by = list(by)
    lims = df.groupBy(*by).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    if by:
        pairs = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
        both = df.alias("a").join(lims.alias("b"), pairs).select("a.*", "b._lo", "b._hi")
    else:
        both = df.withColumn("_l", lims.select(F.struct("_lo", "_hi").alias("s")).scalar()) \
            .withColumns({"_lo": F.col("_l._lo"), "_hi": F.col("_l._hi")}).drop("_l")
    scaled = (F.col(score) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(1e-12))
    return both.withColumn(output, scaled).drop("_lo", "_hi")


def apply_threshold(p, threshold: float = 0.5) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return (p >= F.lit(float(threshold))).cast("int")


def prediction_month(now=None, timezone: str = "America/Sao_Paulo") -> Column:
    """First day of the current month in the given zone, as text.

    ``now`` is an instant as a column in UTC; the current time by default.
    """
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if now is None else now
    return F.date_format(F.from_utc_timestamp(now, timezone), "yyyy-MM-01")


def batch_score(scored: DataFrame, threshold: float = 0.5, now=None,
                timezone: str = "America/Sao_Paulo", keep=(), proba: Column | None = None
                ) -> DataFrame:
    """``keep..., prediction_month, y_pred, y_pred_proba`` of a model's output."""
    p = positive_probability(scored) if proba is None else proba
    return scored.withColumn(PROBA, p).select(
        *keep, prediction_month(now, timezone).alias("prediction_month"),
        apply_threshold(PROBA, threshold).alias("y_pred"), F.col(PROBA).cast("double")
        .alias(PROBA))


#: Columns that say where a request came from; they are no values of it.
ORIGIN = ["request_id", "batch_id", "item_index"]


def prepare_requests(requests: DataFrame) -> DataFrame:
    """Requests with a clean id, the raw values kept beside the coerced ones, and errors."""
    clean = requests.withColumn("customer_id", normalize_customer_id("customer_id"))
    raw = clean.withColumn("raw", F.struct(*[c for c in clean.columns if c not in ORIGIN]))
    return validate_rows(coerce_numeric(raw))


def score_requests(requests: DataFrame, score: Callable[[DataFrame], DataFrame],
                   model_uri: str, threshold: float = 0.5, request_id: str = "request",
                   batch_id: str | None = None, index_by: str | None = "customer_id",
                   created_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(log records, rejected requests)`` of a batch of requests.

    ``score`` adds ``y_pred_proba`` to the model input (a pipeline's ``transform`` or any
    DataFrame function). The log keeps the raw values as sent. ``request_id``, ``batch_id`` and
    ``item_index`` columns of the requests are kept (see ``score_payloads``); without the last one
    ``item_index`` numbers the accepted requests by ranges of the id, or is left out with
    ``index_by=None``.
    """
    from ..functions.ordered import running_sums

    checked = prepare_requests(requests)
    good = accepted(checked)
    if "item_index" not in requests.columns and index_by is not None:
        numbered = good.withColumns({
            "_order": F.struct(F.col(index_by).alias("id"), F.xxhash64("raw").alias("h")),
            "_one": F.lit(1).cast("long")})
        good = running_sums(numbered, [], "_order", ["_one"]).withColumn(
            "item_index", F.col("cum__one") - 1).drop("_order", "_one", "cum__one",
                                                      "total__one")
    scored = score(to_model_input(good))
    from ..sources.tables import log_records

    records = log_records(
        scored.withColumn("y_pred", apply_threshold(PROBA, threshold)), ["raw.*"], {
            "created_at": F.current_timestamp() if created_at is None else created_at,
            **{c: v for c, v in (("request_id", F.lit(request_id)), ("batch_id", F.lit(batch_id).cast("string")))
               if c not in requests.columns},
            "model_uri": F.lit(model_uri), "threshold": F.lit(float(threshold))})
    return records, rejected(checked)


def score_payloads(payloads: DataFrame, score: Callable[[DataFrame], DataFrame], model_uri: str,
                   threshold: float = 0.5, items: str = "items", request_id: str = "request_id",
                   created_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(log records, rejected requests)`` of payloads: a request id and an array of requests each.

    ``item_index`` is the position in the payload, from 0, whatever happens to the other items; the
    payload's ``batch_id`` is a hash of its request id. Nothing is shuffled. Null and empty
    payloads give no rows.
    """
    rows = payloads.select(F.col(request_id).alias("request_id"), F.md5(F.col(request_id)).alias("batch_id"),
                           F.posexplode(items).alias("item_index", "item"))
    rows = rows.select("request_id", "batch_id", "item_index", "item.*")
    return score_requests(rows, score, model_uri, threshold, created_at=created_at)


def external_model_score(df: DataFrame, predict: Callable[[pd.DataFrame], object],
                         feature_cols, output: str = PROBA) -> DataFrame:
    """Score with any Python model that takes a Pandas frame.

    The model may return a frame with the score column (or a single column), a series or an
    array. It is applied to Arrow batches where the rows are; only the features travel.
    """
    features = list(feature_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema),
                        f"`{output}` double"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = predict(batch[features])
            if isinstance(raw, pd.DataFrame):
                if output in raw.columns:
                    raw = raw[output]
                elif raw.shape[1] == 1:
                    raw = raw.iloc[:, 0]
                else:
                    raise TypeError(f"model output has no column {output}")
            values = pd.Series(getattr(raw, "values", raw), dtype="float64")
            if len(values) != len(batch):
                raise ValueError("model output has another length than its input")
            yield batch.assign(**{output: values.to_numpy()})

    return df.mapInPandas(score, schema)


def with_item_index(df: DataFrame, order: str, by) -> DataFrame:
    """Position of an item within its own request (a request is one payload)."""
    return df.withColumn("item_index", F.row_number().over(
        W.partitionBy(*by).orderBy(order)) - 1)
