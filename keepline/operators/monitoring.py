"""Model quality once labels are known."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import ratio
from ..functions.ordered import numbered
from .metrics import compute_metrics


def join_delayed_labels(log: DataFrame, labels: DataFrame, key: str, label_time="label_time",
                        created_at="created_at") -> DataFrame:
    """Predictions with the label that became known after them.

    An equi-join on the customer key with a time condition; a customer with very many
    predictions is split by adaptive skew handling, since the label side has one row per key.
    """
    later = F.col(label_time) > F.col(created_at)
    return log.join(labels, key).where(later)


def delayed_label_eval(joined: DataFrame, created_at="created_at", threshold: float = 0.5,
                       y="y_true", p="y_proba", by=()) -> DataFrame:
    """The six metrics per month of prediction."""
    month = F.date_format(created_at, "yyyy-MM-01").alias("month")
    return compute_metrics(joined.withColumn("month", month), ["month", *by], threshold, y, p)


def actual_vs_predicted_rate(joined: DataFrame, by=(), y="y_true", y_pred="y_pred",
                             p="y_proba") -> DataFrame:
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("actual_rate"),
        F.avg(y_pred).alias("predicted_rate"), F.avg(p).alias("mean_proba"))


def calibration_table(joined: DataFrame, bins: int = 10, by=(), y="y_true", p="y_proba"
                      ) -> DataFrame:
    """Mean label and mean score per equal-width score bin."""
    b = F.least(F.greatest(F.floor(F.col(p) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return joined.where(F.col(p).isNotNull()).groupBy(*by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("actual_rate"),
        F.avg(p).alias("mean_proba"))


def subgroup_performance(df: DataFrame, segment: str, threshold: float = 0.5, y="y_true",
                         p="y_proba") -> DataFrame:
    """The six metrics per segment with its size."""
    sizes = df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"))
    return compute_metrics(df, [segment], threshold, y, p).join(sizes, segment)


def performance_drop_alert(per_window: DataFrame, order: str, by=(), max_drop: float = 0.05
                           ) -> DataFrame:
    """Compare each window with the one before: recall drop and rise of false positives.

    ``per_window`` holds one row per window with ``recall`` and ``fp_rate``. Windows are numbered
    over value ranges and joined to the number before, so no task holds the whole history.
    """
    rows, keys = numbered(per_window, order, by), [*by, "_number"]
    before = rows.select(*by, (F.col("_number") + 1).alias("_number"),
                         F.col("recall").alias("recall_before"), F.col("fp_rate").alias("_fp"))
    before_, recall = F.col("recall_before"), F.col("recall")
    return rows.join(before, keys, "left").select(
        *per_window.columns, "recall_before",
        F.coalesce(ratio(before_ - recall, before_, empty=None) > max_drop, F.lit(False))
        .cast("int").alias("recall_drop"),
        F.coalesce(F.col("fp_rate") > F.col("_fp"), F.lit(False)).cast("int").alias("fp_rise"))
