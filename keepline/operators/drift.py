"""Drift of a prediction log against a baseline.

All features travel in long form, so one shuffle of small per-bin counts serves them all.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import (
    DRIFT_FEATURES, DRIFT_MIN_ROWS, PSI_BINS, PSI_CRITICAL, PSI_WARNING,
)
from ..functions.expressions import left_closed_bin, ratio
from ..functions.ordered import exact_quantiles, long_format, numbered, running_sums
from .cleaning import coerce_numeric


def baseline_edges(expected: DataFrame, n_bins: int = PSI_BINS) -> DataFrame:
    """``feature, edges`` from a long baseline (feature, value)."""
    q = exact_quantiles(expected, ["feature"], "value", [i / n_bins for i in range(n_bins + 1)])
    return q.groupBy("feature").agg(F.sort_array(F.collect_set("q")).alias("edges"))


def bin_counts(long: DataFrame, edges: DataFrame, n_bins: int = PSI_BINS, by=()) -> DataFrame:
    """``by..., feature, bin, n``; bin is NULL for values outside the edges.

    ``edges`` has one short row per feature, so sending it to all tasks is bounded by the
    number of features.
    """
    known = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    binned = known.join(F.broadcast(edges), "feature")
    return binned.groupBy(*by, "feature",
                          left_closed_bin("value", "edges", n_bins + 1).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


def _bins_map(counts: DataFrame, by=(), name: str = "c") -> DataFrame:
    """One row per group with its bin counts as a map, the counted rows and the dropped."""
    inside = F.col("bin").isNotNull()
    return counts.groupBy(*by, "feature").agg(
        F.map_from_entries(F.collect_list(F.when(inside, F.struct("bin", "n")))).alias(name),
        F.sum(F.when(inside, F.col("n")).otherwise(0)).alias(f"{name}_inside"),
        F.sum("n").alias(f"{name}_rows"))


def _index_sum(edges, n_edges, e_map, e_sum, a_map, a_sum):
    """Sum over bins of (a - e) ln(a / e) with shares clipped to [1e-6, 1]."""
    def share(m, i, total):
        s = F.coalesce(F.try_element_at(m, i), F.lit(0)) / F.greatest(total, F.lit(1))
        return F.least(F.greatest(s, F.lit(1e-6)), F.lit(1.0))

    def term(acc, i):
        e, a = share(e_map, i, e_sum), share(a_map, i, a_sum)
        return acc + (a - e) * F.ln(a / e)

    bins = F.sequence(F.lit(0), n_edges - 2)
    return F.when(n_edges < 3, F.lit(0.0)).otherwise(
        F.aggregate(F.when(n_edges >= 3, bins).otherwise(F.array(F.lit(0))), F.lit(0.0), term))


def psi_from_counts(edges: DataFrame, expected: DataFrame, actual: DataFrame, by=()
                    ) -> DataFrame:
    """``by..., feature, psi, dropped`` from two sets of bin counts.

    NULL when a side has no values, 0 with fewer than three edges. ``dropped`` counts the
    actual values outside the baseline range.
    """
    # the same short edge table as in the counts, so its broadcast is shared with them
    base = _bins_map(expected, (), "e").join(F.broadcast(edges), "feature")
    both = base.join(_bins_map(actual, by, "a"), "feature", "inner" if by else "left")
    value = _index_sum(F.col("edges"), F.size("edges"), F.col("e"), F.col("e_inside"),
                       F.col("a"), F.col("a_inside"))
    return both.select(
        *by, "feature",
        F.when(F.coalesce("a_rows", F.lit(0)) > 0, value).alias("psi"),
        (F.coalesce("a_rows", F.lit(0)) - F.coalesce("a_inside", F.lit(0))).alias("dropped"))


def psi(expected: DataFrame, actual: DataFrame, n_bins: int = PSI_BINS) -> DataFrame:
    """Population stability index per feature of two long tables (feature, value)."""
    edges = baseline_edges(expected, n_bins)
    return psi_from_counts(edges, bin_counts(expected, edges, n_bins),
                           bin_counts(actual, edges, n_bins))


def drift_features(log: DataFrame, features=DRIFT_FEATURES) -> DataFrame:
    """Long form of the drift columns that the flattened log has, read as numbers."""
    present = [c for c in features if c in log.columns]
    return long_format(coerce_numeric(log, present), present)


def drift_report(baseline: DataFrame, log: DataFrame, features=DRIFT_FEATURES,
                 n_bins: int = PSI_BINS, min_rows: int = DRIFT_MIN_ROWS) -> DataFrame:
    """``feature, psi, dropped, n_rows, max_psi`` for the features both sides have.

    Empty when the log window has fewer than ``min_rows`` rows.
    """
    wanted = baseline.where(F.col("feature").isin(list(features)))
    n_rows = log.agg(F.count(F.lit(1))).scalar()
    present = [c for c in features if c in log.columns]
    report = psi(wanted, drift_features(log, features), n_bins).where(
        F.col("feature").isin(present)).withColumn("n_rows", n_rows)
    return report.where(F.col("n_rows") >= max(min_rows, 1)).withColumn(
        "max_psi", F.coalesce(F.max("psi").over(W.partitionBy("n_rows")), F.lit(0.0)))


def drift_summary(report: DataFrame, window_days: int, baseline_model_uri=None,
                  model_uri_current=None) -> DataFrame:
    """The report as one drift-metrics row with a feature map."""
    text = lambda v: F.lit(v).cast("string")
    return report.groupBy("n_rows", "max_psi").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "psi"))).alias("psi")).select(
        F.current_timestamp().alias("computed_at"), F.lit(window_days).alias("window_days"),
        "n_rows", "psi", "max_psi", text(baseline_model_uri).alias("baseline_model_uri"),
        text(model_uri_current).alias("model_uri_current"))


def drift_alert(max_psi="max_psi", limit: float = PSI_CRITICAL):
    """1 when a finite index reaches the limit, else 0."""
    c = F.col(max_psi)
    return F.when(c.isNotNull() & ~F.isnan(c) & (c < float("inf")) & (c >= limit), 1) \
        .otherwise(0)


def drift_severity(max_psi="max_psi", n_rows="n_rows", min_rows: int = DRIFT_MIN_ROWS):
    c = F.col(max_psi)
    return (F.when(F.col(n_rows) < min_rows, "silent").when(c >= PSI_CRITICAL, "critical")
            .when(c >= PSI_WARNING, "warning").otherwise("ok"))


def sustained_drift(history: DataFrame, order: str = "computed_at", by=(),
                    limit: float = PSI_CRITICAL, times: int = 3) -> DataFrame:
    """Add ``retrain``: 1 when the index exceeded the limit in ``times`` runs in a row.

    Runs are numbered over value ranges; each then counts towards its own and the next
    ``times`` - 1 numbers, so a history of any length is in no single task.
    """
    rows, keys = numbered(history, order, by), [*by, "_number"]
    towards = rows.select(*by, F.explode(F.sequence("_number", F.col("_number") + times - 1)).alias(
        "_number"), "max_psi")
    seen = towards.groupBy(*keys).agg(F.count("max_psi").alias("_n"), F.min("max_psi").alias("_least"))
    enough = (F.col("_n") == times) & (F.col("_least") > limit)
    return rows.join(seen, keys).select(
        *history.columns, F.coalesce(enough, F.lit(False)).cast("int").alias("retrain"))


def ks_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """``feature, ks, n_expected, n_actual``: two-sample distance of the distributions."""
    both = expected.select("feature", "value", F.lit(1).alias("e"), F.lit(0).alias("a")) \
        .unionByName(actual.select("feature", "value", F.lit(0).alias("e"), F.lit(1).alias("a")))
    counts = both.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy(
        "feature", "value").agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    ranked = running_sums(counts, ["feature"], "value", ["e", "a"])
    gap = F.abs(ratio("cum_e", "total_e") - ratio("cum_a", "total_a"))
    ks = ranked.groupBy("feature").agg(
        F.max(gap).alias("ks"), F.max("total_e").alias("n_expected"),
        F.max("total_a").alias("n_actual"))
    return ks.where((F.col("n_expected") > 0) & (F.col("n_actual") > 0))


def score_histogram(df: DataFrame, p: str = "y_pred_proba", bins: int = 10, by=()
                    ) -> DataFrame:
    """``by..., bin, n`` over [0, 1]; a score of 1 falls into the last bin."""
    b = F.least(F.greatest(F.floor(F.col(p) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(p).isNotNull()).groupBy(*by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
