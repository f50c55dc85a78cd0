"""What a threshold or a treated share is worth."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import count_edges, literal_edges
from ..functions.ordered import range_count, running_sums, sample_edges
from .metrics import P, Y, confusion_counts, recall_from_confusion, summarize_folds


@dataclass(frozen=True)
class Scenario:
    """Value of a saved customer and cost of each kind of error."""

    # The published default scenario.
    benefit_tp: float = 10.0
    cost_fp: float = 1.0
    cost_fn: float = 5.0


def threshold_grid(mode: str = "linspace", n: int = 201, fixed=None,
                   arange=None) -> list[float]:
    """Ascending thresholds: ``n`` even steps over [0, 1], the three-value toolkit grid, a
    fixed list, or ``arange=(start, end, step)`` with the end included."""
    if fixed is not None:
        return sorted(float(t) for t in fixed)
    if arange is not None:
        start, end, step = arange
        count = max(0, -int(-(end + 1e-12 - start) // step))
        return [start + i * step for i in range(count)]
    if mode == "toolkit":
        return [0.3, 0.5, 0.7]
    if n < 2:
        return [0.0] * n
    return [i / (n - 1) for i in range(n)]


def net_value(scenario: Scenario, count_fn: bool = True):
    value = F.col("tp") * scenario.benefit_tp - F.col("fp") * scenario.cost_fp
    return value - F.col("fn") * scenario.cost_fn if count_fn else value


def roi(net, cost, on_zero_cost: str = "nan"):
    """Net value over cost; without cost NULL, plus/minus infinity, or zero."""
    if on_zero_cost == "inf":
        free = F.when(net > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    elif on_zero_cost == "zero":
        free = F.lit(0.0)
    elif on_zero_cost == "nan":
        free = F.lit(None).cast("double")
    else:
        raise ValueError(f"unknown option: {on_zero_cost}")
    return F.when(cost <= 0, free).otherwise(F.try_divide(net, cost))


def sweep_thresholds(df: DataFrame, by=(), scenario: Scenario = Scenario(), thresholds=None,
                     y: str = Y, p: str = P) -> DataFrame:
    """Confusion counts, total cost and net value per group and threshold.

    Each score is put into its grid cell once; the counts per cell are then summed from the
    top. Rows are read once, whatever the number of thresholds, and a group is at most
    ``len(thresholds) + 1`` cells wide after the first aggregate.
    """
    by = list(by)
    grid = threshold_grid() if thresholds is None else sorted(float(t) for t in thresholds)
    if not grid:
        raise ValueError("no thresholds")
    steps = literal_edges(grid)
    cell = count_edges(F.col(p).cast("double"), steps, len(grid))
    cells = df.where(F.col(p).isNotNull()).groupBy(*by, cell.alias("cell")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    # a cell that holds no score still needs its threshold: spread each group over the grid
    group = cells.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("pos", "neg")))).alias("c"),
        F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    spread = group.select(*by, "c", "all_pos", "all_neg",
                          F.posexplode(steps).alias("position", "threshold")).withColumn(
        "cell", F.col("position") + 1)
    filled = spread.select(
        *by, "cell", "threshold", "all_pos", "all_neg",
        *[F.coalesce(F.try_element_at("c", F.col("cell")).getField(m), F.lit(0)).alias(m)
          for m in ("pos", "neg")])
    above = (W.partitionBy(*(by or [F.lit(0)])).orderBy(F.col("cell").desc())
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    counts = filled.select(
        *by, "threshold", "all_pos", "all_neg",
        F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"))
    full = counts.select(
        *by, "threshold", (F.col("all_neg") - F.col("fp")).alias("tn"), "fp",
        (F.col("all_pos") - F.col("tp")).alias("fn"), "tp")
    return full.select(
        "*", (F.col("fp") * scenario.cost_fp + F.col("fn") * scenario.cost_fn)
        .alias("total_cost"), net_value(scenario).alias("net_value"))


def best_threshold(sweep: DataFrame, by=(), objective: str = "net_value") -> DataFrame:
    """The best row per group; the lowest threshold wins a tie."""
    if objective == "net_value":
        goal = -F.col("net_value")
    elif objective == "total_cost":
        goal = F.col("total_cost")
    else:
        raise ValueError(f"unknown objective: {objective}")
    others = [c for c in sweep.columns if c not in by]
    best = sweep.groupBy(*by).agg(F.min_by(
        F.struct(*others), F.struct(goal.alias("goal"), F.col("threshold"))).alias("best"))
    return best.select(*by, *[F.col(f"best.{c}").alias(c) for c in others])


def net_value_at_threshold(df: DataFrame, threshold: float, by=(),
                           scenario: Scenario = Scenario(), on_zero_cost: str = "nan",
                           y: str = Y, p: str = P) -> DataFrame:
    counts = confusion_counts(df, by, threshold, y, p)
    action_cost = F.col("fp") * scenario.cost_fp
    return counts.withColumn("net_value", net_value(scenario)).withColumn(
        "action_cost", action_cost).withColumn(
        "roi", roi(F.col("net_value"), action_cost, on_zero_cost))


def net_value_at_topk(df: DataFrame, topk: float, by=(), row_id: str = "row_id",
                      scenario: Scenario = Scenario(), on_zero_cost: str = "nan",
                      y: str = Y, p: str = P) -> DataFrame:
    """Treat the ``max(ceil(n * topk), 1)`` highest scores of each group.

    Equal scores are taken by ascending ``row_id``. The cost of missed customers is left
    out here, unlike in threshold mode. Rows are counted by range of scores first; only those of
    the range that the last treated row lies in are ordered.
    """
    if not 0 < topk <= 1:
        raise ValueError("topk must lie in (0, 1]")
    rows = df.select(
        F.struct(*by, F.lit(0).alias("_")).alias("_group"),
        (-F.col(p).cast("double")).alias("_score"), F.col(row_id).alias("_id"),
        (F.col(y) == 1).cast("long").alias("pos"), (F.col(y) != 1).cast("long").alias("neg"),
        F.lit(1).cast("long").alias("one"))
    slots = range_count(rows, None)
    rows = rows.withColumn("_edges", sample_edges(rows.where(F.col("_score").isNotNull()).select(
        "_score", "_id"), "_score", slots).scalar())
    rows = rows.withColumn("_range", F.coalesce(count_edges("_score", "_edges", slots), F.lit(-1))).drop("_edges")
    # Rows and both classes per range of scores, best first, and those of the better ranges.
    sums = rows.groupBy("_group", "_range").agg(*(F.sum(c).alias(c) for c in ("one", "pos", "neg")))
    group = W.partitionBy("_group")
    better = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    cut = sums.withColumns({f"total_{c}": F.sum(c).over(group) for c in ("one", "pos", "neg")}).withColumns(
        {f"better_{c}": F.coalesce(F.sum(c).over(better), F.lit(0)) for c in ("one", "pos", "neg")}).withColumn(
        "k", F.greatest(F.ceil(F.col("total_one") * F.lit(float(topk))), F.lit(1)))
    left = F.col("k") - F.col("better_one")
    cut = cut.where((left > 0) & (left <= F.col("one")))
    # Only the rows of the range that holds the last treated row are put in order.
    inside = rows.join(cut.select("_group", "_range", left.alias("left")), ["_group", "_range"]).select(
        "_group", "left", F.struct(F.col("_score").alias("s"), F.col("_id").alias("id")).alias("_order"),
        "pos", "neg", "one")
    taken = running_sums(inside, ["_group"], "_order", ["one"]).where(F.col("cum_one") <= F.col("left"))
    taken = taken.groupBy("_group").agg(F.sum("pos").alias("tp_"), F.sum("neg").alias("fp_"))
    tp = F.coalesce("better_pos", F.lit(0)) + F.coalesce("tp_", F.lit(0))
    fp = F.coalesce("better_neg", F.lit(0)) + F.coalesce("fp_", F.lit(0))
    counts = cut.join(taken, "_group").select(
        *[F.col(f"_group.{c}").alias(c) for c in by], "k",
        (F.coalesce("total_neg", F.lit(0)) - fp).alias("tn"), fp.alias("fp"),
        (F.coalesce("total_pos", F.lit(0)) - tp).alias("fn"), tp.alias("tp"))
    action_cost = F.col("fp") * scenario.cost_fp
    return counts.withColumn("topk", F.lit(float(topk))).withColumn(
        "net_value", net_value(scenario, count_fn=False)).withColumn(
        "action_cost", action_cost).withColumn(
        "roi", roi(F.col("net_value"), action_cost, on_zero_cost))


def mode_label(mode: str, value: float | None = None) -> str:
    if mode == "threshold":
        return f"threshold_thr_{value:.2f}"
    if mode == "topk":
        return f"topk_{value:.4f}"
    return "sweep_foldwise"


def fold_values(df: DataFrame, by, mode: str = "threshold", value: float | None = 0.5,
                thresholds=None, scenario: Scenario = Scenario(), on_zero_cost: str = "nan",
                row_id: str = "row_id") -> DataFrame:
    """``by..., threshold, net_value, roi, recall`` for one evaluation mode."""
    if mode == "sweep":
        best = best_threshold(sweep_thresholds(df, by, scenario, thresholds), by)
        m = best.withColumn("roi", roi(F.col("net_value"), F.col("fp") * scenario.cost_fp,
                                       on_zero_cost))
    elif mode == "topk":
        m = net_value_at_topk(df, value, by, row_id, scenario, on_zero_cost).withColumn(
            "threshold", F.lit(None).cast("double"))
    elif mode == "threshold":
        m = net_value_at_threshold(df, value, by, scenario, on_zero_cost).withColumn(
            "threshold", F.lit(float(value)))
    else:
        raise ValueError(f"unknown mode: {mode}")
    return m.select(*by, "threshold", "net_value", "roi",
                    recall_from_confusion().alias("recall"))


VALUES = ("net_value", "roi", "recall")


def business_eval(df: DataFrame, run="model_name", fold="fold", **options) -> DataFrame:
    """Fold summaries per run: ``run, mode, <metric>_mean, <metric>_std, ...``."""
    mode = options.get("mode", "threshold")
    per_fold = fold_values(df, [run, fold], **options)
    long = per_fold.unpivot([run], [*VALUES, "threshold"], "metric", "value")
    stats = summarize_folds(long, "value", [run, "metric"])
    cells = [(m, s) for m in VALUES for s in ("mean", "std", "min", "max")]
    cells += [("threshold", "mean"), ("threshold", "std")]
    wide = stats.groupBy(run).agg(*[
        F.max(F.when(F.col("metric") == m, F.col(s))).alias(f"{m}_{s}") for m, s in cells])
    return wide.withColumn("mode", F.lit(mode))


def business_ranking(evaluated: DataFrame, metric: str = "recall") -> DataFrame:
    """Add ``position`` by the mean of a metric, best first (one row per run)."""
    if metric not in VALUES:
        raise ValueError(f"unknown metric: {metric}")
    best_first = W.partitionBy(F.lit(0)).orderBy(F.col(f"{metric}_mean").desc_nulls_last())
    return evaluated.withColumn("position", F.rank().over(best_first).cast("int"))


def absolute_gate(runs: DataFrame, metric: str, floor: float) -> DataFrame:
    """Keep rows with the metric at or above the floor; a missing value fails."""
    return runs.where(F.coalesce(F.col(metric) >= floor, F.lit(False)))


def business_metric_rows(df: DataFrame, run="model_name", fold="fold", tag: str = "",
                         **options) -> DataFrame:
    """Run-log rows ``run, key, step, value``: fold values, then means and deviations.

    Keys read ``business[.tag].<mode>.<metric>``; summary rows have no step.
    """
    mode = options.get("mode", "threshold")
    label = mode_label(mode, options.get("value", 0.5))
    prefix = ".".join(x for x in ("business", tag, label) if x)
    per_fold = fold_values(df, [run, fold], **options)
    long = per_fold.unpivot([run, fold], list(VALUES), "metric", "value")
    key = F.concat(F.lit(prefix + "."), F.col("metric"))
    steps = long.select(run, key.alias("key"), F.col(fold).cast("int").alias("step"), "value")
    names = [*VALUES] + (["threshold"] if mode == "sweep" else [])
    every = per_fold.unpivot([run], names, "metric", "value")
    name = F.when(F.col("metric") == "threshold", "best_threshold").otherwise(F.col("metric"))
    stats = summarize_folds(every, "value", [run, "metric"]).withColumn(
        "key", F.concat(F.lit(prefix + "."), name)).unpivot(
        [run, "key"], ["mean", "std"], "stat", "value")
    summary = stats.select(run, F.concat_ws("_", "key", "stat").alias("key"),
                           F.lit(None).cast("int").alias("step"), "value")
    return steps.unionByName(summary)

