"""Choosing runs from the run log and testing models against each other.

``runs`` carries string parameters in a map; ``run_metrics`` is the metric history. Rules
that take "the newest" or "the best" use ``max_by`` aggregates, which combine before the
shuffle, instead of sorting a whole log.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import ALPHA, FLOAT_PARAMS, INT_PARAMS, N_FOLDS
from ..functions.expressions import parse_double
from ..functions.pvalues import chi2_p, range_p, signed_rank_p


def _param(name: str):
    return F.col("params").getItem(name)


# --- run log -----------------------------------------------------------------------------

def fold_metric(run_metrics: DataFrame, key: str, n_folds: int = N_FOLDS) -> DataFrame:
    """``run_id, fold, value``: the last value of each step 0..n-1, complete runs only."""
    steps = (
        run_metrics.where((F.col("key") == key) & F.col("step").between(0, n_folds - 1))
        .groupBy("run_id", F.col("step").alias("fold"))
        .agg(F.max_by("value", F.struct("ts", "value")).alias("value"))
    )
    # at most n_folds rows per run are left at this point
    return steps.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("run_id"))) \
        .where(F.col("n") == n_folds).drop("n")


def is_cv_run(n_folds: int = N_FOLDS):
    n = str(n_folds)
    return F.coalesce(_param("cv_folds") == n, F.lit(False)) | F.coalesce(
        _param("n_folds") == n, F.lit(False))


def display_name(params="params", run_id="run_id"):
    name = F.col(params).getItem("model_name")
    return F.when(name != "", name).otherwise(F.col(run_id))


def has_any_oof(runs: DataFrame, oof: DataFrame) -> DataFrame:
    """Runs with out-of-fold rows for fold 0."""
    ids = oof.where(F.col("fold") == 0).select("run_id").distinct()
    return runs.join(ids, "run_id", "left_semi")


def _newest():
    return F.struct("start_time", "run_id")


def latest_runs(runs: DataFrame, oof: DataFrame, n_folds: int = N_FOLDS) -> DataFrame:
    """The newest cross-validation run with out-of-fold rows per model name."""
    usable = has_any_oof(
        runs.where(is_cv_run(n_folds) & (_param("model_name") != "")), oof)
    return usable.groupBy(_param("model_name").alias("model_name")).agg(
        F.max_by("run_id", _newest()).alias("run_id"), F.max("start_time").alias("start_time"))


def winning_config_run(runs: DataFrame, oof: DataFrame, model: str = "mlp",
                       n_folds: int = N_FOLDS) -> DataFrame:
    """As ``latest_runs``, but for one model the run of the configuration that its newest
    refit names, where that run has out-of-fold rows."""
    refit = runs.where((_param("model_name") == model)
                       & _param("best_config_name").isNotNull())
    config = refit.agg(F.max_by(_param("best_config_name"), _newest())).scalar()
    named = runs.where(is_cv_run(n_folds)).withColumn("_config", config).where(
        (F.col("_config") != "") & (
            F.coalesce(_param("config_name") == F.col("_config"), F.lit(False))
            | F.coalesce(F.col("run_name") == F.col("_config"), F.lit(False))))
    newest = named.groupBy(F.lit(model).alias("model_name")).agg(
        F.max_by("run_id", _newest()).alias("run_id"), F.max("start_time").alias("start_time"))
    chosen = has_any_oof(newest, oof).withColumn("_first", F.lit(0)).unionByName(
        latest_runs(runs, oof, n_folds).withColumn("_first", F.lit(1)))
    # at most two rows per model name
    return chosen.groupBy("model_name").agg(
        F.min_by("run_id", "_first").alias("run_id"),
        F.min_by("start_time", "_first").alias("start_time"))


def cast_param(name, value):
    """Typed view of a string parameter: ``struct(text, int_value, double_value)``.

    "none" is NULL; whole-number and decimal parameters are known by name; ``k`` keeps
    "all" as text. Text that is no number stays text.
    """
    name, value = F.col(name), F.col(value)
    text = F.when(F.lower(value) != "none", value)
    number = parse_double(text)
    whole = name.isin(INT_PARAMS) & number.isNotNull() & (F.abs(number) < 9e18)
    decimal = name.isin(FLOAT_PARAMS) & number.isNotNull()
    return F.struct(
        F.when(~whole & ~decimal, text).alias("text"),
        F.when(whole, F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)))
        .cast("long").alias("int_value"),
        F.when(decimal, number).alias("double_value"))


def run_params(runs: DataFrame) -> DataFrame:
    """``run_id, name, text, int_value, double_value`` for model parameters and k."""
    long = runs.select("run_id", F.explode("params").alias("key", "raw")).where(
        F.col("key").startswith("model__") | (F.col("key") == "select_kbest__k"))
    named = long.withColumn("name", F.regexp_replace("key", "^model__", ""))
    return named.select("run_id", "name", cast_param("name", "raw").alias("v")).select(
        "run_id", "name", "v.*")


def best_run(runs: DataFrame, metric: str = "best_cv_score", search_type: str = "randomized"
             ) -> DataFrame:
    """Typed parameters of the run with the highest metric for a search type."""
    wanted = runs.where(_param("search_type") == search_type)
    best = wanted.where(F.col(metric).isNotNull()).agg(F.max_by(
        F.struct("run_id", F.col(metric).alias("score"), "params"),
        F.struct(F.col(metric), F.col("run_id"))).alias("b")).where(F.col("b").isNotNull())
    row = best.select("b.*")
    return row.select("run_id", "score").join(run_params(row), "run_id")


def gate_score(run_metrics: DataFrame, n_folds: int = N_FOLDS) -> DataFrame:
    """``run_id, gate_score``: best_cv_score, else cv_mean_recall, else the mean of a
    complete per-fold recall; NULL without any. One pass over the history."""
    order = F.struct(F.coalesce("step", F.lit(0)), F.col("ts"), F.col("value"))
    in_fold = (F.col("key") == "recall") & F.col("step").between(0, n_folds - 1)
    wanted = run_metrics.where(F.col("key").isin("best_cv_score", "cv_mean_recall", "recall"))
    last = wanted.groupBy("run_id", "key", F.when(in_fold, F.col("step")).alias("fold")).agg(
        F.max_by("value", order).alias("value"))
    per_run = last.groupBy("run_id").agg(
        F.max(F.when(F.col("key") == "best_cv_score", F.col("value"))).alias("a"),
        F.max(F.when(F.col("key") == "cv_mean_recall", F.col("value"))).alias("b"),
        F.count(F.when(F.col("key") == "recall", F.col("fold"))).alias("n"),
        F.avg(F.when((F.col("key") == "recall") & F.col("fold").isNotNull(), F.col("value")))
        .alias("c"))
    return per_run.select("run_id", F.coalesce(
        "a", "b", F.when(F.col("n") == n_folds, F.col("c"))).alias("gate_score"))


# --- comparing models on a fold table (model, fold, value) --------------------------------

def models_filter(scores: DataFrame, names, model: str = "model_name") -> DataFrame:
    return scores.where(F.col(model).isin(list(names)))


def technical_summary(scores: DataFrame, model: str = "model_name") -> DataFrame:
    """Mean, sample deviation and position by mean, best first."""
    s = scores.groupBy(model).agg(F.avg("value").alias("mean"),
                                  F.stddev_samp("value").alias("std"))
    return s.withColumn("position", F.row_number().over(
        W.partitionBy(F.lit(0)).orderBy(F.col("mean").desc(), model)).cast("int"))


def relative_gate(scores: DataFrame, baseline: str, rel: float = 0.0,
                  model: str = "model_name") -> DataFrame:
    """Rows of the models whose mean reaches the baseline mean times ``1 + rel``."""
    means = scores.groupBy(model).agg(F.avg("value").alias("mean"))
    base = means.where(F.col(model) == baseline).agg(F.max("mean")).scalar()
    checked = means.withColumn("_base", base).withColumn("_base", F.when(
        F.col("_base").isNull(),
        F.raise_error(F.lit(f"baseline '{baseline}' is not among the models")))
        .otherwise(F.col("_base")))
    keep = checked.where(F.col("mean") >= F.col("_base") * (1.0 + rel)).select(model)
    return scores.join(keep, model, "left_semi")


def fold_ranks(scores: DataFrame, model: str = "model_name", fold: str = "fold") -> DataFrame:
    """Mid-rank of each model within its fold, with the size of its tie group."""
    over, ties = W.partitionBy(fold).orderBy("value"), W.partitionBy(fold, "value")
    t = F.count(F.lit(1)).over(ties)
    return scores.select(model, fold, "value", t.alias("ties"),
                         (F.rank().over(over) + (t - 1) / 2.0).alias("rank"))


def friedman_statistic(scores: DataFrame, model: str = "model_name", fold: str = "fold"
                       ) -> DataFrame:
    """One row: models ``k``, folds ``n`` and the tie-corrected chi-square."""
    ranked = fold_ranks(scores, model, fold)
    # each tied value adds t^2 - 1, so a tie group of t adds t^3 - t
    ties = ranked.agg(F.sum(F.col("ties") * F.col("ties") - 1).alias("t"))
    per_model = ranked.groupBy(model).agg(F.sum("rank").alias("r"),
                                          F.count(F.lit(1)).alias("n"))
    total = per_model.agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n"),
                          F.sum(F.col("r") * F.col("r")).alias("ss"))
    k, n = F.col("k"), F.col("n")
    correction = 1 - F.col("t") / (n * (k * k - 1) * k).cast("double")
    raw = 12.0 / (n * k * (k + 1)) * F.col("ss") - 3.0 * n * (k + 1)
    return total.withColumn("t", ties.scalar()).select(
        "k", "n", F.try_divide(raw, correction).alias("friedman_stat"))


def friedman_test(scores: DataFrame, alpha: float = ALPHA, model: str = "model_name",
                  fold: str = "fold") -> DataFrame:
    """Adds the p-value and 0/1 significance; needs three models or more."""
    s = friedman_statistic(scores, model, fold).where(F.col("k") >= 3)
    return s.withColumn("p_value", chi2_p("friedman_stat", (F.col("k") - 1).cast("int"))) \
        .withColumn("significant", (F.col("p_value") < alpha).cast("int"))


def nemenyi_statistic(scores: DataFrame, model: str = "model_name", fold: str = "fold"
                      ) -> DataFrame:
    """``model_a, model_b, k, q``: studentized distance of mean ranks, every ordered pair.

    The join is over mean ranks, one row per model, on ``k`` (the number of models).
    """
    means = fold_ranks(scores, model, fold).groupBy(model).agg(
        F.avg("rank").alias("mean_rank"), F.count(F.lit(1)).alias("n"))
    sized = means.withColumn("k", F.count(F.lit(1)).over(W.partitionBy(F.lit(0))))
    a = sized.select("k", "n", F.col(model).alias("model_a"), F.col("mean_rank").alias("ra"))
    b = sized.select("k", F.col(model).alias("model_b"), F.col("mean_rank").alias("rb"))
    k = F.col("k")
    se = F.sqrt(k * (k + 1) / (F.col("n") * 6.0))
    pairs = a.join(b, "k").where(F.col("model_a") != F.col("model_b"))
    return pairs.select("model_a", "model_b", "k",
                        (F.abs(F.col("ra") - F.col("rb")) / se * F.sqrt(F.lit(2.0))).alias("q"))


def nemenyi_test(scores: DataFrame, model: str = "model_name", fold: str = "fold",
                 only_if_friedman: bool = False, alpha: float = ALPHA) -> DataFrame:
    """Pairwise p-values; empty when the global test is asked for and not significant."""
    pairs = nemenyi_statistic(scores, model, fold).withColumn(
        "p_value", range_p("q", F.col("k").cast("int")))
    if only_if_friedman:
        hit = friedman_test(scores, alpha, model, fold).agg(F.max("significant")).scalar()
        pairs = pairs.withColumn("_s", hit).where(F.col("_s") == 1).drop("_s")
    return pairs


def _paired(scores: DataFrame, a: str, b: str, model: str, fold: str) -> DataFrame:
    value = lambda m: F.max(F.when(F.col(model) == m, F.col("value")))
    return scores.where(F.col(model).isin(a, b)).groupBy(fold).agg(
        value(a).alias("a"), value(b).alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull()).select(
        F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), fold, "a", "b")


def wilcoxon_of_pairs(pairs: DataFrame, fold: str = "fold") -> DataFrame:
    """Signed-rank figures for ``model_a, model_b, fold, a, b`` rows, one row per pair.

    A pair has one row per fold, so every window and array here is that short.
    """
    key = ["model_a", "model_b"]
    d = F.col("a") - F.col("b")
    diff = pairs.select(*key, fold, d.alias("d"), F.abs(d).alias("m"),
                        (F.abs(d) <= 1e-8).cast("int").alias("near_zero"))
    nonzero = (F.col("m") > 0).cast("int")
    over = W.partitionBy(*key, "nz")
    ranked = diff.withColumn("nz", nonzero).withColumn(
        "t", F.count(F.lit(1)).over(W.partitionBy(*key, "m"))).withColumn(
        "r", F.rank().over(over.orderBy("m")) + (F.col("t") - 1) / 2.0)
    used = F.col("nz") == 1
    stats = ranked.groupBy(*key).agg(
        F.sum(F.when(used & (F.col("d") > 0), F.col("r")).otherwise(0.0)).alias("w_plus"),
        F.sum(F.when(used & (F.col("d") < 0), F.col("r")).otherwise(0.0)).alias("w_minus"),
        F.min("near_zero").alias("all_zero"),
        F.count_if(~used).alias("n_zero"),
        F.sort_array(F.collect_list(F.when(used, F.col("r")))).alias("ranks"),
        F.avg("d").alias("mean_diff"),
        F.coalesce(F.stddev_samp("d"), F.lit(0.0)).alias("sd"))
    zero = F.col("all_zero") == 1
    return stats.select(
        *key,
        F.when(zero, 0.0).otherwise(F.least("w_plus", "w_minus")).alias("stat"),
        "mean_diff",
        F.when(F.col("sd") > 0, F.try_divide("mean_diff", "sd")).otherwise(0.0)
        .alias("cohens_d"),
        "all_zero", "n_zero", "ranks")


def wilcoxon_test(scores: DataFrame, a: str, b: str, alpha: float = ALPHA,
                  model: str = "model_name", fold: str = "fold") -> DataFrame:
    """Paired signed-rank test of model ``a`` against ``b`` over folds."""
    return with_p_value(wilcoxon_of_pairs(_paired(scores, a, b, model, fold), fold), alpha)


def with_p_value(stats: DataFrame, alpha: float = ALPHA) -> DataFrame:
    p = F.when(F.col("all_zero") == 1, 1.0).otherwise(
        signed_rank_p("ranks", "stat", F.col("n_zero").cast("int")))
    return stats.withColumn("p_value", p).withColumn(
        "significant", (F.col("p_value") < alpha).cast("int")).drop(
        "all_zero", "n_zero", "ranks")


def decide_winner(scores: DataFrame, baseline: str | None, decision: str = "baseline_duel",
                  alpha: float = ALPHA, model: str = "model_name", fold: str = "fold"
                  ) -> DataFrame:
    """One row with winner, loser, both duel models, test figures and the reason.

    Without a significant gain ``baseline_duel`` keeps the baseline and ``top2_duel`` takes
    the second model. A missing baseline falls back to the duel of the two best.
    """
    if decision not in ("baseline_duel", "top2_duel"):
        raise ValueError(f"unknown decision rule: {decision}")
    if decision == "baseline_duel" and baseline is None:
        raise ValueError("baseline_duel needs a baseline")
    means = scores.groupBy(model).agg(F.avg("value").alias("mean"))
    ranked = means.agg(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("mean")).alias("s"), F.col(model)
                                             .alias("name")))), lambda x: x["name"]).alias("r"))
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    has_base = (F.lit(False) if decision == "top2_duel"
                else F.array_contains("r", F.lit(baseline)))
    base = F.lit(baseline).cast("string")
    rule = (F.lit("top2_duel") if decision == "top2_duel" else
            F.when(has_base, F.lit("baseline_duel"))
            .otherwise(F.lit("top2_duel_fallback_no_baseline")))
    a = F.when(has_base, F.when(first != base, first).otherwise(second)).when(
        second.isNotNull(), first)
    b = F.when(a.isNotNull(), F.when(has_base, base).otherwise(second))
    plan = ranked.select(
        "r", rule.alias("decision"), a.alias("duel_a"), b.alias("duel_b"),
        has_base.alias("has_base"), first.alias("first"))
    if decision == "top2_duel":
        plan = plan.withColumn("duel_a", F.when(
            F.size("r") < 2, F.raise_error(F.lit("top2_duel needs two models")))
            .otherwise(F.col("duel_a")))
    # the plan is one row; the fold rows of both duel models meet it on the model name
    sides = plan.select("duel_a", "duel_b", F.explode(F.array("duel_a", "duel_b")).alias(model))
    rows = scores.join(sides, model)
    pairs = rows.groupBy(F.col("duel_a").alias("model_a"), F.col("duel_b").alias("model_b"),
                         fold).agg(
        F.max(F.when(F.col(model) == F.col("duel_a"), F.col("value"))).alias("a"),
        F.max(F.when(F.col(model) == F.col("duel_b"), F.col("value"))).alias("b"))
    test = with_p_value(wilcoxon_of_pairs(pairs, fold), alpha)
    joined = plan.join(test, (F.col("duel_a") == F.col("model_a"))
                       & (F.col("duel_b") == F.col("model_b")), "left")
    better = F.coalesce((F.col("significant") == 1) & (F.col("mean_diff") > 0), F.lit(False))
    alone = F.col("duel_a").isNull()
    return joined.select(
        F.when(alone, F.col("first")).when(better, F.col("duel_a"))
        .otherwise(F.col("duel_b")).alias("winner"),
        F.when(~alone, F.when(better, F.col("duel_b")).otherwise(F.col("duel_a")))
        .alias("loser"),
        F.when(F.col("has_base"), base).alias("baseline"),
        "duel_a", "duel_b", "decision",
        F.when(alone & F.col("has_base"), "only_baseline_left")
        .when(alone, "baseline_not_eligible")
        .when(F.col("has_base") & better, "challenger_significantly_better_than_baseline")
        .when(F.col("has_base"), "no_sig_gain_over_baseline_choose_baseline")
        .when(better, "top1_significantly_better_than_top2")
        .otherwise("no_sig_diff_choose_top2").alias("reason"),
        "stat", "p_value", "mean_diff", "cohens_d", "significant",
        F.col("r").alias("ranked"))
