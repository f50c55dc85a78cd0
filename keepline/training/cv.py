"""Cross-validation, search and final fits over a fold design; every fold is scored by the fit that left it out."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CHAMPION_PARAMS, PRIMARY_METRIC, SEED
from ..operators.metrics import compute_metrics
from ..operators.models import CLASSIFIERS
from ..operators.scoring import positive_probability
from .boosting import Trees, _mixed, fit_boosted, grow, grow_all
from .deep_trees import DeepTrees, grow_deep
from .design import Design, Shape
from .forest import fit_forest, forest_scorer
from .held import Rows, fits_in_tasks, side_by_side
from .kernel import Landmarks, fit_kernel, fit_kernel_held, margins
from .logistic import Fit, fit_logistic, scores
from .network import Network, fit_networks
from .rounds import Batch, summed

Scorer = Callable[[np.ndarray], np.ndarray]
#: Boosting without penalties or drawn columns, as plain gradient boosting has it.
PLAIN_BOOSTING = {"reg_lambda": 0.0, "reg_alpha": 0.0, "gamma": 0.0, "min_child_weight": 1e-6, "colsample_bytree": 1.0,
                  "subsample": 1.0, "scale_pos_weight": 1.0, "learning_rate": 0.1, "max_depth": 3, "n_estimators": 100}


#: Trees of a search that grow to any depth, and what a whole fit costs a task, by model.
DEEP = ("DecisionTree", "RandomForest")
TASK_COSTS = {"DecisionTree": lambda s: s.get("max_depth") or 30,
              "RandomForest": lambda s: s.get("n_estimators", 100) * min(s.get("max_depth") or 16, 16),
              "SVC_rbf": lambda s: 1.0, "GradientBoosting": lambda s: s.get("n_estimators", 100) * 2 ** (s.get("max_depth", 3) / 2),
              "xgboost": lambda s: s.get("n_estimators", 591) * 2 ** (s.get("max_depth", 4) / 2)}


def tree_scorer(shape: Shape, trees: Trees, left_out: int) -> Scorer:
    own = shape.learned[left_out]

    def of(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-trees.margin(shape.codes(x, own)[:, trees.slots])))

    return of


def network_scorer(shape: Shape, network: Network, left_out: int, k_best) -> Scorer:
    own = shape.learned[left_out]
    pick = own.best(k_best)

    def of(x: np.ndarray) -> np.ndarray:
        return network.probability(shape.scaled(x, own)[:, pick])

    return of


def deep_scorer(shape: Shape, trees: DeepTrees, left_out: int) -> Scorer:
    own = shape.learned[left_out]
    return lambda x: trees.share(shape.codes(x, own)[:, trees.slots])


def _kernel_scorers(design: Design, settings: list[dict], left_out: list[int]) -> dict[Fit, Scorer]:
    """Machines without calibration: a score of one half and more is a margin of 0 and more."""
    shape = design.shape
    fits = [Fit(i, s) for i in range(len(settings)) for s in left_out]
    if fits_in_tasks(design):
        found = side_by_side(design, lambda rows, f: fit_kernel_held(rows, f.left_out, settings[f.setting])[:2], fits)
    else:
        found = {}
        for i, setting in enumerate(settings):
            machines, beta = fit_kernel(design, setting, left_out)
            found |= {Fit(i, s): (machines[s], beta[s]) for s in left_out}

    def scorer(own: Landmarks, beta: np.ndarray, s: int) -> Scorer:
        def of(x: np.ndarray) -> np.ndarray:
            return 1 / (1 + np.exp(-np.clip(margins(own, beta, shape.picked(x, shape.learned[s], own.slots)), -500, 500)))

        return of

    return {f: scorer(*found[f], f.left_out) for f in fits}


def _boosted_params(name: str, setting: dict) -> dict:
    base = CHAMPION_PARAMS if name == "xgboost" else PLAIN_BOOSTING
    return {**base, **{k: v for k, v in setting.items() if k != "k_best"}}


def fit_all(design: Design, name: str, settings: list[dict], left_out: list[int]) -> dict[Fit, Scorer]:
    """Scorers of every setting without each listed fold. Regressions and networks of all settings share their passes;
    boosted trees and forests share them among folds."""
    shape = design.shape
    if name == "logreg":
        found = fit_logistic(design, settings, left_out)
        return {f: scores(shape, c, f.left_out) for f, c in found.items()}
    if name == "mlp":
        nets = fit_networks(design, settings, left_out)
        return {f: network_scorer(shape, n, f.left_out, settings[f.setting].get("k_best", "all")) for f, n in nets.items()}
    if name in DEEP and fits_in_tasks(design) and (name != "RandomForest" or any("min_samples_split" in s for s in settings)):
        fits = [Fit(i, s) for i in range(len(settings)) for s in left_out]
        grown = side_by_side(design, lambda rows, f: grow_deep(rows, f.left_out, settings[f.setting], name == "RandomForest")[0], fits)
        return {f: deep_scorer(shape, trees, f.left_out) for f, trees in grown.items()}
    if name == "RandomForest":
        return {Fit(i, s): forest_scorer(shape, trees, s) for i, setting in enumerate(settings)
                for s, trees in fit_forest(design, left_out, **setting).items()}
    if name == "SVC_rbf":
        return _kernel_scorers(design, settings, left_out)
    if name not in ("xgboost", "GradientBoosting"):
        raise ValueError(f"unknown model: {name}")
    out = {}
    for i, setting in enumerate(settings):
        own = _boosted_params(name, setting)
        for s, trees in fit_boosted(design, left_out, setting.get("k_best", "all"), **own).items():
            out[Fit(i, s)] = tree_scorer(shape, trees, s)
    return out


def out_of_fold(design: Design, scorers: dict[int, Scorer]) -> DataFrame:
    """fold, row_id, y_true, y_proba: one pass in which each row is scored by the fit without its fold."""
    kind = design.rows.schema["row_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fold, x = batch.column(1).to_numpy(), np.asarray(batch.column(3).flatten().to_numpy(), np.float64)
            x, p = x.reshape(len(fold), -1), np.full(len(fold), np.nan)
            for s, scorer in scorers.items():
                p[fold == s] = scorer(x[fold == s])
            yield pa.record_batch([batch.column(1), batch.column(0), batch.column(2).cast(pa.int32()), pa.array(p)],
                                  ["fold", "row_id", "y_true", "y_proba"])

    rows = design.rows.select("row_id", "fold", "label", "x")
    return rows.mapInArrow(score, f"fold int, row_id {kind}, y_true int, y_proba double")


def scored(design: Design, scorer: Scorer) -> DataFrame:
    """fold, row_id, y_true, y_proba of all rows by one fit."""
    return out_of_fold(design, dict.fromkeys(range(design.shape.n_folds), scorer))


def spark_out_of_fold(design: Design, name: str, k_best="all", parallelism: int = 4, **params) -> DataFrame:
    """The same for a Spark estimator: one fit for each left-out fold, side by side, on rows that are already encoded."""
    def one(s: int) -> DataFrame:
        rows = design.encoded(s, k_best)
        model = CLASSIFIERS[name](**params).fit(rows.where(F.col("fold") != s))
        out = model.transform(rows.where(F.col("fold") == s))
        return out.select("fold", "row_id", F.col("label").cast("int").alias("y_true"),
                          positive_probability(out).alias("y_proba"))

    with ThreadPool(parallelism) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, range(design.shape.n_folds), chunksize=1))


def fold_counts(design: Design, scorers: dict[Fit, Scorer], threshold: float = 0.5) -> dict[Fit, np.ndarray]:
    """(true positive, false positive, false negative, true negative) of each fit on the fold it left out, in one pass."""
    def work(batch: Batch, f: Fit) -> np.ndarray:
        held = batch.fold == f.left_out
        y, hit = batch.y[held] == 1, scorers[f](batch.x[held]) >= threshold
        return np.array([(y & hit).sum(), (~y & hit).sum(), (y & ~hit).sum(), (~y & ~hit).sum()], np.float64)

    return summed(design.rows, work, list(scorers), parts=design.parts)


def _counted(y: np.ndarray, hit: np.ndarray) -> np.ndarray:
    y = y == 1
    return np.array([(y & hit).sum(), (~y & hit).sum(), (y & ~hit).sum(), (~y & ~hit).sum()], np.float64)


def _dummy_counts(design: Design, name: str, fits: list[Fit]) -> dict[Fit, np.ndarray]:
    """Counts of the two models that read no slot: the most frequent class, and classes drawn by the rows' hashes."""
    learned, turn = design.shape.learned, _mixed(np.array([SEED + 1]))

    def work(batch: Batch, f: Fit) -> np.ndarray:
        own, held = learned[f.left_out], batch.fold == f.left_out
        share = own.positives / max(own.n, 1)
        draws = _mixed(batch.hash[held] ^ turn).astype(np.float64) / 2.0**64
        return _counted(batch.y[held], draws < share if name == "dummy_stratified" else np.full(len(draws), share > 0.5))

    return summed(design.rows, work, fits, parts=design.parts)


def left_out_counts(design: Design, name: str, settings: list[dict]) -> dict[Fit, np.ndarray]:
    """(true positive, false positive, false negative, true negative) of every setting on each fold, by the fit without it.

    Where a task can hold the rows, it sends the counts of its fits and no model. Else regressions take their passes
    together and all other models setting by setting, so the driver holds the models of one setting.
    """
    n = design.shape.n_folds
    fits = [Fit(i, s) for i in range(len(settings)) for s in range(n)]
    if name.startswith("dummy_"):
        return _dummy_counts(design, name, fits)
    if name in TASK_COSTS and fits_in_tasks(design):
        def work(rows: Rows, f: Fit) -> np.ndarray:
            setting, y = settings[f.setting], rows.y[rows.fold == f.left_out]
            if name in DEEP:
                hit = grow_deep(rows, f.left_out, setting, name == "RandomForest")[1] >= 0.5
            elif name == "SVC_rbf":
                hit = fit_kernel_held(rows, f.left_out, setting)[2] >= 0
            else:
                hit = grow(rows, f.left_out, setting.get("k_best", "all"), _boosted_params(name, setting), keep=False)[2] >= 0
            return _counted(y, hit)

        return side_by_side(design, work, fits, lambda f: TASK_COSTS[name](settings[f.setting]))
    if name in ("logreg", "mlp"):
        return fold_counts(design, fit_all(design, name, settings, list(range(n))))
    out = {}
    for i, setting in enumerate(settings):
        if name in DEEP:
            found = _spark_counts(design, name, setting)
        else:
            found = fold_counts(design, fit_all(design, name, [setting], list(range(n))))
        out |= {Fit(i, f.left_out): v for f, v in found.items()}
    return out


def _spark_counts(design: Design, name: str, setting: dict) -> dict[Fit, np.ndarray]:
    """The same for a decision tree or forest on rows that no task can hold: Spark's own, which bounds no node's rows."""
    params = {k: v for k, v in setting.items() if k not in ("k_best", "min_samples_split")}
    hit, y = F.col("y_proba") >= 0.5, F.col("y_true") == 1
    counts = spark_out_of_fold(design, name, setting.get("k_best", "all"), **params).groupBy("fold").agg(
        *[F.count_if(c).alias(n) for n, c in (("tp", y & hit), ("fp", ~y & hit), ("fn", y & ~hit), ("tn", ~y & ~hit))])
    return {Fit(0, r["fold"]): np.array([r["tp"], r["fp"], r["fn"], r["tn"]], np.float64) for r in counts.collect()}


def _metric(counts: np.ndarray, metric: str) -> float:
    tp, fp, fn, tn = counts
    share = lambda a, b: float(a / b) if b else 0.0
    return {"accuracy": share(tp + tn, tp + fp + fn + tn), "precision": share(tp, tp + fp), "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn)}[metric]


def search(design: Design, name: str, settings: list[dict], metric: str = PRIMARY_METRIC
           ) -> tuple[DataFrame, dict, Scorer | None]:
    """(table of candidates, best setting, its fit on all rows).

    A dummy has no fit, and on more rows than a task holds a decision tree or forest of a search none that scores raw slots.

    The table has one row per setting: its place, parameters, the metric on each fold, mean, deviation, and rank (1 is the
    best; equal means go to the first setting).
    """
    if metric not in ("accuracy", "precision", "recall", "f1"):
        raise ValueError(f"unknown search metric: {metric}")
    n = design.shape.n_folds
    counts = left_out_counts(design, name, settings)
    values = np.array([[_metric(counts[Fit(i, s)], metric) for s in range(n)] for i in range(len(settings))])
    means = values.mean(axis=1)
    order = np.argsort(-means, kind="stable")
    ranks = np.empty(len(order), int)
    ranks[order] = np.arange(1, len(order) + 1)
    rows = [(i, str(settings[i]), *map(float, values[i]), float(means[i]),
             float(values[i].std(ddof=1)) if n > 1 else 0.0, int(ranks[i])) for i in range(len(settings))]
    folds = "".join(f"split{s}_{metric} double, " for s in range(n))
    table = design.rows.sparkSession.createDataFrame(
        rows, f"candidate int, params string, {folds}mean_{metric} double, std_{metric} double, rank int")
    best = settings[int(order[0])]
    if name.startswith("dummy_"):
        return table, best, None
    if name in DEEP and not fits_in_tasks(design):
        params = {k: v for k, v in best.items() if k not in ("k_best", "min_samples_split")}
        CLASSIFIERS[name](**params).fit(design.encoded(n, best.get("k_best", "all")))
        return table, best, None
    return table, best, fit_all(design, name, [best], [n])[Fit(0, n)]


def best_trees(design: Design, trees: Trees, left_out: int) -> tuple[int, list[float]]:
    """(number of trees with the least loss on the left-out fold, mean loss after 1, 2, ... trees), from one pass.

    The loss is the one that the trees were grown for: a positive row weighs as much as there."""
    shape, n = design.shape, len(trees)

    def work(batch: Batch, s: int) -> np.ndarray:
        held = batch.fold == s
        codes, y = shape.codes(batch.x[held], shape.learned[s])[:, trees.slots], batch.y[held]
        w = np.where(y == 1, trees.positive, 1.0)
        out, margin = [float(held.sum())], np.full(len(y), trees.base)
        for t in range(n):
            one = Trees(0.0, trees.slots, trees.slot[t:t + 1], trees.split[t:t + 1], trees.value[t:t + 1], trees.gain[t:t + 1])
            margin = margin + one.added(codes)
            out.append((w * (np.logaddexp(0, margin) - y * margin)).sum())
        return np.array(out)

    v = summed(design.rows, work, [left_out], parts=design.parts)[left_out]
    return _least((v[1:] / max(v[0], 1)).tolist())


def _least(losses: list[float]) -> tuple[int, list[float]]:
    return int(np.argmin(losses)) + 1 if losses else 0, losses


def refit_champion(design: Design, k_best, **params) -> tuple[Trees, int]:
    """The final model: trees are counted on fold 0 by the fit without it, and kept of the fit on every row.

    Both fits grow side by side; the first trees of the longer fit are those of the shorter one.
    """
    n = design.shape.n_folds
    if fits_in_tasks(design):
        grown = grow_all(design, [0, n], k_best, {**CHAMPION_PARAMS, **params})
        count, full = _least(grown[0][1])[0], grown[n][0]
    else:
        fitted = fit_boosted(design, [0, n], k_best, **params)
        count, full = best_trees(design, fitted[0], 0)[0], fitted[n]
    return full.first(count), count


def sample_settings(space: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """Seeded settings of a space: a list is a choice, ("int" | "float" | "log", low, high) a range."""
    rng = random.Random(seed)

    def draw(spec):
        if isinstance(spec, list):
            return rng.choice(spec)
        kind, low, high = spec
        if kind == "int":
            return rng.randint(low, high)
        return rng.uniform(low, high) if kind == "float" else float(np.exp(rng.uniform(np.log(low), np.log(high))))

    return [{k: draw(v) for k, v in space.items()} for _ in range(n_iter)]


def fold_metrics(oof: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The six metrics of every fold."""
    return compute_metrics(oof, ["fold"], threshold)
