"""Training: pipelines, cross-validation, search and final fits with Spark ML."""

import itertools
import random
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
    MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CHAMPION_K_BEST, CHAMPION_PARAMS, FEATURE_COLS, KEY_COL, METRICS, N_FOLDS,
    PRIMARY_METRIC, SEED, TARGET_COL,
)
from ..functions.expressions import hash_unit
from ..session import materialize
from .cleaning import preprocess
from .encoding import KBestSelector, build_preprocessor, drop_constant
from .features import TelcoFeatures
from .metrics import compute_metrics, confusion_counts, cv_summary, rates
from .scoring import positive_probability
from .splits import stratified_holdout, stratified_kfold

LABEL = "label"


def training_table(raw: DataFrame, n_folds: int = N_FOLDS, seed: int = SEED,
                   key: str = KEY_COL, target: str = TARGET_COL) -> DataFrame:
    """Cleaned features with ``label``, ``fold`` and the two weight columns.

    The cleaned rows are written once: ranking, weights and every fit read them again.
    """
    clean = preprocess(raw)
    # an imputed target between the classes counts as the nearer one
    y = clean.withColumn(LABEL, F.round(F.col(target)).cast("double")).select(
        key, *[c for c in FEATURE_COLS if c in clean.columns], LABEL)
    rows = materialize(y, "clean")
    return materialize(stratified_kfold(add_weights(rows), key, LABEL, n_folds, seed),
                       "training")


def add_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """``w_none`` is 1; ``w_balanced`` gives both classes the same total weight."""
    counts = df.agg(F.struct(F.count(F.lit(1)).alias("n"),
                             F.count_if(F.col(label) == 1).alias("pos")).alias("s"))
    with_counts = df.withColumn("_n", counts.scalar())
    n, pos = F.col("_n.n"), F.col("_n.pos")
    share = F.when(F.col(label) == 1, pos).otherwise(n - pos)
    return with_counts.withColumn("w_none", F.lit(1.0)).withColumn(
        "w_balanced", n / (2.0 * F.greatest(share, F.lit(1)))).drop("_n")


def feature_stages(k_best="all", strict_reference: bool = False, approx: bool = False) -> list:
    """Derived columns, encoding, constant removal and selection, as stages."""
    engineered = FEATURE_COLS + [
        "ltv", "TotalChargesPerMonth", "MonthlyCharges_squared", "MonthlyCharges_group",
        "TotalCharges_group", "onePlusYearCustomer",
    ] + [f"{c}_flag" for c in (
        "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
        "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies")]
    return [
        TelcoFeatures(approx=approx),
        *build_preprocessor(engineered, strict_reference).getStages(),
        drop_constant(),
        KBestSelector(k=0 if k_best == "all" else int(k_best)),
    ]


# --- estimators Spark has no direct counterpart for -------------------------------------------

class _KernelParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "mapped vector", TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "most landmarks", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the choice", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="kernel", gamma=0.05, size=256, seed=SEED)


class NystroemMap(Estimator, _KernelParams, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose inner product is the RBF kernel on a set of landmark rows, and near it elsewhere.

    Landmarks are the ``size`` distinct rows with the smallest seeded hash: the only rows that reach the driver. The
    map is the kernel with the landmarks times the inverse root of the kernel among them; directions without weight
    are left out. Up to ``size`` distinct rows the kernel is exact."""

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="kernel", gamma=0.05, size=256, seed=SEED):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        gamma, size, seed = (self.getOrDefault(p) for p in ("gamma", "size", "seed"))
        x = vector_to_array(self.getOrDefault("inputCol"))
        rows = dataset.select(x.alias("x")).distinct().orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(size)
        marks = np.array([r["x"] for r in rows.collect()], dtype=float)
        values, vectors = np.linalg.eigh(_rbf(marks, marks, gamma))
        keep = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
        root = vectors[:, keep] / np.sqrt(values[keep])
        return self._copyValues(NystroemModel(marks=marks.ravel().tolist(), root=root.ravel().tolist(),
                                              width=marks.shape[1] if marks.ndim == 2 else 0))


class NystroemModel(Model, _KernelParams, DefaultParamsReadable, DefaultParamsWritable):
    marks = Param(Params._dummy(), "marks", "landmarks, row by row", TypeConverters.toListFloat)
    root = Param(Params._dummy(), "root", "map from the landmark kernel, row by row", TypeConverters.toListFloat)
    width = Param(Params._dummy(), "width", "length of a landmark", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, marks=None, root=None, width=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, width = self.getOrDefault("gamma"), max(self.getOrDefault("width"), 1)
        marks = np.array(self.getOrDefault("marks")).reshape(-1, width)
        root = np.array(self.getOrDefault("root")).reshape(len(marks), -1)

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype=object)
            return pd.Series(list(_rbf(np.stack(x.to_numpy()), marks, gamma) @ root))

        return dataset.withColumn(self.getOrDefault("outputCol"), array_to_vector(
            project(vector_to_array(self.getOrDefault("inputCol")))))


def _rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(square, 0))


class NetworkClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Feed-forward network that takes its input width from the data.

    The Spark network has no weights, so rows of the positive class are repeated to the
    class weight; the fractional part is decided by a seeded hash of the row.
    """

    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "step size", TypeConverters.toFloat)
    solver = Param(Params._dummy(), "solver", "gd or l-bfgs", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, hidden=None, maxIter=100, stepSize=0.03, solver="l-bfgs", seed=SEED):
        super().__init__()
        self._setDefault(hidden=[64, 32], maxIter=100, stepSize=0.03, solver="l-bfgs", seed=SEED)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame):
        rows = dataset.select("features", LABEL)
        head = dataset.agg(F.count_if(F.col(LABEL) == 1).alias("pos"),
                           F.count_if(F.col(LABEL) == 0).alias("neg"),
                           F.max(F.size(vector_to_array("features"))).alias("d")).first()
        weight = head["neg"] / max(head["pos"], 1)
        extra = F.when(F.col(LABEL) == 1, F.floor(F.lit(weight)) + (hash_unit(
            self.getOrDefault("seed"), vector_to_array("features")) < weight % 1).cast("int")) \
            .otherwise(1)
        repeated = rows.select("features", LABEL, F.explode(
            F.sequence(F.lit(1), F.greatest(extra, F.lit(1)).cast("int"))).alias("_copy")) \
            .drop("_copy")
        return MultilayerPerceptronClassifier(
            layers=[head["d"], *self.getOrDefault("hidden"), 2], labelCol=LABEL,
            maxIter=self.getOrDefault("maxIter"), stepSize=self.getOrDefault("stepSize"),
            solver=self.getOrDefault("solver"),
            seed=self.getOrDefault("seed")).fit(repeated)


def _weights(params: dict) -> str:
    return "w_balanced" if params.get("class_weight") == "balanced" else "w_none"


class PenaltyByRows(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a linear estimator whose penalty is 1 / (C n), n being the rows it is fitted on."""

    C = Param(Params._dummy(), "C", "inverse penalty of the sum of losses", TypeConverters.toFloat)
    margin = Param(Params._dummy(), "margin", "fit a margin, not a probability",
                   TypeConverters.toBoolean)
    l1 = Param(Params._dummy(), "l1", "share of the absolute penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    weightCol = Param(Params._dummy(), "weightCol", "row weights", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, C=1.0, margin=False, l1=0.0, maxIter=100, weightCol="w_none"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(C=1.0, margin=False, l1=0.0, maxIter=100, weightCol="w_none")

    def _fit(self, dataset: DataFrame):
        get = self.getOrDefault
        reg = 1.0 / (get("C") * max(dataset.count(), 1))
        common = {"labelCol": LABEL, "regParam": reg, "maxIter": get("maxIter"),
                  "weightCol": get("weightCol")}
        if get("margin"):
            return LinearSVC(featuresCol="kernel", rawPredictionCol="svm_raw",
                             predictionCol="svm_class", **common).fit(dataset)
        return LogisticRegression(elasticNetParam=get("l1"), **common).fit(dataset)


def logreg(n_rows: int | None = None, max_iter: int = 100, **p) -> Estimator:
    """Elastic-net logistic regression; ``C`` becomes 1 / (C n), n being ``n_rows`` or else the
    rows of each fit."""
    if n_rows is None:
        return PenaltyByRows(C=float(p.get("C", 1.0)), l1=float(p.get("l1_ratio", 0.0)),
                             maxIter=max_iter, weightCol=_weights(p))
    return LogisticRegression(labelCol=LABEL, maxIter=max_iter,
                              regParam=1.0 / (p.get("C", 1.0) * n_rows),
                              elasticNetParam=p.get("l1_ratio", 0.0), weightCol=_weights(p))


def _tree_params(p: dict) -> dict:
    depth = p.get("max_depth", 5)
    subset = {"sqrt": "sqrt", "log2": "log2", None: "all"}
    return {"maxDepth": 30 if depth is None else int(depth),
            "minInstancesPerNode": int(p.get("min_samples_leaf", 1)),
            "seed": SEED, "labelCol": LABEL,
            "featureSubsetStrategy": subset.get(p.get("max_features"), "all")}


def decision_tree(**p) -> DecisionTreeClassifier:
    t = _tree_params(p)
    t.pop("featureSubsetStrategy")
    return DecisionTreeClassifier(impurity=p.get("criterion", "gini"), weightCol=_weights(p),
                                  **t)


def random_forest(**p) -> RandomForestClassifier:
    t = {**_tree_params(p), "featureSubsetStrategy": p.get("max_features") or "sqrt"}
    return RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)),
                                  bootstrap=p.get("bootstrap", True), weightCol=_weights(p),
                                  **t)


def gradient_boosting(**p) -> GBTClassifier:
    return GBTClassifier(maxIter=int(p.get("n_estimators", 100)),
                         stepSize=p.get("learning_rate", 0.1),
                         subsamplingRate=p.get("subsample", 1.0), **_tree_params(
                             {"max_depth": 3, **p}))


def boosted_champion(**p) -> GBTClassifier:
    """The production model on Spark's boosted trees; a positive row weighs
    ``scale_pos_weight`` through the ``w_champion`` column (``add_champion_weight``).

    Spark's trees have no place for ``reg_alpha`` and ``reg_lambda``; ``gamma`` bounds the gain
    of a split, ``colsample_bytree`` is drawn per node, and ``min_child_weight`` counts rows."""
    p = {**CHAMPION_PARAMS, **p}
    return GBTClassifier(
        labelCol=LABEL, seed=SEED, maxIter=int(p["n_estimators"]),
        stepSize=p["learning_rate"], maxDepth=int(p["max_depth"]),
        subsamplingRate=p["subsample"], featureSubsetStrategy=str(p["colsample_bytree"]),
        minInfoGain=p["gamma"], minInstancesPerNode=max(1, round(p["min_child_weight"])),
        weightCol="w_champion")


def add_champion_weight(df: DataFrame, scale: float = CHAMPION_PARAMS["scale_pos_weight"]
                        ) -> DataFrame:
    return df.withColumn("w_champion", F.when(F.col(LABEL) == 1, float(scale)).otherwise(1.0))


def kernel_svm(size: int = 256, max_iter: int = 50, **p) -> Pipeline:
    """RBF machine with probabilities: landmark features, linear machine, calibrated margin."""
    return Pipeline(stages=[
        NystroemMap(gamma=p.get("gamma", 0.05), size=size),
        PenaltyByRows(C=float(p.get("C", 1.0)), margin=True, maxIter=max_iter,
                      weightCol=_weights(p)),
        VectorSlicer(inputCol="svm_raw", outputCol="svm_margin", indices=[1]),
        LogisticRegression(featuresCol="svm_margin", labelCol=LABEL),
    ])


def mlp(**p) -> NetworkClassifier:
    """Feed-forward network. With a ``learning_rate`` it is fitted by gradient descent with that
    step, else by l-bfgs, which has none."""
    return NetworkClassifier(hidden=list(p.get("hidden_layers", [64, 32])),
                             maxIter=int(p.get("max_epochs", 100)),
                             stepSize=p.get("learning_rate", 0.03),
                             solver="gd" if "learning_rate" in p else "l-bfgs")


CLASSIFIERS = {
    "logreg": logreg,
    "DecisionTree": decision_tree,
    "RandomForest": random_forest,
    "GradientBoosting": gradient_boosting,
    "xgboost": boosted_champion,
    "SVC_rbf": kernel_svm,
    "mlp": mlp,
}


def model_pipeline(name: str, k_best="all", strict_reference: bool = False,
                   approx: bool = False, **params) -> Pipeline:
    """The whole chain from cleaned columns to scores for a classifier by name."""
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown model: {name}")
    return Pipeline(stages=[*feature_stages(k_best, strict_reference, approx),
                            CLASSIFIERS[name](**params)])


def dummy_most_frequent(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add the majority class as prediction and its 0/1 score."""
    counts = df.groupBy(label).count()
    mode = counts.agg(F.min_by(label, F.struct((-F.col("count")).alias("a"), label))).scalar()
    return df.withColumn("prediction", mode.cast("double")).withColumn(
        "y_proba", (F.col("prediction") == 1).cast("double"))


def dummy_stratified(df: DataFrame, key: str, label: str = LABEL, seed: int = SEED
                     ) -> DataFrame:
    """Predict 1 at random with the share of class 1, by a seeded hash of the key."""
    prior = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    return df.withColumn("_prior", prior).withColumn(
        "prediction", (hash_unit(seed, key) < F.col("_prior")).cast("double")).withColumn(
        "y_proba", F.col("prediction")).drop("_prior")


# --- evaluation --------------------------------------------------------------------------------

def scores_of(model, df: DataFrame, row_id: str = KEY_COL) -> DataFrame:
    out = model.transform(df)
    return out.select("fold", F.col(row_id).alias("row_id"),
                      F.col(LABEL).cast("int").alias("y_true"),
                      positive_probability(out).alias("y_proba"))


def _fit_folds(df: DataFrame, pipeline: Pipeline, folds, parallelism: int) -> list:
    """Models fitted without each listed fold (None: on every row), side by side from a few
    driver threads, as Spark's own cross-validator does."""
    def fit(k):
        return pipeline.fit(df if k is None else df.where(F.col("fold") != k))

    with ThreadPool(min(parallelism, len(folds))) as pool:
        return pool.map(fit, folds, chunksize=1)


def _score_folds(df: DataFrame, models: list, row_id: str) -> DataFrame:
    parts = [scores_of(m, df.where(F.col("fold") == k), row_id) for k, m in enumerate(models)]
    return reduce(DataFrame.unionByName, parts)


def oof_predictions(df: DataFrame, pipeline: Pipeline, n_folds: int = N_FOLDS,
                    parallelism: int = 4, row_id: str = KEY_COL) -> DataFrame:
    """Out-of-fold scores: fit on the other folds, score the fold, for every fold."""
    models = _fit_folds(df, pipeline, list(range(n_folds)), parallelism)
    return _score_folds(df, models, row_id)


def cross_validate(df: DataFrame, pipeline: Pipeline, n_folds: int = N_FOLDS,
                   threshold: float = 0.5, parallelism: int = 4, row_id: str = KEY_COL):
    """``(fold metrics, mean and deviation per metric, model fitted on everything)``."""
    *models, final = _fit_folds(df, pipeline, [*range(n_folds), None], parallelism)
    folds = compute_metrics(_score_folds(df, models, row_id), ["fold"], threshold)
    return folds, cv_summary(folds, METRICS), final


# The published search spaces.
SEARCH_SPACES = {
    "GradientBoosting": {
        "n_estimators": ("int", 100, 800), "learning_rate": ("log", 1e-3, 0.2),
        "max_depth": ("int", 2, 4), "subsample": ("float", 0.7, 1.0),
        "min_samples_split": ("int", 2, 30), "min_samples_leaf": ("int", 1, 10),
    },
    "RandomForest": {
        "n_estimators": ("int", 200, 800), "max_depth": [None, 6, 8, 12, 16],
        "min_samples_split": ("int", 5, 50), "min_samples_leaf": ("int", 2, 20),
        "max_features": ["sqrt", "log2"], "bootstrap": [True],
        "class_weight": [None, "balanced"],
    },
    "SVC_rbf": {
        "C": ("log", 1e-2, 1e2), "gamma": ("log", 1e-4, 1e-1),
        "class_weight": [None, "balanced"],
    },
    "DecisionTree": {
        "criterion": ["gini", "entropy"], "max_depth": [None, 2, 3, 4, 5, 8, 12, 16, 24],
        "min_samples_split": ("int", 2, 50), "min_samples_leaf": ("int", 1, 20),
        "max_features": ["sqrt", "log2", None], "class_weight": [None, "balanced"],
    },
    "logreg": {
        "C": ("log", 1e-3, 1e2), "l1_ratio": ("float", 0.0, 1.0),
        "class_weight": [None, "balanced"],
    },
    "xgboost": {
        "n_estimators": ("int", 200, 1500), "learning_rate": ("log", 1e-3, 0.2),
        "max_depth": ("int", 2, 8), "min_child_weight": ("log", 1e-1, 20.0),
        "subsample": ("float", 0.6, 1.0), "colsample_bytree": ("float", 0.6, 1.0),
        "reg_lambda": ("log", 1e-2, 50.0), "reg_alpha": ("log", 1e-3, 10.0),
        "gamma": ("log", 1e-4, 5.0), "scale_pos_weight": [1.0, 2.0, 3.0, 4.0, 6.0],
    },
}
K_CHOICES = [15, 20, 25, 30, "all"]


def sample_params(name: str, n_iter: int, seed: int = SEED, space: dict | None = None
                  ) -> list[dict]:
    """``n_iter`` seeded parameter sets; ``k_best`` is always among them."""
    rng = random.Random(f"{seed}:{name}")
    space = dict(SEARCH_SPACES.get(name, {}) if space is None else space)
    space.setdefault("k_best", K_CHOICES if space else [15, "all"])

    def draw(spec):
        if isinstance(spec, list):
            return rng.choice(spec)
        kind, lo, hi = spec
        if kind == "int":
            return rng.randint(lo, hi)
        if kind == "float":
            return rng.uniform(lo, hi)
        return float(np.exp(rng.uniform(np.log(lo), np.log(hi))))

    return [{key: draw(spec) for key, spec in space.items()} for _ in range(n_iter)]


def _fold_tables(df: DataFrame, n_folds: int, ks, parallelism: int) -> dict:
    """Per fold: the encoded rows, learned on the other folds and written once, with one
    selector per wanted number of features. Every candidate reuses them."""
    def one(fold: int):
        stages = Pipeline(stages=feature_stages(approx=True)[:-1])
        train = df.where(F.col("fold") != fold)
        keep = [c for c in df.columns if c in ("fold", LABEL) or c.startswith("w_")]
        encoded = materialize(stages.fit(train).transform(df).select(*keep, "varying"), "fold")
        picks = {k: KBestSelector(k=0 if k == "all" else int(k)).fit(
            encoded.where(F.col("fold") != fold)) for k in ks}
        return fold, (encoded, picks)

    with ThreadPool(min(parallelism, n_folds)) as pool:
        return dict(pool.map(one, range(n_folds)))


def _fold_score(model, test: DataFrame, metric: str) -> float:
    counts = confusion_counts(model.transform(test), (), 0.5, LABEL, "prediction")
    return float(counts.select(rates()[metric]).first()[0])


def _candidates(df: DataFrame, name: str, settings: list[dict], n_folds: int,
                parallelism: int, metric: str, fixed: dict):
    """Cross-validate the settings; ``(results, best params, best model)``."""
    if metric not in ("accuracy", "precision", "recall", "f1"):
        raise ValueError(f"unknown search metric: {metric}")
    settings = [{**s, **fixed} for s in settings]
    if name == "xgboost":
        df = add_champion_weight(df, 1.0)

    def split(setting):
        params = {k: v for k, v in setting.items() if k != "k_best"}
        return setting.get("k_best", "all"), params

    tables = _fold_tables(df, n_folds, {split(s)[0] for s in settings}, parallelism)

    def one(task):
        i, fold = task
        k, params = split(settings[i])
        encoded, picks = tables[fold]
        rows = picks[k].transform(encoded)
        if name == "xgboost":
            rows = add_champion_weight(rows, params.get("scale_pos_weight", 6.0))
        model = CLASSIFIERS[name](**params).fit(rows.where(F.col("fold") != fold))
        return i, _fold_score(model, rows.where(F.col("fold") == fold), metric)

    with ThreadPool(parallelism) as pool:
        scores = pool.map(one, list(itertools.product(range(len(settings)), range(n_folds))))
    by_setting = [[v for i, v in scores if i == n] for n in range(len(settings))]
    rows = [(n, str(settings[n]), float(np.mean(v)),
             float(np.std(v, ddof=1)) if len(v) > 1 else 0.0) for n, v in enumerate(by_setting)]
    best = max(range(len(rows)), key=lambda n: (rows[n][2], -n))
    results = df.sparkSession.createDataFrame(
        rows, f"candidate int, params string, mean_{metric} double, std_{metric} double")
    k, params = split(settings[best])
    data = (add_champion_weight(df, params.get("scale_pos_weight", 6.0))
            if name == "xgboost" else df)
    return results, settings[best], model_pipeline(name, k, approx=True, **params).fit(data)


def random_search(df: DataFrame, name: str, n_iter: int, n_folds: int = N_FOLDS,
                  seed: int = SEED, metric: str = PRIMARY_METRIC, parallelism: int = 4,
                  **fixed):
    """Seeded random search; the best setting is refitted on all rows."""
    return _candidates(df, name, sample_params(name, n_iter, seed), n_folds, parallelism,
                       metric, fixed)


def grid_cv(df: DataFrame, name: str, grid, n_folds: int = N_FOLDS,
            metric: str = PRIMARY_METRIC, parallelism: int = 4, **fixed):
    """Cross-validate a fixed list of settings, or the product of a dict of lists."""
    if isinstance(grid, dict):
        grid = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return _candidates(df, name, list(grid), n_folds, parallelism, metric, fixed)


def refit_final(df: DataFrame, k_best=CHAMPION_K_BEST, key: str = KEY_COL, seed: int = SEED,
                **params) -> tuple[PipelineModel, int]:
    """Pick the number of trees on a stratified 10 % part, then fit on every row.

    Features are learned on the training part first and on everything for the final fit.
    """
    marked = add_champion_weight(stratified_holdout(df, key, LABEL, seed=seed),
                                 {**CHAMPION_PARAMS, **params}["scale_pos_weight"])
    stages = Pipeline(stages=feature_stages(k_best))
    train = marked.where(F.col("is_validation") == 0)
    encoded = stages.fit(train).transform(marked).withColumn(
        "is_validation", F.col("is_validation") == 1)
    gbt = boosted_champion(**params).setValidationIndicatorCol("is_validation")
    trees = max(1, gbt.fit(encoded).getNumTrees)
    final = Pipeline(stages=[*feature_stages(k_best),
                             boosted_champion(**{**params, "n_estimators": trees})])
    return final.fit(marked), trees
