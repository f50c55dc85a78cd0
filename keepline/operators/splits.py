"""Seeded stratified splits and class balance.

Ranks follow the md5 of ``seed:id``, so a split is the same on every run and engine. Rows
are ranked in slices of the hash prefix: a class with most of the rows is spread over up to
4096 tasks.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import N_FOLDS, SEED, TEST_SIZE
from ..functions.expressions import hash_unit, ratio, seeded_hash
from ..functions.ordered import running_sums


def _ranked(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Row number (``cum__one``) and size (``total__one``) within the class."""
    hashed = df.withColumn("_order", F.struct(seeded_hash(seed, key).alias("h"),
                                              F.col(key).alias("id"))).withColumn(
        "_one", F.lit(1).cast("long"))
    return running_sums(hashed, [label], "_order", ["_one"],
                        bucket=F.substring("_order.h", 1, 3))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = N_FOLDS,
                     seed: int = SEED, exact: bool = True) -> DataFrame:
    """Add ``fold``: shuffled folds with equal class shares.

    ``exact=False`` takes the fold from the hash itself: no shuffle, shares equal only in
    expectation.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    if not exact:
        return df.withColumn("fold", F.floor(hash_unit(seed, key) * k).cast("int"))
    return _ranked(df, key, label, seed).select(
        *df.columns, ((F.col("cum__one") - 1) % k).cast("int").alias("fold"))


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = TEST_SIZE,
                     seed: int = SEED, flag: str = "is_test") -> DataFrame:
    """Add a 0/1 column that marks ``test_size`` of every class."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie in (0, 1)")
    r = _ranked(df, key, label, seed)
    cut = F.round(F.col("total__one") * test_size)
    return r.select(*df.columns, (F.col("cum__one") <= cut).cast("int").alias(flag))


def stratified_holdout(df: DataFrame, key: str, label: str, test_size: float = 0.1,
                       seed: int = SEED) -> DataFrame:
    """Add ``is_validation`` for one stratified validation part."""
    return stratified_split(df, key, label, test_size, seed, flag="is_validation")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``class, n, ratio`` with the ratio rounded to four decimals; NULL is a class."""
    counts = df.groupBy(F.col(label).cast("string").alias("class")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.withColumn(
        "ratio", F.round(ratio("n", F.sum("n").over(W.partitionBy(F.lit(0)))), 4))


def imbalance_ratio(df: DataFrame, label: str, limit: float = 0.5) -> DataFrame:
    """Smallest over largest class, and whether that is below ``limit``."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count()
    r = ratio(F.min("count"), F.max("count"))
    return counts.agg(r.alias("ratio"), (r < limit).cast("int").alias("imbalanced"))


def class_weights(df: DataFrame, label: str, scale_pos_weight: float | None = None
                  ) -> DataFrame:
    """One row with class counts and the weight of a positive row."""
    y = F.col(label)
    n_pos, n_neg = F.count_if(y == 1), F.count_if(y == 0)
    w = (F.lit(float(scale_pos_weight)) if scale_pos_weight is not None
         else n_neg / F.greatest(n_pos, F.lit(1)))
    return df.agg(n_pos.alias("n_pos"), n_neg.alias("n_neg"), w.alias("pos_weight"))


def add_class_weight(df: DataFrame, label: str, scale_pos_weight: float | None = None,
                     name: str = "weight") -> DataFrame:
    """Add a weight column for estimators with ``weightCol``."""
    if scale_pos_weight is not None:
        w = F.lit(float(scale_pos_weight))
    else:
        w = class_weights(df, label).select("pos_weight").scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))
