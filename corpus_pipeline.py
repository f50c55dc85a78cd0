"""From raw documents to piece ids: the stages of a training-data pipeline, in order.

Every stage works on all rows that the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepline.llm.common import table
from keepline.llm.decontaminate import benchmark_hits
from keepline.llm.near_dedup import near_duplicates
from keepline.llm.pieces import encode
from keepline.llm.private_data import fit_spans, private_spans, redact
from keepline.llm.quality import fit_quality, score_quality
from keepline.session import FEW_ROWS, materialize, setting

#: The stage links documents from this similarity in percent on; op5 has its own bound.
NEAR_PERCENT = 80
#: The lattice and word joins have no SQL counterpart, nor have fitted models.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    scorer = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, scorer).where("predicted = 1").select(*docs.columns)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; of a row that is there twice, one."""
    kept = near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select(F.struct("doc_id").alias("key_")).distinct()
    rows = docs.withColumn("key_", F.struct("doc_id")).join(kept, "key_", "left_semi")
    rows = rows.withColumn("text_", F.xxhash64("text")).dropDuplicates(["key_", "text_"])
    return rows.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*docs.columns)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    found = private_spans(docs, fit_spans(docs))
    found = found.withColumn("text", redact(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the piece ids of their texts, and the texts that the ids decode to."""
    import public_tokenizers

    out = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), back="decoded")
    return out.withColumn("n_pieces", F.size("ids").cast("long"))


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with its result written at once, while texts go to Python a few rows at a time.

    Workers live from stage to stage and keep what their largest batches took.
    """
    @wraps(stage)
    def written(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with setting(spark, *FEW_ROWS):
            return materialize(stage(spark, docs, sf_dir), stage.__name__)

    return written


STAGES = [
    ("quality", in_small_batches(keep_good)),
    ("near_duplicates", in_small_batches(keep_first_copies)),
    ("decontamination", in_small_batches(drop_leaks)),
    ("private_data", hide_private),
    ("pieces", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
