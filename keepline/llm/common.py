"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z and nothing else, as the operators on words ask for.
LOWER = {c: c + 32 for c in range(65, 91)}
#: Rows of a batch that are Python objects at once.
ROWS_AT_ONCE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings of a column, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def each_text(column: pa.Array) -> Iterator[str]:
    """The strings of ``texts_of`` one after the other, few of them held at once."""
    for at in range(0, len(column), ROWS_AT_ONCE):
        yield from texts_of(column.slice(at, ROWS_AT_ONCE))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows, at most so many at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_batches(texts: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Consecutive runs of texts of about ``limit`` characters; a longer text stands alone."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > limit:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a public finalizer; the two factors are fixed values)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
