"""Removal of repeated passages by prefix-free parsing of the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import ROWS_AT_ONCE, each_text, mix64, slices, table, texts_of

#: Bytes of a repeat.
LENGTH = 400
#: Bytes of a trigger.
GRAM = 32
#: Window starts of a long text that are parsed at once.
SEGMENT = 1 << 22
_POSITION = np.uint64((1 << 24) - 1)
#: Most ranges and rows of one broadcast; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Rows that a task passes on at once.
PASSED_ROWS = 20_000

_U = np.uint64
_rng = np.random.default_rng(20240502)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
SPANS = "array<struct<start: long, stop: long>>"


def _rolling(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` (a power of two) bytes at each position."""
    h, n = _BYTE[data], 1
    while n < gram:
        h = h[:-n] * _U(pow(_STEP, n, 2**64)) + h[n:]
        n *= 2
    return mix64(h)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    n = 1
    m = keys
    while 2 * n <= width:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    return m if n == width else np.minimum(m[:len(keys) - width + 1], m[width - n:])


def phrases(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(first start, end of starts, trigger) for each phrase of the parse.

    The trigger of a window of ``length`` bytes is the leftmost gram of least rolling hash in it,
    so equal windows have equal triggers at the same place. A phrase is the run of window starts
    that share a trigger; its text, from the first start to the end of its last window, fixes all of it.
    """
    width = length - GRAM + 1
    for base in range(0, len(data) - length + 1, SEGMENT):
        part = np.frombuffer(data, np.uint8)[base:base + SEGMENT + length - 1]
        h = _rolling(part, GRAM)
        keys = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
        at = (_least(keys, width) & _POSITION).astype(np.int64)
        cuts = np.flatnonzero(np.diff(at)) + 1
        starts = np.concatenate([[0], cuts])
        stops = np.concatenate([cuts, [len(at)]])
        yield from zip((starts + base).tolist(), (stops + base).tolist(), (at[starts] + base).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _parse(docs: DataFrame, length: int) -> DataFrame:
    """The parse: one row per phrase occurrence, with fingerprints of its text (``phrase``), of
    its trigger, and of the trigger with half a window before (``back``) or after it (``ahead``)."""
    half = -(-(length - GRAM) // 2)

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = ["key", "start", "stop", "at", "phrase", "trigger", "back", "ahead"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h64 = xxhash.xxh3_64_intdigest
        rows: list[tuple] = []

        def passed() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(names)
            return pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds)], names)

        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), each_text(batch.column(1))):
                data = text.encode("utf-8", "surrogatepass")
                for a, b, p in phrases(data, length):
                    rows.append((
                        k, a, b, p, xxhash.xxh3_128_digest(data[a:b - 1 + length]), _signed(h64(data[p:p + GRAM])),
                        _signed(h64(data[p - half:p + GRAM])) if p >= half else None,
                        _signed(h64(data[p:p + GRAM + half])) if p + GRAM + half <= len(data) else None))
                    if len(rows) >= PASSED_ROWS:
                        yield passed()
                        rows.clear()
        yield passed()

    return docs.select("key", "text").mapInArrow(
        parse, "key long, start long, stop long, at long, phrase binary, trigger long, back long, ahead long")


def _with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Documents with their list of ranges; a list of few rows is broadcast, else both are shuffled."""
    size = ranges.agg(F.sum(F.size("ranges") + 1)).first()[0] or 0
    return docs.join(F.broadcast(ranges) if size <= BROADCAST_ROWS else ranges, "key")


def _halves(digests: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


def _windows(docs: DataFrame, ranges: DataFrame, length: int) -> DataFrame:
    """(window fingerprint, key, start) for every start in the ranges of a document."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        digests, places = [], []

        def passed() -> pa.RecordBatch:
            key, start, own = (np.concatenate(x) for x in zip(*places))
            return pa.record_batch([*_halves(digests), pa.array(key), pa.array(start), pa.array(own)],
                                   ["w1", "w2", "key", "start", "own"])

        for batch in slices(batches):
            for k, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                data = (text or "").encode("utf-8", "surrogatepass")
                for r in spans:
                    for at in range(r["start"], r["stop"], PASSED_ROWS):
                        stop = min(r["stop"], at + PASSED_ROWS)
                        digests += [digest(data[s:s + length]) for s in range(at, stop)]
                        places.append((np.full(stop - at, k, np.int64), np.arange(at, stop, dtype=np.int32),
                                       np.full(stop - at, r["own"], bool)))
                        if len(digests) >= PASSED_ROWS:
                            yield passed()
                            digests, places = [], []
        if digests:
            yield passed()

    rows = _with_ranges(docs, ranges).select("key", "text", "ranges")
    return rows.mapInArrow(hashed, "w1 long, w2 long, key long, start int, own boolean")


def _repeated_starts(docs: DataFrame, length: int) -> DataFrame:
    """(key, start, stop): ranges of starts whose window also starts elsewhere.

    The dictionary holds each distinct phrase once. Phrases that occur twice repeat in whole. A
    window of any other phrase can only repeat in another phrase with the same trigger and the
    same half window before or after it; only those windows are brought together one by one.
    """
    parse = materialize(_parse(docs, length), "parse")
    often = parse.groupBy("trigger").agg(F.count("*").alias("n")).where("n > 1").select("trigger")
    parse = materialize(parse.join(often, "trigger"), "parse")
    dictionary = materialize(parse.groupBy("phrase").agg(
        F.count("*").alias("n"), F.first("back").alias("back"), F.first("ahead").alias("ahead"),
        F.min(F.struct("key", "start", "stop", "at")).alias("one")), "dictionary")
    whole = parse.join(dictionary.where("n > 1").select("phrase"), "phrase", "left_semi")
    whole = whole.select("key", "start", "stop")

    def shared(side: str) -> DataFrame:
        met = dictionary.where(F.col(side).isNotNull()).groupBy(side).agg(F.count("*").alias("m"))
        return met.where("m > 1").select(side, F.lit(True).alias(f"{side}_met"))

    half = -(-(length - GRAM) // 2)
    open_ = dictionary.join(shared("back"), "back", "left").join(shared("ahead"), "ahead", "left")
    open_ = open_.where("back_met or ahead_met")
    first = F.when(F.col("back_met"), F.col("one.start")).otherwise(
        F.greatest("one.start", F.col("one.at") - half))
    last = F.when(F.col("ahead_met"), F.col("one.stop")).otherwise(
        F.least("one.stop", F.col("one.at") - half + 1))
    ranges = open_.select(
        F.col("one.key").alias("key"), first.alias("start"), last.alias("stop"),
        (F.col("n") == 1).alias("own")).where("start < stop")
    ranges = materialize(ranges.groupBy("key").agg(
        F.collect_list(F.struct("start", "stop", "own")).alias("ranges")), "ranges")
    # Windows are hashed twice, which is cheaper than a table of them all. Those that meet are written first, so that
    # one shuffle of windows is gone before the next.
    windows = _windows(docs, ranges, length)
    met = materialize(windows.groupBy("w1", "w2").agg(F.count("*").alias("m")).where("m > 1").select("w1", "w2"), "met")
    few = met.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    parts = windows.where("own").join(F.broadcast(met) if few else met, ["w1", "w2"], "left_semi")
    return whole.union(parts.select("key", "start", (F.col("start") + 1).alias("stop")))


def _spans(ranges: pa.Array, length: int) -> pa.Array:
    """Byte spans of each list of ranges of starts, in order; spans that overlap or touch are one."""
    sizes = ranges.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = ranges.flatten()
    start, stop = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    row = np.repeat(np.arange(len(ranges)), sizes)
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order] - 1 + length
    # Each list lies in a stretch of its own, so one running maximum serves all.
    apart = row * (stop.max(initial=0) + 1)
    reach = np.maximum.accumulate(stop + apart)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] + apart[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[:len(first)] - 1
    ends = np.append(0, np.cumsum(np.bincount(row[first], minlength=len(ranges)))).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(reach[last] - apart[last])], ["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(ends), spans)


def _merger(length: int):
    """Function that turns ranges of repeated starts into the byte spans to remove."""
    @F.arrow_udf(SPANS)
    def merge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ranges in batches:
            yield _spans(ranges, length)

    return merge


def _cutter():
    """Function of (text, spans) that gives the remaining bytes."""
    @F.arrow_udf("binary")
    def cut(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            # Some rows at a time, so that no batch is held twice over.
            for i in range(0, len(texts), ROWS_AT_ONCE):
                rows = []
                for text, own in zip(texts_of(texts.slice(i, ROWS_AT_ONCE)), spans.slice(i, ROWS_AT_ONCE).to_pylist()):
                    data = text.encode("utf-8", "surrogatepass")
                    edges = [0, *(x for s in own for x in (s["start"], s["stop"])), len(data)]
                    rows.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.array(rows, pa.binary())

    return cut


def cut_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Add ``spans`` (removed byte ranges) and ``kept`` (remaining bytes) to each document.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else in the input,
    the same text included; strings never cross texts. ``length`` is at least 2 * GRAM.

    The corpus is parsed into phrases at rolling-hash triggers. Equal windows lie at the same
    place of phrases with the same trigger, so the order of suffixes, which is needed only to
    bring equal beginnings of ``length`` bytes together, follows from the dictionary of distinct
    phrases and the parse: 128-bit fingerprints of bounded phrases stand for ranks. Copies
    collapse to one dictionary entry before anything is compared.

    Null and empty texts lose nothing. Every row counts, so repeated rows repeat each other.
    Columns named like the added ones are replaced, others pass through.
    """
    keyed = docs.withColumn("key_", F.xxhash64(*docs.columns))
    bare = keyed.select(F.col("key_").alias("key"), F.col(text).alias("text"))
    found = _repeated_starts(bare, length).groupBy("key").agg(
        F.collect_list(F.struct("start", "stop")).alias("starts"))
    found = found.select(F.col("key").alias("key_"), _merger(length)("starts").alias("spans_"))
    found = materialize(found, "spans")
    size = found.agg(F.sum(F.size("spans_") + 1)).first()[0] or 0
    rows = keyed.join(F.broadcast(found) if size <= BROADCAST_ROWS else found, "key_", "left")
    rows = rows.withColumn("spans", F.coalesce("spans_", F.array().cast(SPANS)))
    return rows.withColumn("kept", _cutter()(F.col(text), F.col("spans"))).drop("key_", "spans_")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # A cut may fall inside a character; its bytes then become the replacement character here.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
