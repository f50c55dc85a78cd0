"""Near-duplicate documents by b-bit MinHash with exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER, mix64, slices, table, texts_of
from .components import components

SHINGLE = 5
#: Documents are linked from this similarity in percent on.
PERCENT = 85
#: Bands of ROWS minima each: a pair of similarity 0.85 shares no band with probability MISS at most. Other
#: bounds have as many bands as that takes (``bands_of``).
BANDS, ROWS, MISS = 28, 6, 2e-6
#: Bits kept of each minimum.
BITS = 2
#: A pair is compared exactly unless its estimate lies this many deviations below the bound.
DEVIATIONS = 5
#: Buckets of at most SMALL open classes are compared pair by pair, larger ones in blocks of BLOCK
#: by a sharper sketch of SHARP minima with one bit each.
SMALL, BLOCK, SHARP = 64, 512, 2048
#: Most ids of one broadcast; more are joined by shuffle.
BROADCAST_IDS = 2_000_000

_U = np.uint64
_LOWER = bytes(LOWER.get(b, b) for b in range(256))
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_STEP, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_MUL = (_rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1))
_ADD = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_SHARP_MUL = _rng.integers(0, 2**32, SHARP, dtype=np.uint32) | np.uint32(1)
_SHARP_ADD = _rng.integers(0, 2**32, SHARP, dtype=np.uint32)
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(1 << 16, 1 << n.bit_length())
        for name, base in (("up", _STEP), ("down", _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words (all words, if fewer)."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    flat = np.frombuffer(b" ".join(words), np.uint8)
    up, down = _power_table(len(flat) + 1)
    sums = np.empty(len(flat) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[flat] * up[:len(flat)], out=sums[1:])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(size, len(words))
    s, e = starts[:len(words) - k + 1], ends[k - 1:]
    return np.unique(mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)))


def bands_of(percent: int) -> int:
    """Bands that a pair of just this similarity misses with probability MISS at most."""
    return 1 if percent >= 100 else ceil(log(MISS) / log1p(-(percent / 100) ** ROWS))


def _words(bands: int) -> int:
    """Words of 64 bits that hold the bits of all minima."""
    return -(-bands * ROWS * BITS // 64)


@lru_cache
def _functions(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of the minima; those beyond BANDS bands do not change the first."""
    more = np.random.default_rng(20240502).integers(0, 2**32, (max(0, bands - BANDS) * ROWS, 2), dtype=np.uint32)
    mul, add = np.concatenate([_MUL, more[:, 0] | np.uint32(1)]), np.concatenate([_ADD, more[:, 1]])
    return mul[:bands * ROWS], add[:bands * ROWS]


def signature(shingles: np.ndarray, bands: int = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, low bits of all minima packed into words of 64 bits)."""
    low = (shingles >> _U(32)).astype(np.uint32)
    mul, add = _functions(bands)
    minima = np.full(bands * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 1024):
        np.minimum(minima, (low[i:i + 1024, None] * mul + add).min(0), out=minima)
    keys = np.arange(bands, dtype=np.uint64)
    for column in minima.reshape(bands, ROWS).T:
        keys = mix64(keys * _U(_STEP) + column)
    bits = ((minima[:, None] >> np.arange(BITS, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    packed = np.zeros(_words(bands) * 64, np.uint8)
    packed[:bits.size] = bits.ravel()
    return keys.view(np.int64), np.packbits(packed).view(np.int64)


def _mismatches(a: Column, b: Column) -> Column:
    """Fields of BITS bits in which two packed words differ (BITS is 2)."""
    x = a.bitwiseXOR(b)
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
    return F.bit_count(x)


def estimate(a: Column, b: Column, bands: int = BANDS) -> Column:
    """Similarity from the share of equal fields, corrected for equality by chance."""
    unequal = sum((_mismatches(a[i], b[i]) for i in range(_words(bands))), F.lit(0))
    return 1 - (unequal / F.lit(bands * ROWS)) / F.lit(1 - 0.5**BITS)


def _least_estimate(percent: int, bits: int = BITS, minima: int | None = None) -> float:
    minima = minima or bands_of(percent) * ROWS
    chance = 0.5**bits
    p = chance + (1 - chance) * percent / 100
    return percent / 100 - DEVIATIONS * (p * (1 - p) / minima) ** 0.5 / (1 - chance)


def sharp_sketch(shingles: np.ndarray) -> np.ndarray:
    """Lowest bits of SHARP minima, packed."""
    low = (shingles >> _U(32)).astype(np.uint32)
    minima = np.full(SHARP, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 64):
        np.minimum(minima, (low[i:i + 64, None] * _SHARP_MUL + _SHARP_ADD).min(0), out=minima)
    # The low bit of a product depends on low bits only, so a middle bit is taken.
    return np.packbits(((minima >> np.uint32(9)) & np.uint32(1)).astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, cls, keys, bits) per row; ``cls`` is a 128-bit hash of the set."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, cls, keys, bits = [], [], [], []
            for t in texts_of(batch.column(1)):
                s = shingle_set(t)
                k, b = signature(s, bands) if len(s) else (None, None)
                sizes.append(len(s))
                cls.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(k)
                bits.append(b)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "cls", "keys", "bits"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        sketch, "doc_id long, n_shingles long, cls binary, keys array<long>, bits array<long>")


def _sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """(cls, shingles) of the wanted classes (cls, doc_id), made from whole texts again."""
    def to_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t) for t in texts_of(batch.column(0))]
            yield pa.record_batch(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["cls", "shingles"])

    ids = materialize(wanted.select("doc_id").distinct(), "ids")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    rows = docs.select(F.col(doc_id).cast("long").alias("own"), F.col(text).alias("text"))
    ids = F.broadcast(ids) if few else ids
    rows = rows.join(ids, rows["own"].eqNullSafe(ids["doc_id"]), "left_semi").select("text")
    made = rows.mapInArrow(to_set, "cls binary, shingles array<long>")
    made = made.join(wanted.select("cls").distinct(), "cls", "left_semi")
    return materialize(made.groupBy("cls").agg(F.first("shingles").alias("shingles")), "sets")


def _confirmed(docs: DataFrame, doc_id: str, text: str, pairs: DataFrame, classes: DataFrame,
               percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = _sets(docs, doc_id, text, classes.join(nodes, "cls").select("cls", "doc_id"))
    a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return materialize(
        pairs.join(a, "a").join(b, "b").where(100 * both >= percent * union).select("a", "b"),
        "links")


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that size and estimate do not rule out."""
    a = classes.select(F.col("cls").alias("a"), F.col("bits").alias("ba"), F.col("n_shingles").alias("na"))
    b = classes.select(F.col("cls").alias("b"), F.col("bits").alias("bb"), F.col("n_shingles").alias("nb"))
    kept = pairs.join(a, "a").join(b, "b").where(
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        & (estimate(F.col("ba"), F.col("bb"), bands_of(percent)) >= _least_estimate(percent)))
    return materialize(kept.select("a", "b"), "pairs")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _block_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in large buckets (key, cls, comp, n_shingles, keys, m).

    Large groups hold many pairs just below the bound, so their classes get a sharper sketch. A
    bucket's members are dealt to blocks of about BLOCK rows, and each pair of blocks is one
    group: tasks stay small and only pairs that pass the estimate leave them. A pair that meets in several
    bands leaves the first of them only; where that bucket is small, it is compared there.
    """
    least = _least_estimate(percent, 1, SHARP)
    kind = "a binary, b binary"

    def sharpen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [sharp_sketch(x.values.to_numpy().view(np.uint64)) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(made, pa.list_(pa.int64()))], ["cls", "sharp"])

    def compare(group: pa.Table) -> pa.Table:
        bits = np.array(group.column("sharp").to_pylist(), dtype=np.int64).view(np.uint64)
        size = np.array(group.column("n_shingles").to_pylist(), dtype=np.int64)
        comp = np.array(group.column("comp").to_pylist(), dtype=object)
        block = np.array(group.column("block").to_pylist())
        keys = np.array(group.column("keys").to_pylist(), dtype=np.int64)
        here = group.column("key")[0].as_py()
        cls = group.column("cls").to_pylist()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        rows, cols = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b = [], []
        for r in rows:
            c = cols[cols > r] if i == j else cols
            est = 1 - 2 * np.bitwise_count(bits[c] ^ bits[r]).sum(1) / SHARP
            lo, hi = np.minimum(size[c], size[r]), np.maximum(size[c], size[r])
            c = c[(est >= least) & (100 * lo >= percent * hi) & (comp[c] != comp[r])]
            for k in c[keys[r][(keys[c] == keys[r]).argmax(1)] == here]:
                a.append(min(cls[r], cls[k]))
                b.append(max(cls[r], cls[k]))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    n = F.ceil(F.col("m") / BLOCK).cast("int")
    sharp = sets.select("cls", "shingles").mapInArrow(sharpen, "cls binary, sharp array<long>")
    members = members.drop("bits").join(materialize(sharp, "sharp"), "cls")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("cls"), n).cast("int"))
    other = F.explode(F.sequence(F.lit(0), n - 1))
    dealt = dealt.withColumn("other", other).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    return dealt.groupBy("key", "i", "j").applyInArrow(compare, kind)


def _bucket_pairs(docs: DataFrame, doc_id: str, text: str, buckets: DataFrame, classes: DataFrame,
                  roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket; buckets within one component drop out."""
    rows = buckets.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    rows = rows.select("key", "cls", F.coalesce("root", "cls").alias("comp"))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                    F.count("*").alias("m")).where("lo <> hi").select("key", "m")
    rows = rows.join(mixed, "key").join(classes.select("cls", "bits", "n_shingles"), "cls")
    rows = materialize(rows, "mixed")
    small = rows.where(F.col("m") <= SMALL)
    x, y = small.alias("x"), small.alias("y")
    near = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cls") < F.col("y.cls"))
                  & (F.col("x.comp") != F.col("y.comp")))
    near = near.where(
        (100 * F.least("x.n_shingles", "y.n_shingles") >= percent * F.greatest("x.n_shingles", "y.n_shingles"))
        & (estimate(F.col("x.bits"), F.col("y.bits"), bands_of(percent)) >= _least_estimate(percent)))
    near = near.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    large = rows.where(F.col("m") > SMALL)
    if large.isEmpty():
        return near
    wanted = classes.select("cls", "doc_id").join(large.select("cls").distinct(), "cls")
    large = large.join(classes.select("cls", "keys"), "cls")
    return near.union(_block_pairs(large, _sets(docs, doc_id, text, wanted), percent))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Rows with equal shingle sets are one class. Classes meet in band buckets of MinHash minima.
    First each bucket is compared with its most central class only (the one whose buckets are
    largest), then buckets that still hold several components are compared across components, so
    no bucket's pairs are all made and no link between components is skipped. Low bits of the
    minima rule pairs out by an estimate; what is left is decided on full shingle sets.

    Words are runs without ASCII white space, A-Z lower-cased; a set has the distinct runs of five
    words, or all words where there are fewer. Null and empty texts have no set and link with
    nothing. ``component_id`` is the least id of all rows reached, ``kept`` marks its row; null
    ids are ignored for the least id, and rows of a component that has only null ids keep null and
    are all kept. Repeated rows are rows of their own. Other columns are not read.
    """
    base = materialize(sketches(docs, doc_id, text, bands_of(percent)), "sketches")
    some = base.where("cls is not null")
    classes = materialize(some.groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("keys").alias("keys"), F.first("bits").alias("bits")), "classes")
    rows = classes.select("cls", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    buckets = materialize(rows.join(shared, "key"), "buckets")
    central = buckets.groupBy("cls").agg(F.sum("m").alias("weight"))
    hubs = buckets.join(central, "cls").groupBy("key").agg(
        F.max_by("cls", F.struct("weight", "cls")).alias("hub"))
    stars = buckets.join(hubs, "key").where("cls <> hub").select(*_ordered("cls", "hub"))
    stars = materialize(stars.distinct(), "stars")
    links = _confirmed(docs, doc_id, text, _promising(stars, classes, percent), classes, percent)
    roots = components(links)
    rest = _bucket_pairs(docs, doc_id, text, buckets.select("key", "cls"), classes, roots, percent).distinct()
    rest = materialize(rest.join(stars, ["a", "b"], "left_anti"), "rest")
    links = links.union(_confirmed(docs, doc_id, text, rest, classes, percent))
    roots = components(links).withColumnRenamed("node", "cls")
    owned = classes.select("cls", "doc_id").join(roots, "cls", "left").select(
        "cls", F.coalesce("root", "cls").alias("root"), "doc_id")
    least = owned.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = owned.join(least, "root").select("cls", "component_id")
    out = base.select("doc_id", "n_shingles", "cls").join(known, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
