"""Nearest neighbours by inner product with multiprobe p-stable hashing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import mix64, table

TABLES = 3
#: Width of a slot in units of the largest norm, and bits that one function then tells apart.
WIDTH, BITS = 1.5, 1.86
#: Vectors of an average bucket.
BUCKET = 24
#: Queries on which the number of probes is fitted, the recall to reach there, most probes.
FIT_QUERIES, FIT_RECALL, MOST_PROBES = 64, 0.95, 600
#: Vectors of the sample that gives each query its pruning bound.
BOUND_SAMPLE = 4096
#: Index rows and query rows that one task holds at once.
TASK_ROWS = 8000


@dataclass
class Index:
    """Hash functions of all tables and the probing order; sizes depend only on parameters."""

    directions: np.ndarray  # tables, functions, dimensions + 1
    offsets: np.ndarray
    width: float
    longest: float
    probes: np.ndarray  # probes, 2 * functions: which of the sorted boundaries are crossed

    def slots(self, x: np.ndarray) -> np.ndarray:
        return np.einsum("tkd,nd->tnk", self.directions, x) / self.width + self.offsets[:, None, :]

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Rows of equal length, so that nearness in space follows the inner product."""
        rest = np.maximum(self.longest**2 - (x * x).sum(1), 0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], 1)

    def aim(self, q: np.ndarray) -> np.ndarray:
        q = q * (self.longest / np.linalg.norm(q, axis=1))[:, None]
        return np.concatenate([q, np.zeros((len(q), 1))], 1)


def probing_order(functions: int, most: int) -> np.ndarray:
    """Sets of slot boundaries to cross, likeliest first, as rows of 0/1 over sorted boundaries.

    A query's 2K distances to slot boundaries, sorted, have known expected squares; a set's score
    is their sum, and no set crosses both boundaries of one function.
    """
    k = functions
    j = np.arange(1, 2 * k + 1)
    low = j * (j + 1) / (4 * (k + 1) * (k + 2))
    up = 1 - (2 * k + 1 - j) / (k + 1) + (2 * k + 1 - j) * (2 * k + 2 - j) / (4 * (k + 1) * (k + 2))
    cost = np.where(j <= k, low, up)
    sets, heap = [()], [(cost[0], (0,))]
    while heap and len(sets) < most:
        score, now = heapq.heappop(heap)
        if not any(2 * k - 1 - i in now for i in now):
            sets.append(now)
        last = now[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], now[:-1] + (last + 1,)))
            heapq.heappush(heap, (score + cost[last + 1], now + (last + 1,)))
    out = np.zeros((len(sets), 2 * k), np.int64)
    for row, chosen in zip(out, sets):
        row[list(chosen)] = 1
    return out


def bucket_ids(codes: np.ndarray) -> np.ndarray:
    """64-bit ids of slot codes (tables, ..., functions)."""
    h = np.broadcast_to(
        np.arange(len(codes), dtype=np.uint64).reshape((-1,) + (1,) * (codes.ndim - 2)),
        codes.shape[:-1])
    for i in range(codes.shape[-1]):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + codes[..., i].astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def probe_buckets(index: Index, q: np.ndarray, probes: int) -> np.ndarray:
    """Bucket ids (tables, queries, probes) that each query visits, in order."""
    f = index.slots(index.aim(q))
    base = np.floor(f).astype(np.int64)
    r, k = f - base, f.shape[-1]
    order = np.argsort(np.concatenate([r, 1 - r], -1), -1, kind="stable")
    chosen = index.probes[:probes]
    step = np.zeros(f.shape[:2] + (len(chosen), k), np.int64)
    t, n = np.ogrid[:f.shape[0], :f.shape[1]]
    for j in range(2 * k):
        at = order[:, :, j]
        step[t, n, :, at % k] += np.where(at < k, -1, 1)[..., None] * chosen[:, j]
    return bucket_ids(base[:, :, None, :] + step)


def _valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    x = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    return rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite
                      & F.exists("x", lambda v: v != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=float).reshape(len(column), -1)


def _best_of_all(index_rows: DataFrame, ids: list[int], q: np.ndarray, k: int) -> list[np.ndarray]:
    """The k nearest index vectors of a few queries, exactly: the yardstick of the fit."""
    given = index_rows.sparkSession.sparkContext.broadcast((np.array(ids), q))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = given.value
        for batch in batches:
            vid, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            s = np.where(vid[None] == own[:, None], -np.inf, q @ x.T)
            top = np.argsort(-s, 1, kind="stable")[:, :k]
            rows = [(int(i), float(s[i, j]), x[j].tolist()) for i in range(len(q)) for j in top[i]
                    if np.isfinite(s[i, j])]
            i, s_, x_ = zip(*rows) if rows else ((), (), ())
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(s_, pa.float64()),
                                   pa.array(x_, pa.list_(pa.float64()))], ["q", "s", "x"])

    found = index_rows.select("vid", "x").mapInArrow(best, "q int, s double, x array<double>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "x"))
    rows = found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank").collect()
    return [np.array([r["x"] for r in rows if r["q"] == i]).reshape(-1, q.shape[1])
            for i in range(len(q))]


def fit_index(index_rows: DataFrame, queries: DataFrame, k: int, seed: int = 11) -> tuple[Index, int]:
    """(index, probes per table): functions by the number of vectors, probes by measured recall.

    The exact neighbours of ``FIT_QUERIES`` queries are found once; as many probes are taken as
    find ``FIT_RECALL`` of them. With more than ``MOST_PROBES`` the buckets are made coarser.
    """
    n, longest, dims = index_rows.agg(
        F.count("*"), F.sqrt(F.max(_dot(F.col("x"), F.col("x")))), F.max(F.size("x"))).first()
    some = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(FIT_QUERIES).collect()
    q = np.array([r["x"] for r in some])
    near = _best_of_all(index_rows, [r["query_id"] for r in some], q, k)
    rng = np.random.default_rng(seed)
    for functions in range(max(1, round(np.log2(max(n / BUCKET, 2)) / BITS)), 0, -1):
        index = Index(rng.normal(size=(TABLES, functions, dims + 1)),
                      rng.uniform(size=(TABLES, functions)), WIDTH * longest, longest,
                      probing_order(functions, MOST_PROBES))
        places = []
        buckets = probe_buckets(index, q, MOST_PROBES)
        for i, x in enumerate(near):
            if len(x):
                own = bucket_ids(np.floor(index.slots(index.lift(x))).astype(np.int64))
                hit = own[:, :, None] == buckets[:, i, None, :]
                first = np.where(hit.any(-1), hit.argmax(-1), MOST_PROBES)
                places.extend(first.min(0))
        at = np.sort(places)
        need = int(at[min(len(at) - 1, int(np.ceil(FIT_RECALL * len(at))) - 1)]) + 1 if len(at) else 1
        if need <= len(index.probes) or functions == 1:
            return index, min(need, len(index.probes))
    raise AssertionError("unreachable")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)


def _search(vectors: pa.Table, asks: pa.Table, keep: int) -> pa.Table:
    """Best ``keep`` vectors of each query in the buckets of one part that it visits."""
    kind = {"query_id": pa.int64(), "vid": pa.int64(), "score": pa.float64()}
    out: dict[str, list] = {c: [] for c in kind}
    if vectors.num_rows and asks.num_rows:
        vid, x = vectors["vid"].to_numpy(), _matrix(vectors["x"].combine_chunks())
        bucket = vectors["bucket"].to_numpy()
        order = np.argsort(bucket, kind="stable")
        vid, x, bucket = vid[order], x[order], bucket[order]
        names, starts = np.unique(bucket, return_index=True)
        stops = np.append(starts[1:], len(bucket))
        spans = dict(zip(names.tolist(), zip(starts.tolist(), stops.tolist())))
        for query, q, bound, buckets in zip(
                asks["query_id"].to_pylist(), _matrix(asks["x"].combine_chunks()),
                asks["bound"].to_pylist(), asks["buckets"].to_pylist()):
            seen = spans.values() if buckets is None else [spans[b] for b in buckets if b in spans]
            if not seen:
                continue
            at = np.concatenate([np.arange(*span) for span in seen])
            s, ids = x[at] @ q, vid[at]
            good = np.flatnonzero(s >= bound - 1e-9)
            good = good[np.lexsort((ids[good], -s[good]))]
            _, first = np.unique(ids[good], return_index=True)
            good = good[np.sort(first)][:keep]
            out["query_id"] += [query] * len(good)
            out["vid"] += ids[good].tolist()
            out["score"] += s[good].tolist()
    return pa.table({c: pa.array(v, kind[c]) for c, v in out.items()})


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found per query.

    ``queries`` selects query rows; candidates are all rows but the query's own. Equal vectors
    are indexed once with their k + 1 smallest ids, which is all that a result can hold of them.
    Vectors are lifted to equal length, hashed by p-stable functions into ``TABLES`` tables, and
    each query visits its buckets in order of estimated success. Buckets are dealt to parts of about
    ``TASK_ROWS`` vectors (a larger bucket is split over several); a query is sent once to each part
    it visits, and queries of a part are split likewise. A bound from a sample of vectors prunes early
    without loss. A query that meets fewer than k vectors searches all parts. The scores of the best are computed anew in double precision, in order.

    Null, zero or non-finite vectors, those of another length than the most frequent one, and
    rows without id take no part; a repeated id with the same vector counts once. Fewer candidates than k
    give fewer rows. Ties go to the smaller id. Other columns are not read.
    """
    rows = _valid(vectors, vec_id, embedding)
    asked = vectors.where(queries)
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    spark = vectors.sparkSession
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("x") == sizes[0]["d"])
    asked = _valid(asked, vec_id, embedding).where(F.size("x") == sizes[0]["d"])
    asked = asked.select(F.col("vec_id").alias("query_id"), "x").dropDuplicates(["query_id", "x"])
    few = Window.partitionBy("x").orderBy("vec_id")
    firsts = rows.dropDuplicates(["vec_id", "x"]).withColumn("r", F.row_number().over(few))
    firsts = firsts.where(F.col("r") <= k + 1)
    distinct = firsts.groupBy("x").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    distinct = materialize(distinct.select(F.col("ids")[0].alias("vid"), "x", "ids"), "vectors")
    if asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, probes = fit_index(distinct, asked, k)
    parts = max(1, -(-distinct.count() * TABLES // TASK_ROWS))
    sample = distinct.orderBy(F.xxhash64("vid"), "vid").limit(BOUND_SAMPLE).select("vid", "x").collect()
    given = spark.sparkContext.broadcast((index, np.array([r["vid"] for r in sample]),
                                          np.array([r["x"] for r in sample])))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = given.value[0]
        for batch in batches:
            x = _matrix(batch.column(1))
            ids = bucket_ids(np.floor(index.slots(index.lift(x))).astype(np.int64)).T
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(ids), pa.list_(pa.int64()))],
                                  ["vid", "x", "buckets"])

    placed = distinct.select("vid", "x").mapInArrow(place, "vid long, x array<double>, buckets array<long>")
    placed = placed.select("vid", "x", F.explode("buckets").alias("bucket"))
    # At most (index rows / TASK_ROWS) buckets are that large, so the list stays short.
    large = {r["bucket"]: -(-r["count"] // TASK_ROWS) for r in
             placed.groupBy("bucket").count().where(F.col("count") > TASK_ROWS).toLocalIterator()}
    split = spark.sparkContext.broadcast(large)

    def part_of(bucket: int, i: int) -> int:
        return int((bucket + i * 0x9E3779B97F4A7C15) % (2**61 - 1) % parts)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = [part_of(b, v % split.value.get(b, 1)) for v, b in
                    zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.record_batch([*batch.columns, pa.array(part, pa.int32())], ["vid", "x", "bucket", "part"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, vids, known = given.value
        for batch in batches:
            all_ids, all_q = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for i in range(0, len(all_ids), 200):
                ids, q = all_ids[i:i + 200], all_q[i:i + 200]
                s = np.where(vids[None] == ids[:, None], -np.inf, q @ known.T)
                bound = np.sort(s, 1)[:, -k] if s.shape[1] >= k else np.full(len(q), -np.inf)
                visited = np.moveaxis(probe_buckets(index, q, probes), 1, 0).reshape(len(q), -1)
                out = []
                for n, query in enumerate(ids.tolist()):
                    by_part: dict[int, list[int]] = {}
                    for b in visited[n].tolist():
                        for j in range(split.value.get(b, 1)):
                            by_part.setdefault(part_of(b, j), []).append(b)
                    out += [(query, q[n], float(bound[n]), p, bs) for p, bs in by_part.items()]
                query_id, x, b, p, bs = zip(*out)
                yield pa.record_batch(
                    [pa.array(query_id, pa.int64()), pa.array(list(x), pa.list_(pa.float64())),
                     pa.array(b, pa.float64()), pa.array(p, pa.int32()), pa.array(bs, pa.list_(pa.int64()))],
                    ["query_id", "x", "bound", "part", "buckets"])

    index_rows = placed.mapInArrow(assign, "vid long, x array<double>, bucket long, part int")
    asks = materialize(asked.mapInArrow(
        ask, "query_id long, x array<double>, bound double, part int, buckets array<long>"), "asks")

    def ranked(asks: DataFrame) -> DataFrame:
        chunks = asks.groupBy("part").agg(F.ceil(F.count("*") / TASK_ROWS).cast("int").alias("chunks"))
        dealt = chunks.select(F.col("part").alias("p"), F.col("chunks").alias("c"))
        dealt = asks.join(dealt, F.col("part") == F.col("p")).withColumn(
            "chunk", F.pmod(F.xxhash64("query_id"), F.col("c")).cast("int")).drop("p", "c")
        held = index_rows.join(chunks, "part").withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        found = held.groupBy("part", "chunk").cogroup(dealt.groupBy("part", "chunk")).applyInArrow(
            lambda a, b: _search(a, b, k + 5), "query_id long, vid long, score double")
        found = found.groupBy("query_id", "vid").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vid")
        found = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 4)
        full = found.select("query_id", "vid").join(distinct.select("vid", "ids", F.col("x").alias("y")), "vid")
        full = full.join(asked, "query_id").select(
            "query_id", F.explode("ids").alias("vec_id"), _dot(F.col("x"), F.col("y")).alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        full = full.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order))
        return materialize(
            full.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")

    near = ranked(asks)
    # Queries that met fewer than k vectors search every part.
    met = near.groupBy("query_id").agg(F.count("*").alias("met")).where(F.col("met") >= k)
    short = materialize(asked.join(met, "query_id", "left_anti"), "short")
    if short.isEmpty():
        return near
    everywhere = short.select(
        "query_id", "x", F.lit(float("-inf")).alias("bound"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(None).cast("array<long>").alias("buckets"))
    return near.join(met, "query_id", "left_semi").union(ranked(everywhere))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
