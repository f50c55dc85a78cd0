"""Benchmark decontamination as a prefix-filtered set join on word windows."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import ROWS_AT_ONCE, each_text, table, texts_of

WINDOW = 10
SHINGLE = 3
#: Windows of one broadcast index. A larger benchmark is joined block by block.
BLOCK_WINDOWS = 250_000
#: Lower-cases A-Z and turns every other ASCII byte that is not of a word into a space.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
HITS = "array<struct<start: long, stop: long>>"
_FOUND = pa.struct([
    ("n_words", pa.int64()), ("items", pa.list_(pa.string())),
    ("hits", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def item_windows(words: list[bytes], window: int = WINDOW) -> list[list[bytes]]:
    """Each run of ``window`` words; the whole item where it has fewer but not none."""
    if not words:
        return []
    return [words[i:i + window] for i in range(max(1, len(words) - window + 1))]


def _shingles(words: list[bytes], size: int) -> list[bytes]:
    n = min(size, len(words))
    return [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]


def _shingle_counts(docs: DataFrame, text: str, shingles: set[bytes]) -> Counter:
    """How often each of the given shingles occurs in all documents."""
    by_first = defaultdict(set)
    for s in shingles:
        by_first[s.split(b" ", 1)[0]].add(s.count(b" ") + 1)
    given = docs.sparkSession.sparkContext.broadcast((shingles, dict(by_first)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, (wanted, first) = Counter(), given.value
        for batch in batches:
            for t in each_text(batch.column(0)):
                words = words_of(t)
                for i, w in enumerate(words):
                    if w in first:
                        for n in first[w]:
                            key = b" ".join(words[i:i + n])
                            if key in wanted:
                                found[key] += 1
        yield pa.record_batch([pa.array(list(found), pa.binary()),
                               pa.array(list(found.values()), pa.int64())], ["shingle", "n"])

    counted = docs.select(text).mapInArrow(count, "shingle binary, n long")
    rows = counted.groupBy("shingle").agg(F.sum("n").alias("n")).toLocalIterator()
    return Counter({bytes(r["shingle"]): r["n"] for r in rows})


def _index(docs: DataFrame, text: str, items: list, window: int, shingle: int) -> tuple:
    """(windows with their items; prefix shingle to places; first word to prefix lengths).

    A document holds a window only if it holds all its shingles, so the prefix that the join
    needs is one shingle: the rarest in the documents. Its place in the window and the window's
    length bound where the window can lie.
    """
    windows = defaultdict(set)
    for item, t in items:
        for w in item_windows(words_of(t or ""), window):
            windows[b" ".join(w)].add(item)
    split = {key: _shingles(key.split(b" "), shingle) for key in windows}
    seen = _shingle_counts(docs, text, {s for all_ in split.values() for s in all_})
    places, first = defaultdict(set), defaultdict(set)
    for key, all_ in split.items():
        rare = min(all_, key=lambda s: (seen[s], s))
        places[rare].add((all_.index(rare), key.count(b" ") + 1))
        first[rare.split(b" ", 1)[0]].add(rare.count(b" ") + 1)
    return ({k: frozenset(str(i) for i in v if i is not None) for k, v in windows.items()},
            {k: tuple(v) for k, v in places.items()}, {k: tuple(v) for k, v in first.items()})


def _find(words: list[bytes], index: tuple) -> tuple[list[tuple[int, int]], set[str]]:
    windows, places, first = index
    found, items = set(), set()
    for i, w in enumerate(words):
        if w not in first:
            continue
        for n in first[w]:
            for offset, length in places.get(b" ".join(words[i:i + n]), ()):
                start = i - offset
                if start < 0 or start + length > len(words) or (start, start + length) in found:
                    continue
                held = windows.get(b" ".join(words[start:start + length]))
                if held is not None:
                    found.add((start, start + length))
                    items |= held
    return sorted(found), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _finder(given):
    """Function of (text, hits, items) that adds what the broadcast index finds."""
    @F.arrow_udf(f"n_words: long, items: array<string>, hits: {HITS}")
    def find(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for column, hits, items in batches:
            for at in range(0, len(column), ROWS_AT_ONCE):
                rows, some = [], [x.slice(at, ROWS_AT_ONCE) for x in (column, hits, items)]
                for t, h, known in zip(texts_of(some[0]), some[1].to_pylist(), some[2].to_pylist()):
                    words = words_of(t)
                    spans, more = _find(words, given.value)
                    spans = _merged(spans + [(x["start"], x["stop"]) for x in h])
                    rows.append({"n_words": len(words), "items": sorted(more.union(known)),
                                 "hits": [{"start": a, "stop": b} for a, b in spans]})
                yield pa.array(rows, _FOUND)

    return find


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Add ``n_words``, ``hits`` (merged word ranges) and ``items`` to each document.

    Shingles of the benchmark are ordered by their count over all documents. Each window is
    indexed by its rarest shingle; a document word that starts such a shingle fixes where the
    window must lie, and the words there are compared with the window itself. The index is
    broadcast in blocks of at most ``block_windows`` windows (an item's windows stay together),
    so it is bounded for any benchmark; every block meets all documents. No shuffle moves a text.

    Null and empty texts have no words. Items without words have no windows; several items or
    repeated rows with the same window are all reported. Windows of items with null id count as
    hits, but have no id to list. Columns named like the added ones are replaced, others pass
    through. An empty benchmark gives no hits.
    """
    spark = docs.sparkSession
    sized = benchmark.select(item, item_text)
    n_words = F.size(F.split(F.trim(F.col(item_text)), r"\s+"))
    total = sized.agg(F.sum(n_words)).first()[0] or 0
    blocks = max(1, -(-2 * total // block_windows)) if total > block_windows else 1
    out = docs.withColumns({
        "n_words": F.lit(0).cast("long"), "items": F.array().cast("array<string>"),
        "hits": F.array().cast(HITS)})
    for block in range(blocks):
        part = sized.where(F.pmod(F.xxhash64(item, item_text), F.lit(blocks)) == block)
        index = _index(docs, text, [tuple(r) for r in part.toLocalIterator()], window, shingle)
        given = spark.sparkContext.broadcast(index)
        found = _finder(given)
        out = out.withColumn("found_", found(F.col(text), F.col("hits"), F.col("items")))
        out = out.withColumns({c: F.col(f"found_.{c}") for c in ("n_words", "hits", "items")})
        out = out.drop("found_")
        if block + 1 < blocks:
            out = materialize(out, "hits")
    return out


def hit_words(hits) -> F.Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, h: n + h["stop"] - h["start"])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    found = found.select("doc_id", "n_words", hit_words(F.col("hits")).alias("n_hit"), "items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
windows as (
  select distinct item_id, least(len(ws), 10) as n,
    array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') as k
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 10 + 1, 1) + 1)) as i
        from b where len(ws) > 0)),
starts as (
  select doc_id, i, n, array_to_string(ws[i : i + n - 1], ' ') as k
  from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w) d
    cross join (select distinct n from windows) l
  where i + n - 1 <= len(ws)),
found as (select s.doc_id, s.i, s.n, w.item_id from starts s join windows w using (n, k)),
words_hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from found) group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from w left join words_hit using (doc_id) left join items using (doc_id)
"""
