"""SentencePiece encoding and decoding over a relational lattice of distinct words."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import FEW_ROWS, materialize, setting
from .common import byte_batches, table, texts_of

SPACE = "▁"
#: Words of up to so many characters go through the lattice (boundaries are bits of a long); longer runs are
#: folded one by one.
LATTICE_CHARS = 60
_LATE = 1 << 62
#: Most words whose encodings are broadcast, and most bytes of them; rarer ones are joined beyond that.
BROADCAST_WORDS, BROADCAST_BYTES = 6_000_000, 64 << 20
#: Bytes of an encoding besides two for each id: its hash and its start.
WORD_BYTES = 12
CACHED_WORDS = 100_000
#: Words of one partition of the lattice, and characters of texts that are split into words at once.
PART_WORDS, RUN_CHARS = 40_000, 1 << 20
#: Texts of a batch that are Python strings at once, and distinct words that a task counts before it passes them on.
TEXTS_AT_ONCE, COUNTED_WORDS = 500, 120_000
#: Distinct words whose runs are lists at once.
CUT_AT_ONCE = 20_000
#: Ids that are decoded at once.
IDS_AT_ONCE = 1 << 20


class Vocabulary:
    """Pieces of a model file: text, id and score of each; ids of bytes and of the unknown piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces, self.bytes = {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = (i, model.get_score(i))
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.pieces), default=1)
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces run across words")
        # A line break inside no piece ends a word as well.
        stop = "" if any("\n" in p for p in self.pieces) else "\n"
        self.units = re.compile(f"{SPACE}+[^{SPACE}{stop}]*|[^{SPACE}{stop}]+" + (f"|{stop}" if stop else ""))
        self.stop, self.parts = stop, re.compile(f"{SPACE}+[^{SPACE}{stop}]*" + (f"|{stop}[^{SPACE}{stop}]*" if stop else ""))
        # No piece holds two neighbours that are not here, so no path of a lattice crosses between them.
        self.pairs = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        chars = sorted({c for pair in self.pairs for c in pair})
        self.classes = np.zeros(0x110000, np.uint16)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.together = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in self.pairs:
            self.together[self.classes[ord(a)], self.classes[ord(b)]] = True
        self.texts = {i: p.encode() for p, (i, _) in self.pieces.items()}
        self.texts |= {i: bytes([b]) for b, i in self.bytes.items()}

    def words(self, text: str | None) -> list[str]:
        return self.units.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def runs(self, unit: str) -> list[str]:
        """A word cut where no piece holds both neighbours; each run is encoded by itself."""
        cuts = [0, *(i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in self.pairs), len(unit)]
        return [unit[a:b] for a, b in zip(cuts, cuts[1:])]

    def chunks(self, text: str | None) -> list[str]:
        """The text cut before spaces and line breaks, with the one mark in front left out: most words are a plain split."""
        if not text:
            return []
        if text[0] == " " or "  " in text or SPACE in text:
            found = self.parts.findall(SPACE + text.replace(" ", SPACE))
            return [p.removeprefix(SPACE) for p in found]
        return (text.replace(self.stop, " " + self.stop) if self.stop else text).split(" ")

    def runs_of(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """(runs of all chunks one after the other, how many there are up to the end of each): cut like ``runs``, at once."""
        marked = [c if self.stop and c.startswith(self.stop) else SPACE + c for c in chunks]
        joined = "".join(marked)
        kinds = self.classes[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cut = np.ones(len(kinds) + 1, bool)
        cut[1:-1] = ~self.together[kinds[:-1], kinds[1:]]
        ends = np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))
        cut[ends] = True
        at = np.flatnonzero(cut)
        places = at.tolist()
        return [joined[a:b] for a, b in zip(places, places[1:])], np.searchsorted(at, ends).tolist()

    def of_char(self, c: str) -> list[int]:
        if c in self.pieces:
            return [self.pieces[c][0]]
        raw = c.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if self.bytes else [self.unknown]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The piece table; equal scores have equal ranks, the greatest the first."""
        scores = sorted({s for _, s in self.pieces.values()}, reverse=True)
        ranks = {s: i + 1 for i, s in enumerate(scores)}
        rows = [(p, i, float(s), ranks[s]) for p, (i, s) in self.pieces.items()]
        return spark.createDataFrame(rows, "piece string, id int, score double, rank int")


def lattice(words: DataFrame, vocabulary: Vocabulary, **lists: Column) -> DataFrame:
    """(word, edges): substrings of bounded length joined to the piece table, grouped by word.

    An edge is (s, t, id, score); a single character outside the table keeps an edge without id. ``lists`` gives
    other lists to gather; nulls are left out. The table is as long as the vocabulary, so it is broadcast; the
    grouping reuses the words' own partitions.
    """
    lists = lists or {"edges": F.struct("s", "t", "id", "score")}
    n = F.char_length("word")
    rows = words.select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(vocabulary.longest), n - F.col("s")))
    rows = rows.select("word", "s", F.explode(sizes).alias("k"))
    rows = rows.select("word", "s", (F.col("s") + F.col("k")).alias("t"),
                       F.substring(F.col("word"), F.col("s") + 1, F.col("k")).alias("piece"))
    rows = rows.join(F.broadcast(vocabulary.frame(words.sparkSession)), "piece", "left")
    rows = rows.where(F.col("id").isNotNull() | (F.col("t") == F.col("s") + 1))
    rows = rows.select("word", *(edge.alias(name) for name, edge in lists.items()))
    return rows.groupBy("word").agg(*(F.collect_list(name).alias(name) for name in lists))


def _byte_ids(char: Column, vocabulary: Vocabulary) -> Column:
    """Ids of a character outside the table: its bytes, or the unknown piece."""
    if not vocabulary.bytes:
        return F.array(F.lit(vocabulary.unknown))
    raw = F.hex(F.encode(char, "UTF-8"))
    ids = F.array(*(F.lit(vocabulary.bytes[b]) for b in range(256)))
    return F.transform(F.sequence(F.lit(0), (F.length(raw) / 2).cast("int") - 1), lambda k: F.get(
        ids, F.conv(F.substring(raw, 2 * k + 1, F.lit(2)), 16, 10).cast("int")))


def _ids_of(path: Column, vocabulary: Vocabulary) -> Column:
    """Ids along a path of (s, id)."""
    return F.flatten(F.transform(path, lambda e: F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(
        _byte_ids(F.substring(F.col("word"), e["s"] + 1, F.lit(1)), vocabulary))))


def fold_viterbi(edges: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, ids) along the path of greatest total score, for unigram models.

    The fold goes over end positions and keeps the best score, start and id of each. Characters outside the table
    cost ten more than the worst piece. Ties go to the later start, then the larger id.
    """
    worst = min((s for _, s in vocabulary.pieces.values()), default=0.0) - 10
    n, state = F.char_length("word"), "array<struct<score: double, s: int, id: int>>"
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("s"), F.lit(-1).alias("id"))).cast(state)

    def step(acc: Column, t: Column) -> Column:
        ways = F.transform(F.filter("edges", lambda e: e["t"] == t), lambda e: F.struct(
            (F.get(acc, e["s"])["score"] + F.coalesce(e["score"], F.lit(worst))).alias("score"),
            e["s"].alias("s"), e["id"].alias("id")))
        return F.concat(acc, F.array(F.array_max(ways)))

    best = edges.select("word", n.alias("n"), F.aggregate(F.sequence(F.lit(1), n), first, step).alias("best"))
    start = F.struct(F.col("n").alias("t"), F.array().cast("array<struct<s: int, id: int>>").alias("path"))

    def back(acc: Column, _: Column) -> Column:
        at = F.get(F.col("best"), acc["t"])
        one = F.array(F.struct(at["s"].alias("s"), at["id"].alias("id")))
        return F.when(acc["t"] > 0, F.struct(at["s"].alias("t"), F.concat(one, acc["path"]).alias("path"))).otherwise(acc)

    path = F.aggregate(F.sequence(F.lit(1), F.col("n")), start, back)["path"]
    return best.select("word", _ids_of(path, vocabulary).alias("ids"))


def merge_lists(vocabulary: Vocabulary) -> dict[str, Column]:
    """The list of a lattice that ``fold_merges`` reads: an edge in one long, which sorts by rank, then start.

    From the low bits: id plus one (24 bits, 0 for none), length and start (6 each), rank by score (single characters
    before all others).
    """
    if max((i for i, _ in vocabulary.pieces.values()), default=0) >= 1 << 23:
        raise ValueError("more pieces than an edge can number")
    return {"edges": F.expr(
        "shiftleft(if(t = s + 1, 0L, cast(rank as long)), 36) + shiftleft(cast(s as long), 30)"
        " + shiftleft(cast(t - s as long), 24) + coalesce(id + 1, 0)")}


def fold_merges(edges: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, ids) as a BPE model merges: over and over the best edge that spans two neighbours.

    (A BPE model's scores are merge ranks: the path of greatest sum is not the library's answer.) The state is the set
    of boundaries as bits; edges come by rank, then from the left. An edge with both ends and one boundary between is
    merged; one that lost an end can never be. One with both ends and more between might become possible late, out of
    this order: such words get null ids and are merged one by one. Without any, the fold is what the library does.
    """
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at)
    field = lambda e, low: F.shiftright(e, low).cast("int").bitwiseAND(F.lit(63))

    def step(acc: Column, e: Column) -> Column:
        # Boundaries from the start on: both ends, and what lies between.
        s, size = field(e, 30), field(e, 24)
        here = F.call_function("shiftright", acc, s)
        ends = bit(size) + 1
        between = here.bitwiseAND(bit(size) - 2)
        return F.when(here.bitwiseAND(ends) != ends, acc).when(
            F.bit_count(between) == 1, acc.bitwiseXOR(F.call_function("shiftleft", between, s))).otherwise(
                acc.bitwiseOR(F.lit(_LATE)))

    def on_path(e: Column) -> Column:
        size = field(e, 24)
        span = bit(size + 1) - 1
        return F.call_function("shiftright", F.col("b"), field(e, 30)).bitwiseAND(span) == bit(size) + 1

    n = F.char_length("word")
    rows = edges.select("word", n.alias("n"), F.sort_array("edges").alias("edges"))
    wide = F.slice("edges", F.col("n") + 1, F.size("edges"))
    rows = rows.select("word", "edges", F.aggregate(wide, F.expr("shiftleft(1L, n + 1) - 1"), step).alias("b"))
    # Start in the high half, id plus one in the low.
    path = F.transform(F.filter("edges", on_path), lambda e: F.shiftleft(field(e, 30).cast("long"), 32).bitwiseOR(
        e.bitwiseAND(F.lit((1 << 24) - 1))))
    rows = rows.select("word", F.when(F.col("b") < _LATE, F.sort_array(path)).alias("path"))
    id_of = lambda m: m.cast("long").bitwiseAND(F.lit((1 << 24) - 1)).cast("int") - 1
    rows = rows.select("word", "path", F.transform("path", id_of).alias("ids"))
    with_bytes = F.transform("path", lambda m: F.struct(
        F.shiftright(m, 32).cast("int").alias("s"), F.nullif(id_of(m), F.lit(-1)).alias("id")))
    return rows.select("word", F.when(
        F.array_contains("ids", -1), _ids_of(with_bytes, vocabulary)).otherwise(F.col("ids")).alias("ids"))


def merge_long(word: str, vocabulary: Vocabulary) -> list[int]:
    """The same merges for one long run without spaces, with a heap instead of a rescan."""
    n = len(word)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    ends, heap = list(range(1, n + 1)), []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and ends[j] - i <= vocabulary.longest and (found := vocabulary.pieces.get(word[i:ends[j]])):
            heapq.heappush(heap, (-found[1], i, ends[i], ends[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, mid, end = heapq.heappop(heap)
        if not alive[i] or ends[i] != mid or mid >= n or not alive[mid] or ends[mid] != end:
            continue
        alive[mid], ends[i], after[i] = False, end, after[mid]
        if end < n:
            before[end] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out = []
    for i in range(n):
        if alive[i]:
            found = vocabulary.pieces.get(word[i:ends[i]])
            out += [found[0]] if found else vocabulary.of_char(word[i:ends[i]])
    return out


def path_long(word: str, vocabulary: Vocabulary) -> list[int]:
    """The path of greatest score of one long run, for unigram models."""
    worst = min((s for _, s in vocabulary.pieces.values()), default=0.0) - 10
    best: list[tuple] = [(0.0, -1, -1)]
    for t in range(1, len(word) + 1):
        ways = []
        for s in range(max(0, t - vocabulary.longest), t):
            i, score = vocabulary.pieces.get(word[s:t], (None, worst))
            if i is not None or t == s + 1:
                ways.append((best[s][0] + score, s, -1 if i is None else i))
        best.append(max(ways))
    out, t = [], len(word)
    while t > 0:
        _, s, i = best[t]
        out.append(vocabulary.of_char(word[s:t]) if i < 0 else [i])
        t = s
    return [i for ids in reversed(out) for i in ids]


def encode_words(words: DataFrame, path: str, kind: str, n_words: int) -> DataFrame:
    """(word, ids) of distinct words, in partitions of about PART_WORDS of them."""
    vocabulary = Vocabulary(path)
    words = words.repartition(max(1, -(-n_words // PART_WORDS)), "word")
    short = words.where(F.char_length("word") <= LATTICE_CHARS)
    if kind == "bpe":
        folded = fold_merges(lattice(short, vocabulary, **merge_lists(vocabulary)), vocabulary)
    else:
        folded = fold_viterbi(lattice(short, vocabulary), vocabulary)

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long = merge_long if kind == "bpe" else path_long
        for batch in batches:
            words, ids = batch.columns
            if ids.null_count:
                ids = pa.array([long(w, _vocabulary(path)) if i is None else i for w, i in zip(
                    words.to_pylist(), ids.to_pylist())], pa.list_(pa.int32()))
            yield pa.record_batch([words, ids], ["word", "ids"])

    long = words.where(F.char_length("word") > LATTICE_CHARS).select("word", F.lit(None).cast("array<int>").alias("ids"))
    return folded.union(long).mapInArrow(one_by_one, "word string, ids array<int>")


_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def distinct_words(docs: DataFrame, path: str, text: str) -> DataFrame:
    """(word, n) over all texts, counted in the tasks first: runs that the pieces cannot cross."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(path)
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            runs: dict[str, int] = {}
            chunks, counts = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
            for at in range(0, len(chunks), CUT_AT_ONCE):
                flat, ends = v.runs_of(chunks[at:at + CUT_AT_ONCE])
                sizes = np.diff(np.array(ends, np.int64), prepend=0)
                for r, n in zip(flat, np.repeat(counts[at:at + CUT_AT_ONCE], sizes).tolist()):
                    runs[r] = runs.get(r, 0) + n
            return pa.record_batch([pa.array(list(runs), pa.string()), pa.array(list(runs.values()), pa.int64())],
                                   ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                for t in batch.column(0).slice(at, TEXTS_AT_ONCE).to_pylist():
                    seen.update(v.chunks(t))
                if len(seen) > COUNTED_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    rows = docs.select(text).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


#: A lattice partition holds few words, so their lists are grouped by hash and not sorted.
_IN_MEMORY = ("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(4 * PART_WORDS))


class Encodings:
    """Encodings of many words in flat arrays: 64-bit hashes of words in order, where each one's ids start, and the ids."""

    def __init__(self, blobs: list[tuple[bytes, bytes, bytes]]):
        hashes, sizes, ids = ([np.frombuffer(b[i], t) for b in blobs] or [np.empty(0, t)]
                              for i, t in enumerate((np.uint64, np.uint32, np.int32)))
        self.hashes = np.concatenate(hashes)
        total = sum(map(len, ids))
        # As narrow as the vocabulary and the number of ids allow.
        self.ids = np.empty(total, np.min_scalar_type(max((int(i.max()) for i in ids if len(i)), default=0)))
        np.concatenate(ids, out=self.ids, casting="unsafe")
        self.starts = np.zeros(len(self.hashes) + 1, np.min_scalar_type(total))
        np.cumsum(np.concatenate(sizes), out=self.starts[1:], dtype=self.starts.dtype)

    def look_up(self, words: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(raw ids, 32 bits each, of all words one after the other, where those of each end, which words are held)."""
        if not len(self.hashes) or not words:
            return b"", np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        h = _hashes(words)
        # In the order of the hashes, neighbours are searched in the same place.
        order = np.argsort(h)
        at = np.empty(len(h), np.int64)
        at[order] = np.searchsorted(self.hashes, h[order])
        at = np.minimum(at, len(self.hashes) - 1)
        hit = self.hashes[at] == h
        first = self.starts[at].astype(np.int64)
        sizes = np.where(hit, self.starts[at + 1] - first, 0)
        stops = np.cumsum(sizes)
        held = self.ids[np.repeat(first - stops + sizes, sizes) + np.arange(stops[-1])]
        return held.astype(np.int32).tobytes(), 4 * stops, hit


def _hashes(words: list[str]) -> np.ndarray:
    """Spark's xxhash64 of each word, unsigned; strings are hashed as UTF-8 without a copy."""
    try:
        return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words))
    except UnicodeEncodeError:
        raw = (w.encode("utf-8", "surrogatepass") for w in words)
        return np.fromiter(map(xxhash.xxh64_intdigest, raw, repeat(42)), np.uint64, len(words))


def _packed(words: DataFrame) -> list[tuple[bytes, bytes, bytes]]:
    """Hashes, sizes and ids by unsigned hash: Spark sorts, the driver only joins the blocks."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            hashes = np.asarray(batch.column(0)).view(np.uint64) ^ np.uint64(1 << 63)
            sizes = np.asarray(ids.value_lengths()).astype(np.uint32)
            flat = np.asarray(ids.flatten()).astype(np.int32)
            yield pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in (hashes, sizes, flat)], ["h", "s", "i"])

    # With the top bit turned, signed order is the order of the unsigned hashes.
    turned = F.xxhash64("word").bitwiseXOR(F.lit(-(1 << 63)))
    rows = words.select(turned.alias("h"), "ids").repartitionByRange("h").sortWithinPartitions("h")
    rows = rows.mapInArrow(pack, "h binary, s binary, i binary").toLocalIterator()
    return [(bytes(r["h"]), bytes(r["s"]), bytes(r["i"])) for r in rows]


def _held(encoded: DataFrame, counted: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """(words to broadcast, the rest): all, or the most frequent ones within both bounds."""
    size = F.sum(WORD_BYTES + 2 * F.size("ids")).alias("bytes")
    r = encoded.agg(F.count("*").alias("n"), size).first()
    if r["n"] <= most and (r["bytes"] or 0) <= BROADCAST_BYTES:
        return encoded, None
    encoded = materialize(encoded.join(counted, "word"), "encoded")
    # The count that at most that many words, or words of that size, exceed.
    words, held, least = 0, 0, None
    for r in encoded.groupBy("n").agg(F.count("*").alias("words"), size).orderBy(F.desc("n")).toLocalIterator():
        words, held = words + r["words"], held + r["bytes"]
        if words > most or held > BROADCAST_BYTES:
            break
        least = r["n"]
    if least is None:
        return encoded.limit(0), encoded
    return encoded.where(F.col("n") >= least), encoded.where(F.col("n") < least)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", kind: str = "bpe",
           broadcast_words: int = BROADCAST_WORDS, back: str | None = None) -> DataFrame:
    """Add the piece ids of each text, as the model at ``path`` encodes it.

    A text starts with a space mark and spaces become marks. Pieces hold marks only in front, so words (marks
    and what follows, or a line break) are encoded by themselves, and so are the runs of a word between neighbours
    that no piece holds together: distinct runs of all texts are exploded
    into substrings of bounded length, joined to the piece table, grouped into lattices and folded (``kind``: "bpe"
    merges, "unigram" Viterbi). Texts then look their words up: the encodings of the most frequent words, at most
    ``broadcast_words`` and ``BROADCAST_BYTES``, are broadcast in flat arrays; other words are joined by shuffle.

    With ``back`` that column gets the text that the ids decode to, in the same pass and worker (see ``decode``).

    Null and empty texts have no pieces. Repeated rows are encoded alike. Columns named ``out`` and ``back`` are replaced,
    others pass through. Models are those without other text normalisation than the space mark.
    """
    spark = docs.sparkSession
    words = distinct_words(docs, path, text)
    with setting(spark, *FEW_ROWS):
        counted = materialize(words, "words")
    n_words = counted.count()
    encoded = encode_words(counted, path, kind, n_words)
    with setting(spark, *_IN_MEMORY):
        encoded = materialize(encoded, "encoded")
    held, tail = _held(encoded, counted, broadcast_words)
    given = spark.sparkContext.broadcast(Encodings(_packed(held)))
    known: dict[str, bytes] = {}

    def look_up(texts: list[str], v: Vocabulary) -> tuple[list[list[str]], dict[str, list]]:
        """Words of each text; runs and ids of the words that are not all held, the ids null where not held."""
        lists = [v.chunks(t) for t in texts]
        words = set().union(*lists)
        if len(known) > CACHED_WORDS:
            # Words of these texts stay, so that frequent ones are not looked up again and again.
            keep = {w: known[w] for w in words & known.keys()}
            known.clear()
            known.update(keep)
        new = list(words.difference(known))
        flat, ends = v.runs_of(new)
        raw, stops, hit = given.value.look_up(flat)
        stops, missing = [0, *stops.tolist()], np.append(0, np.cumsum(~hit))[[0, *ends]]
        whole = (np.diff(missing) == 0).tolist()
        open_ = {}
        for w, i, j, ok in zip(new, [0, *ends], ends, whole):
            if ok:
                known[w] = raw[stops[i]:stops[j]]
            else:
                open_[w] = [(flat[k], raw[stops[k]:stops[k + 1]] if hit[k] else None) for k in range(i, j)]
        return lists, open_

    rows, key = docs, []
    if tail is not None:
        rows = rows.withColumn("key_", F.xxhash64(F.col(text), F.lit("pieces")))

        def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v = _vocabulary(path)
            for batch in batches:
                keys, pairs = iter(batch.column(0).to_pylist()), []
                for run in byte_batches(texts_of(batch.column(1)), RUN_CHARS):
                    lists, open_ = look_up(run, v)
                    pairs += [(next(keys), {r for w in open_.keys() & ws for r, ids in open_[w] if ids is None})
                              for ws in lists]
                k, w = [k for k, ws in pairs for _ in ws], [w for _, ws in pairs for w in ws]
                yield pa.record_batch([pa.array(k, pa.int64()), pa.array(w, pa.string())], ["key_", "word"])

        wanted = rows.select("key_", text).mapInArrow(rare, "key_ long, word string").distinct()
        tail = wanted.join(tail.select("word", "ids"), "word").groupBy("key_").agg(
            F.collect_list(F.struct("word", "ids")).alias("tail_"))
        rows, key = rows.join(tail, "key_", "left"), ["key_", "tail_"]

    nothing = pa.array([], pa.list_(pa.int32()))

    @F.arrow_udf("array<int>" if back is None else "struct<ids: array<int>, text: string>")
    def to_ids(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        v = _vocabulary(path)
        decoder = None if back is None else Texts(v)

        def ids_of(texts: list[str], tails: Iterator[pa.Scalar]) -> pa.Array:
            lists, open_ = look_up(texts, v)
            done = []
            for ws in lists:
                more = next(tails).as_py()
                if own_words := open_.keys() & ws:
                    extra = {m["word"]: np.array(m["ids"], np.int32).tobytes() for m in more}
                    extra = {w: b"".join(extra[r] if ids is None else ids for r, ids in open_[w]) for w in own_words}
                    done.append(b"".join(extra[w] if w in extra else known[w] for w in ws))
                else:
                    done.append(b"".join(map(known.__getitem__, ws)))
            stops = np.cumsum([0, *(len(d) // 4 for d in done)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(stops), pa.array(np.frombuffer(b"".join(done), np.int32)))

        for texts, own in batches:
            tails = iter(own)
            # Some rows at a time, so that no batch is held twice over.
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                some = texts_of(texts.slice(at, TEXTS_AT_ONCE))
                parts = [ids_of(run, tails) for run in byte_batches(some, RUN_CHARS)]
                ids = pa.concat_arrays([nothing, *parts])
                if decoder is None:
                    yield ids
                else:
                    again = pa.concat_arrays([pa.array([], pa.string()), *map(decoder.of, parts)])
                    yield pa.StructArray.from_arrays([ids, again], ["ids", "text"])

    none = F.lit(None).cast("array<struct<word: string, ids: array<int>>>")
    made = to_ids(F.col(text), F.col("tail_") if key else none)
    if back is None:
        return rows.withColumn(out, made).drop(*key)
    both = rows.withColumn("both_", made)
    return both.withColumns({out: F.col("both_.ids"), back: F.col("both_.text")}).drop("both_", *key)


class Texts:
    """Bytes of each id: as within a text, then as in front of one, where a leading space goes; the last is empty."""

    def __init__(self, v: Vocabulary):
        n = self.n = max(v.texts, default=-1) + 1
        inner = [v.texts.get(i, b"") for i in range(n)]
        self.is_byte = np.zeros(2 * n + 1, bool)
        self.is_byte[[i + k for i in v.bytes.values() for k in (0, n)]] = True
        inner = [t if b else t.replace(SPACE.encode(), b" ") for t, b in zip(inner, self.is_byte)]
        self.table = pa.array([*inner, *(t.removeprefix(b" ") for t in inner), b""], pa.large_binary())
        self.filled = np.array([*map(bool, inner), *[False] * (n + 1)])

    def of(self, rows: pa.Array) -> pa.Array:
        """Text of each list of ids."""
        some, n = rows.flatten(), self.n
        at = (some.fill_null(2 * n) if some.null_count else some).to_numpy(zero_copy_only=False)
        at = np.where((at >= 0) & (at < n), at, 2 * n)
        ends = np.append(0, np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        # The first id of a row that has a text is in front.
        there = np.append(np.flatnonzero(self.filled[at]), len(at))
        front = there[np.searchsorted(there, ends[:-1])]
        at[front[front < ends[1:]]] += n
        held = self.table.take(pa.array(at))
        # The bytes of all taken pieces lie one behind the other.
        stops = np.append(0, np.cumsum(pc.binary_length(held).to_numpy(zero_copy_only=False))).astype(np.int64)
        data = held.buffers()[2] or pa.py_buffer(b"")
        out = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(stops[ends]), data])
        # Only bytes written one by one may form no text.
        bytes_ = np.append(0, np.cumsum(self.is_byte[at]))[ends]
        mixed = pa.array(np.diff(bytes_) > 0)
        mended = [t.decode("utf-8", "replace").encode() for t in out.filter(mixed).to_pylist()]
        out = pc.replace_with_mask(out, mixed, pa.array(mended, pa.large_binary()))
        return out.cast(pa.large_string()).cast(pa.string())


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the text of each list of ids. Null and empty lists give the empty text; control pieces give none.

    Bytes that form no valid text become the replacement character; null or unknown ids give nothing.
    """
    @F.arrow_udf("string")
    def to_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        texts = Texts(_vocabulary(path))
        for batch in batches:
            sizes = np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            parts, at = [pa.array([], pa.string())], 0
            while at < len(batch):
                before = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, before + IDS_AT_ONCE, "right")))
                parts.append(texts.of(batch.slice(at, stop - at)))
                at = stop
            yield pa.concat_arrays(parts)

    return encoded.withColumn(out, to_text(F.col(ids)))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, path, back="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
        (F.col("decoded") == F.coalesce(F.replace(F.col("text"), F.lit(SPACE), F.lit(" ")), F.lit(""))).alias("same"))
