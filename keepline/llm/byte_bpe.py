"""Byte-level BPE: padded matrices of words of like length, merged row by row in rounds."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import FEW_ROWS, materialize, setting
from .common import byte_batches, each_text, table

#: No pair: above every rank.
NONE = np.int32(2**31 - 1)
#: Bytes of new words that are encoded at once, and cells of one matrix (a longer row stands alone).
WORDS_BYTES, CELLS = 1 << 20, 1 << 18
#: Characters of texts that are split at once, matches of one long text at a time.
RUN_CHARS, RUN_MATCHES = 1 << 19, 100_000
#: Words kept encoded in a worker, and the longest of them in characters.
CACHED_WORDS, CACHED_CHARS = 150_000, 64
#: Ids that are passed on or decoded at once.
IDS_AT_ONCE = 1 << 20


class Merges:
    """Ranks of a file of base64 tokens, as arrays: a rank is also the id of its token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f)
            self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        try:
            self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        except KeyError as e:
            raise ValueError("a byte has no token") from e
        self.base = np.int64(max(self.ranks.values()) + 2)
        left, right, rank = [], [], []
        # Bytes that are neighbours in some token: nothing is ever merged across others.
        self.joined = np.zeros(1 << 16, bool)
        for token, r in self.ranks.items():
            for i in range(1, len(token)):
                self.joined[token[i - 1] << 8 | token[i]] = True
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self._fill(self._key(np.array(left, np.int64), np.array(right, np.int64)), np.array(rank, np.int32))
        tokens = dict(zip(self.ranks.values(), self.ranks))
        self.tokens = pa.array([tokens.get(i, b"") for i in range(int(self.base) - 1)] + [b""], pa.large_binary())

    def _key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        # Padding is -1, so its factor is 0 and no stored pair has it.
        return (left.astype(np.int64) + 1) * self.base + (right + 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _fill(self, key: np.ndarray, rank: np.ndarray) -> None:
        """Open addressing: of the keys that want a free slot one gets it, the others go one on."""
        bits = max(4, int(np.ceil(np.log2(4 * len(key) + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        slot, todo, self.probes = self._slot(key), np.arange(len(key)), 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == -1
            self.keys[slot[todo[free]]] = key[todo[free]]
            put = self.keys[slot[todo]] == key[todo]
            self.values[slot[todo[put]]] = rank[todo[put]]
            todo = todo[~put]
            slot[todo] = (slot[todo] + 1) & self.mask

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbours make, NONE without one."""
        key = self._key(left, right)
        slot = self._slot(key)
        held = self.keys[slot]
        out = np.where(held == key, self.values[slot], NONE)
        todo = np.flatnonzero((held != key) & (held != -1))
        if len(todo):
            key, slot, flat = key.ravel()[todo], slot.ravel()[todo], out.reshape(-1)
            for _ in range(1, self.probes):
                slot = (slot + 1) & self.mask
                held = self.keys[slot]
                hit = held == key
                flat[todo[hit]] = self.values[slot[hit]]
                more = ~hit & (held != -1)
                todo, key, slot = todo[more], key[more], slot[more]
                if not len(todo):
                    break
        return out

    def merge_rows(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, sizes) after all merges; rows are padded with -1.

        Each round every open row merges its leftmost pair of least rank. Further pairs of that rank in the row are
        merged in the same round, from the left and without overlap, unless a pair that this makes, even for a
        moment, has a smaller rank. Rows without pairs leave, the others are compacted.
        """
        out, out_sizes = np.full_like(rows, -1), sizes.copy()
        open_ = np.arange(len(rows))
        ranks = self.rank_of(rows[:, :-1], rows[:, 1:])
        while len(open_):
            least = ranks.min(axis=1, initial=NONE)
            done = least == NONE
            if done.any():
                out[open_[done], :rows.shape[1]], out_sizes[open_[done]] = rows[done], sizes[done]
                open_, rows, sizes, ranks, least = (x[~done] for x in (open_, rows, sizes, ranks, least))
                if not len(open_):
                    break
                width = int(sizes.max())
                rows, ranks = rows[:, :width], ranks[:, :width - 1]
            pick = ranks == least[:, None]
            columns = np.arange(pick.shape[1])
            if (pick[:, 1:] & pick[:, :-1]).any():
                # Of a run of such pairs every second one, its first to begin with.
                begins = pick.copy()
                begins[:, 1:] &= ~pick[:, :-1]
                first = np.maximum.accumulate(np.where(begins, columns, 0), axis=1)
                pick &= (columns - first) % 2 == 0
            many = pick.sum(axis=1) > 1
            if many.any():
                many[many] = self._lower_appears(rows[many], pick[many], least[many])
                at = pick[many].argmax(axis=1)
                pick[many] = columns == at[:, None]
            rows, ranks, sizes = self._merged(rows, ranks, sizes, pick, least)
        return out, out_sizes

    def _lower_appears(self, rows: np.ndarray, pick: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether merging all picks from the left on makes a pair of smaller rank on the way."""
        r, c = np.nonzero(pick)
        new = least[r]
        right = np.where(c + 2 < rows.shape[1], rows[r, np.minimum(c + 2, rows.shape[1] - 1)], -1)
        after_pick = (c >= 2) & pick[r, np.maximum(c - 2, 0)]
        left = np.where(after_pick, new, np.where(c > 0, rows[r, np.maximum(c - 1, 0)], -1))
        worse = (self.rank_of(new, right) < new) | (self.rank_of(left, new) < new)
        return np.bincount(r[worse], minlength=len(rows)) > 0

    def _merged(self, rows, ranks, sizes, pick, least):
        """One round's merges, with the second token of each pair taken out and two ranks per merge renewed."""
        r, c = np.nonzero(pick)
        rows = rows.copy()
        rows[r, c] = least[r]
        keep = np.ones(rows.shape, bool)
        keep[:, 1:] = ~pick
        merged = pick.sum(axis=1)
        sizes = sizes - merged
        width = rows.shape[1] - int(merged.min())
        left = np.arange(width) < (rows.shape[1] - merged)[:, None]
        packed = np.full((len(rows), width), -1, np.int32)
        packed[left] = rows[keep]
        # The rank of a token and its right neighbour moves with the token.
        moved = np.full((len(rows), width), NONE, np.int32)
        moved[left] = np.concatenate([ranks, np.full((len(rows), 1), NONE, np.int32)], axis=1)[keep]
        before = np.cumsum(pick, axis=1)[r, c] - 1
        at = c - before
        for r_, c_ in ((r, at), (r[at > 0], at[at > 0] - 1)):
            right = np.where(c_ + 1 < width, packed[r_, np.minimum(c_ + 1, width - 1)], -1)
            moved[r_, c_] = self.rank_of(packed[r_, c_], right)
        return packed, moved[:, :max(width - 1, 0)], sizes

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one behind the other, number of ids of each). No word is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        first = np.ones(len(data), bool)
        first[1:] = ~self.joined[data[:-1].astype(np.int32) << 8 | data[1:]]
        first[starts] = True
        # Runs that no merge crosses, each in the matrix of its length's power of two.
        begin = np.flatnonzero(first)
        length = np.diff(np.append(begin, len(data)))
        ids = self.of_byte[data]
        held = np.ones(len(data), bool)
        bucket = np.ceil(np.log2(length)).astype(np.int64)
        for b in np.unique(bucket[bucket > 0]):
            of_bucket = np.flatnonzero(bucket == b)
            step = max(1, CELLS >> int(b))
            for part in (of_bucket[i:i + step] for i in range(0, len(of_bucket), step)):
                size = length[part]
                columns = np.arange(int(size.max()))
                inside = columns < size[:, None]
                at = (begin[part][:, None] + columns)[inside]
                rows = np.full(inside.shape, -1, np.int32)
                rows[inside] = ids[at]
                rows, left = self.merge_rows(rows, size)
                ids[at], held[at] = rows[inside], (columns < left[:, None])[inside]
        return ids[held], np.add.reduceat(held, starts, dtype=np.int64)


_loaded: dict[str, tuple[Merges, dict[str, bytes]]] = {}


def _load(path: str) -> tuple[Merges, dict[str, bytes]]:
    """Merges of a file and the encoded words of this worker."""
    if path not in _loaded:
        _loaded[path] = Merges(path), {}
    return _loaded[path]


def _learn(words: set[str], merges: Merges, known: dict[str, bytes]) -> None:
    """Encode words that are not known yet; a word that is a token itself is that token."""
    new = []
    for w in words:
        raw = w.encode("utf-8", "surrogatepass")
        whole = merges.ranks.get(raw)
        if whole is None:
            new.append((w, raw))
        else:
            known[w] = np.int32(whole).tobytes()
    first = 0
    while first < len(new):
        last, size = first, 0
        while last < len(new) and (last == first or size + len(new[last][1]) <= WORDS_BYTES):
            size += len(new[last][1])
            last += 1
        ids, counts = merges.encode_words([raw for _, raw in new[first:last]])
        data, stops = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        for (w, _), a, b in zip(new[first:last], [0, *stops], stops):
            known[w] = data[a:b]
        first = last


def _encoded(texts: Iterable[str], splitter: regex.Pattern, path: str) -> Iterator[bytes]:
    """Ids of each text; a text beyond a run is split in parts of whole matches."""
    merges, known = _load(path)

    def ids_of(lists: list[list[str]]) -> list[bytes]:
        if len(known) > CACHED_WORDS:
            known.clear()
        words = set().union(*lists)
        _learn(words - known.keys(), merges, known)
        done = [b"".join(map(known.__getitem__, ws)) for ws in lists]
        for w in words:
            if len(w) > CACHED_CHARS:
                del known[w]
        return done

    for run in byte_batches(texts, RUN_CHARS):
        if len(run[0]) > RUN_CHARS:
            found = (m.group() for m in splitter.finditer(run[0]))
            yield b"".join(ids_of([part])[0] for part in iter(lambda: list(islice(found, RUN_MATCHES)), []))
        else:
            yield from ids_of([splitter.findall(t) for t in run])


def _lists(done: Iterator[bytes]) -> Iterator[pa.Array]:
    """The ids of texts as lists, as soon as there are about ``IDS_AT_ONCE``."""
    rows: list[bytes] = []

    def passed() -> pa.Array:
        stops = np.cumsum([0, *(len(d) // 4 for d in rows)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(stops), pa.array(np.frombuffer(b"".join(rows), np.int32)))

    size = 0
    for d in done:
        rows.append(d)
        size += len(d) // 4
        if size >= IDS_AT_ONCE:
            yield passed()
            rows, size = [], 0
    if rows:
        yield passed()


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids of each text by the ranks at ``path``, each match of ``pattern`` by itself.

    ``path`` is a file that every executor has: a base64 token and its rank per line. Special tokens are not known.
    Work is one pass over the rows without a shuffle: a batch's new distinct matches become padded matrices of like
    lengths, in which every row merges its leftmost pair of least rank in each round. Encoded words stay in the
    worker up to a bounded number. Matches are first cut between bytes that no token holds side by side. Of a batch some
    texts are strings at once, and ids are passed on as soon as there are enough of them.

    Null and empty texts have no ids (an empty list). Repeated rows are encoded alike. Texts of any length are read in
    parts of whole matches; memory grows with the longest match. A column named ``out`` is replaced, other columns pass
    through. An empty table stays empty.
    """
    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        splitter = regex.compile(pattern)
        for batch in batches:
            yield from _lists(_encoded(each_text(batch), splitter, path))

    return docs.withColumn(out, to_ids(F.col(text)))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes of each list of ids. Null and empty lists give none; null and unknown ids give nothing."""
    @F.arrow_udf("binary")
    def to_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = _load(path)[0].tokens
        nothing = len(tokens) - 1
        for batch in batches:
            some = batch.flatten()
            lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(lengths, dtype=np.int64))
            first = 0
            while first < len(batch):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + IDS_AT_ONCE, "right")) - 1)
                last = min(last, len(batch))
                flat = some.slice(ends[first], ends[last] - ends[first]).fill_null(nothing).to_numpy(zero_copy_only=False)
                held = tokens.take(pa.array(np.where((flat >= 0) & (flat < nothing), flat, nothing)))
                # The bytes of all taken tokens lie one behind the other.
                stops = np.cumsum([0, *np.asarray(pc.binary_length(held))])
                data = memoryview(held.buffers()[2] or b"") if len(held) else b""
                at = stops[ends[first:last + 1] - ends[first]].tolist()
                yield pa.array([bytes(data[a:b]) for a, b in zip(at, at[1:])], pa.binary())
                first = last

    return encoded.withColumn(out, to_bytes(F.col(ids)))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs, path, public_tokenizers.PATTERN), path)
    digests = both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    # Only the digests are written, while texts and ids go to Python and back a few rows at a time.
    with setting(spark, *FEW_ROWS):
        return materialize(digests, "byte_bpe")
