"""Operators on documents against brute force, on awkward texts."""

import hashlib
import itertools
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from keepline.llm import decontaminate, near_dedup, pieces, private_data, quality, repeats, token_counts

SMALL = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(rng.integers(0, 40)) for i in rng.integers(0, len(WORDS), n))


LONG = prose(9, 6000)
TEXTS = [
    None, "", "   \n ", "one", prose(1, 80), prose(1, 80), prose(1, 80) + " more", prose(2, 300),
    prose(2, 150) + " " + prose(3, 150), LONG, LONG + " tail", "ab " * 700, "Étude ▁ «x» 日本語 😀 á",
    "mail a.b@c.de_x@y.z or +1 (555) 010-9999, 4111 1111 1111 1111, 10.0.0.255 and 1.2.3.999",
    "<|endoftext|> is 'special'\tHERE\x0b12", "1 " * 4000, "x" * 9000, prose(5, 12)]


@pytest.fixture(scope="module")
def docs(spark):
    """Awkward texts, a repeated row, a null id, and columns named like results."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, TEXTS[7]), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name in ("key", "ids", "spans", "hits", "score", "n_tokens", "kept", "items", "base"):
        frame = frame.withColumn(name, F.lit("own"))
    return frame


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_text(rows, *columns):
    return {(r["doc_id"], r["text"]): tuple(r[c] for c in columns) for r in rows}


def words(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


def test_near_duplicates(docs, empty):
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == docs.count() and near_dedup.near_duplicates(empty).count() == 0
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = []
    for _, t in texts:
        w = words(t, r"[^\x20\x09-\x0D]+")
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = set()
    for i, (d, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if group[j] == group[i] and texts[j][0] is not None]
        root = min(ids) if ids else None
        want.add((d, len(sets[i]), root, d == root))
    assert {tuple(r) for r in rows} == want


def test_chains_and_blocks_lose_no_link(spark, monkeypatch):
    """Copies that drift apart step by step, in buckets larger than a block."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = prose(20, 400).split()
    texts = [" ".join(base[:3 * i] + [f"new{j}" for j in range(3 * i)] + base[6 * i:]) for i in range(14)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [near_dedup.shingle_set(t) for t in texts]
    near = [[100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in sets] for a in sets]
    root = list(range(14))
    for _ in range(14):
        root = [min(root[j] for j in range(14) if near[i][j]) for i in range(14)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert got == dict(enumerate(root)) and len(set(root)) < 14


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:2400], rng.integers(0, 2**63, 600).astype(np.uint64)]))
    x = near_dedup.signature(a)[1].view(np.uint64) ^ near_dedup.signature(b)[1].view(np.uint64)
    x = (x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)
    unequal = np.unpackbits(x.view(np.uint8)).sum() / (near_dedup.BANDS * near_dedup.ROWS)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(1 - unequal / 0.75 - true) < 0.15


def test_repeats(docs, empty):
    rows = repeats.cut_repeats(docs).collect()
    assert repeats.cut_repeats(empty).count() == 0 and len(rows) == docs.count()
    raw = [((r["doc_id"], r["text"]), (r["text"] or "").encode()) for r in docs.collect()]
    seen: dict[bytes, int] = {}
    for _, b in raw:
        for i in range(len(b) - 399):
            seen[b[i:i + 400]] = seen.get(b[i:i + 400], 0) + 1
    got = by_text(rows, "kept", "spans")
    for key, b in raw:
        mask = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                mask[i:i + 400] = b"\1" * 400
        kept, spans = got[key]
        assert bytes(kept) == bytes(x for x, m in zip(b, mask) if not m)
        assert sum(s["stop"] - s["start"] for s in spans) == sum(mask)


def test_segments_of_long_texts(monkeypatch):
    data = LONG.encode()
    whole = {s: p for a, b, p in repeats.phrases(data) for s in range(a, b)}
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    assert {s: p for a, b, p in repeats.phrases(data) for s in range(a, b)} == whole


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    for r in token_counts.token_counts(docs, path).collect():
        assert r["n_tokens"] == len(model.encode(r["text"] or "", add_special_tokens=False).ids)
    assert token_counts.token_counts(empty, path).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_of_other_models(docs, name):
    path = public_tokenizers.path(name)
    lengths, _, _ = token_counts._load(path)
    for r in token_counts.token_counts(docs, path).collect():
        assert r["n_tokens"] == (lengths([r["text"]])[0] if r["text"] else 0)


@pytest.mark.parametrize("held", [6_000_000, 5, 0])
def test_pieces(docs, empty, held):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    both = pieces.encode(docs, path, broadcast_words=held, back="again")
    rows = pieces.decode(both, path, out="back").collect()
    assert all(r["again"] == r["back"] for r in rows)
    assert len(rows) == docs.count() and pieces.encode(empty, path, broadcast_words=held).count() == 0
    for r in rows:
        assert r["ids"] == model.encode(r["text"] or "")
        assert r["back"] == (r["text"] or "").replace("▁", " ")


def test_viterbi_fold(spark):
    """Greatest sum over all segmentations, on a small table of pieces."""
    class Small(pieces.Vocabulary):
        def __init__(self):
            self.pieces = {p: (i, s) for i, (p, s) in enumerate(
                [("a", -3.0), ("b", -3.1), ("ab", -4.0), ("ba", -4.2), ("aba", -6.0), ("abab", -7.5)])}
            self.bytes, self.unknown, self.longest = {}, 99, 4

    v = Small()

    def best(w):
        if not w:
            return 0.0, []
        ways = [(best(w[k:]), w[:k]) for k in range(1, min(4, len(w)) + 1) if w[:k] in v.pieces or k == 1]
        return max((rest[0] + v.pieces.get(p, (99, -17.5))[1], [v.pieces.get(p, (99, 0))[0], *rest[1]]) for rest, p in ways)

    words_ = ["a", "abab", "ababa", "bbaab", "axb", "abaabab", "xyz"]
    frame = spark.createDataFrame([(w,) for w in words_], "word string")
    got = {r["word"]: r["ids"] for r in pieces.fold_viterbi(pieces.lattice(frame, v), v).collect()}
    score = lambda ids: sum({99: -17.5}.get(i, next((s for j, s in v.pieces.values() if j == i), 0)) for i in ids)
    for w in words_:
        assert abs(score(got[w]) - best(w)[0]) < 1e-9 and abs(score(pieces.path_long(w, v)) - best(w)[0]) < 1e-9


def plain_spans(text):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c.isdigit()]
            doubled = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
            if {"email": True, "ip": all(int(p) < 256 for p in re.findall("[0-9]+", m[0])),
                    "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                yield kind, m.start(), m.end()


def test_private_spans(spark, docs, empty):
    model = private_data.fit_spans(spark.read.parquet(f"{SMALL}/documents.parquet"))
    found = private_data.private_spans(docs, model)
    rows = found.withColumn("red", private_data.redact(F.col("text"), F.col("spans"))).collect()
    assert private_data.private_spans(empty, private_data.fit_spans(empty)).count() == 0
    for r in rows:
        base = [(s["kind"], s["start"], s["stop"]) for s in r["base"]]
        assert base == list(plain_spans(r["text"]))
        assert set(base) <= {(s["kind"], s["start"], s["stop"]) for s in r["spans"]}
        if r["text"] is not None:
            assert not list(plain_spans(r["red"]))
        if not r["spans"]:
            assert r["red"] == r["text"]


def test_quality_is_told_apart_on_rows_held_out(spark, empty):
    d = "/root/testdata/sf0.01"
    all_ = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = quality.op2_quality(spark, d).where("held_out").join(labels, "doc_id").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert quality.fit_quality(all_, labels.limit(0)) is None
    assert quality.fit_quality(empty, labels) is None
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "y")], "doc_id long, text string, score string")
    scores = quality.score_quality(odd, quality.fit_quality(all_, labels)).collect()
    assert scores[0]["score"] == scores[1]["score"] and 0 <= scores[0]["score"] <= 1
    assert {r["score"] for r in quality.score_quality(odd, None).collect()} == {0.5}


def test_prior_is_near_the_truth():
    rng = np.random.default_rng(2)
    pos, neg = rng.normal(2, 1, (3000, 1)), rng.normal(-2, 1, (900, 1))
    prior = quality.fit_scorer(pos[:1500], np.concatenate([pos[1500:], neg])).prior
    assert abs(prior - 1500 / 2400) < 0.08


@pytest.mark.parametrize("block", [250_000, 3])
def test_hits(spark, docs, empty, block):
    items = [(1, LONG[5000:5400]), (2, "one"), (3, None), (4, ""), (10, prose(2, 40)), (11, prose(2, 40)),
             (None, prose(5, 12)), (1, LONG[5000:5400]), (12, "the same words not here at all so no hit in any text")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.benchmark_hits(docs, bench, block_windows=block).collect()
    assert len(rows) == docs.count()
    assert decontaminate.benchmark_hits(empty, bench).count() == 0
    assert all(r["hits"] == [] for r in decontaminate.benchmark_hits(docs, bench.limit(0)).collect())
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    for r in rows:
        w, hit, ids = words(r["text"], pattern), set(), set()
        for item, text in items:
            k = words(text, pattern)
            for i in range(max(1, len(k) - 9) if k else 0):
                win = k[i:i + 10]
                for j in range(len(w) - len(win) + 1):
                    if w[j:j + len(win)] == win:
                        hit |= set(range(j, j + len(win)))
                        ids |= {str(item)} - {"None"}
        assert r["n_words"] == len(w) and r["items"] == sorted(ids)
        assert {p for h in r["hits"] for p in range(h["start"], h["stop"])} == hit


def test_digest_is_of_utf8():
    assert hashlib.sha256("é".encode()).hexdigest().startswith("4a99557e4033c3539de2eb65472017cad5f9557f7a0625a09f1c3f6e2ba69c4c")


def test_merge_fold(spark):
    """Merges by rank against a rescan of all neighbours, on a table where some become possible late."""
    class Small(pieces.Vocabulary):
        def __init__(self):
            self.pieces = {p: (i, -float(i)) for i, p in enumerate(["ca", "abc", "ab", "bc", "bcb", "a", "b", "aab"])}
            self.bytes, self.unknown, self.longest = {}, 99, 3

    v = Small()

    def rescan(word: str) -> list[int]:
        parts = list(word)
        while ways := [(-v.pieces[a + b][1], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in v.pieces]:
            i = min(ways)[1]
            parts[i:i + 2] = ["".join(parts[i:i + 2])]
        return [v.pieces[p][0] if p in v.pieces else 99 for p in parts]

    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abc", repeat=n)]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: r["ids"] for r in pieces.fold_merges(
        pieces.lattice(frame, v, **pieces.merge_lists(v)), v).collect()}
    assert got.keys() == set(words) and None in got.values()
    for w in words:
        assert pieces.merge_long(w, v) == rescan(w) and got[w] in (None, rescan(w))
    assert got["caab"] is not None and got["a" * 5] == [5] * 5
