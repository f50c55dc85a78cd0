"""Byte-level BPE against the tiktoken library, on the tables and on awkward texts."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from keepline.llm import byte_bpe

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RNG = random.Random(4)
TEXTS = [
    None, "", " ", "one", "don't  stop\n\n now", "x" * 70_000, "ab" * 3_000, "aaab" * 300 + "b" * 77, " " * 5_000,
    "日本語" * 400, "é" * 200, "<|endoftext|> is 'special'\tHERE\x0b12\u0085", "\U0001f600\U0001f468‍\U0001f469 á\x00",
    "".join(chr(RNG.randrange(32, 0x3000)) for _ in range(3_000)),
    "".join(RNG.choice("etaoins") for _ in range(5_000)), "".join(RNG.choice("ab") for _ in range(4_000))]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.Merges(PATH).ranks,
                             special_tokens={})


def test_texts_of_the_tables(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = byte_bpe.op12_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_awkward_texts(spark, library):
    frame = spark.createDataFrame([*enumerate(TEXTS), (3, TEXTS[3]), (None, "a b")], "doc_id long, text string")
    frame = frame.repartition(3).withColumn("ids", F.lit("own")).withColumn("key", F.lit("own"))
    both = byte_bpe.decode(byte_bpe.encode(frame, PATH, public_tokenizers.PATTERN), PATH)
    rows = both.collect()
    assert len(rows) == len(TEXTS) + 2 and both.columns == ["doc_id", "text", "ids", "key", "decoded"]
    for r in rows:
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and r["key"] == "own"
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert byte_bpe.encode(frame.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_ids_that_are_no_tokens(spark):
    frame = spark.createDataFrame([(None,), ([],), ([None, -1, 10**6, 0],)], "ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_bpe.decode(frame, PATH).collect()] == [b"", b"", byte_bpe.Merges(PATH).tokens[0].as_py()]


def test_long_texts_come_in_parts(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "RUN_CHARS", 500)
    monkeypatch.setattr(byte_bpe, "RUN_MATCHES", 7)
    texts = [t or "" for t in TEXTS]
    got = byte_bpe._encoded(texts, regex.compile(public_tokenizers.PATTERN), PATH)
    for t, ids in zip(texts, got):
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == library.encode_ordinary(t)


def test_merges_in_rounds_equal_single_merges(tmp_path):
    """Ranks drawn at random, where a merge may make a pair of smaller rank: one round never jumps ahead."""
    for seed in range(30):
        rng = random.Random(seed)
        tokens = [bytes([b]) for b in range(256)]
        more = {bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(40)}
        more = sorted(more)
        rng.shuffle(more)
        ranks = {t: i for i, t in enumerate(tokens + more)}
        file = tmp_path / f"{seed}.tiktoken"
        file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
        merges = byte_bpe.Merges(str(file))
        for _ in range(40):
            word = bytes(rng.choices(b"abc", k=rng.randint(1, 24)))
            ids, counts = merges.encode_words([word])
            assert ids.tolist() == _plain(word, ranks) and counts.tolist() == [len(ids)]


def _plain(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]
