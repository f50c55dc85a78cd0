"""Chunks of a text and their runs, cut at once, against the words and runs one by one."""

import random

import public_tokenizers

from keepline.llm import pieces
from keepline.llm.pieces import SPACE, Vocabulary


def one_by_one(v, text):
    return [r for w in v.words(text) for r in v.runs(w)]


def test_chunks_and_runs_are_those_of_the_words():
    v = Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    texts = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \nb", "a\n b", "a\n\n  b\n", "\na", f"a{SPACE} b", f"{SPACE}a\n{SPACE}",
             "zzqx\tétoile 東京 x\r\ny", "\ud800 x", "a\n  b", " \n \n"]
    texts += ["".join(rng.choice(["a", "qz", "é", " ", " ", "\n", SPACE, "東", "the", "\t", "😀"]) for _ in range(rng.randrange(40)))
              for _ in range(3000)]
    for t in texts:
        assert v.runs_of(v.chunks(t))[0] == one_by_one(v, t), repr(t)
    chunks = [c for t in texts for c in v.chunks(t)]
    flat, ends = v.runs_of(chunks)
    assert [flat[i:j] for i, j in zip([0, *ends], ends)] == [v.runs_of([c])[0] for c in chunks]


def test_a_word_is_looked_at_once_however_often_it_occurs(monkeypatch):
    """Plain texts are split, not searched: the pattern of words is not used for them."""
    v = Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(v, "units", None)
    monkeypatch.setattr(v, "parts", None)
    assert v.chunks("one two\nthree") == ["one", "two", "\nthree"]


def test_all_words_are_hashed_at_once_as_spark_does(spark):
    words = ["", "a", "étoile", "東京", "😀 x", "word" * 30]
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    want = [r["h"] for r in frame.selectExpr("i", "xxhash64(w) as h").orderBy("i").collect()]
    assert pieces._hashes(words).view("int64").tolist() == want
    assert pieces._hashes([*words, "\ud800"]).tolist()[:-1] == pieces._hashes(words).tolist()
