"""Stages of the pipeline against brute force."""

import itertools
import re

import numpy as np

import corpus_pipeline
from keepline.llm import near_dedup

SMALL = "/root/testdata/sf0.001"


def words(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()


def test_near_duplicates_from_four_fifths_on(spark):
    """Pairs at 0.80 to 0.85 are linked by the stage, pairs below are not; op5 links from 0.85 on."""
    rng = np.random.default_rng(7)
    texts, shared = [], {}
    # Of 100 shingles, a changed tail of k words leaves 100 - k in common.
    for i, k in enumerate([3, 8, 9, 10, 11, 11, 12, 20]):
        base = [f"w{i}x{x}" for x in rng.integers(0, 10**9, 104)]
        texts += [" ".join(base), " ".join(base[:104 - k] + [f"new{i}y{j}" for j in range(k)])]
        shared[i] = (100 - k) / (100 + k)
    docs = spark.createDataFrame([(i, t, "en", None) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_first_copies(spark, docs, SMALL).collect()}
    assert kept == {2 * i for i in shared} | {2 * i + 1 for i, s in shared.items() if s < 0.8}
    assert {i for i, s in shared.items() if 0.8 <= s < 0.85} == {2, 3, 4, 5}
    own = {r["doc_id"] for r in near_dedup.near_duplicates(docs).where("kept").collect()}
    assert own == {2 * i for i in shared} | {2 * i + 1 for i, s in shared.items() if s < 0.85}


def test_bands_follow_the_bound():
    assert near_dedup.bands_of(near_dedup.PERCENT) == near_dedup.BANDS
    for percent in (50, 80, 85, 95):
        assert (1 - (percent / 100)**near_dedup.ROWS)**near_dedup.bands_of(percent) <= near_dedup.MISS
    shingles = near_dedup.shingle_set("some words that make a few shingles of their own")
    few, many = near_dedup.signature(shingles), near_dedup.signature(shingles, 44)
    assert list(few[0]) == list(many[0][:near_dedup.BANDS]) and len(many[0]) == 44


def test_near_duplicates_of_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b) and root[i] != root[j]:
            old, new = root[j], root[i]
            root = [new if x == old else x for x in root]
    least = {}
    for (d, _), x in zip(rows, root):
        least[x] = min(d, least.get(x, d))
    got = sorted(r["doc_id"] for r in corpus_pipeline.keep_first_copies(spark, docs, SMALL).collect())
    assert got == sorted(least.values())


def test_leaks_of_the_small_table(spark):
    """A document goes if ten words in a row, or a whole shorter item, stand in it."""
    def runs(w, n):
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}

    def tokens(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))

    items = [tokens(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = set().union(*(runs(w, min(10, len(w))) for w in items if w))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = {r["doc_id"] for r in docs.collect() if not any(
        runs(tokens(r["text"]), n) & windows for n in {len(x) for x in windows})}
    got = [r["doc_id"] for r in corpus_pipeline.drop_leaks(spark, docs, SMALL).collect()]
    assert set(got) == want and len(got) == len(want) < docs.count()


def test_pieces_of_the_small_table(spark):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for r in corpus_pipeline.to_pieces(spark, docs, SMALL).collect():
        assert r["ids"] == model.encode(r["text"] or "") and r["n_pieces"] == len(r["ids"])
        assert r["decoded"] == (r["text"] or "").replace("\u2581", " ")


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0 and set(docs.columns) <= set(out.columns), name
