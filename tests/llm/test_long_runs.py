"""Runs of more than 65,535 pieces."""

import public_tokenizers
import pytest

from keepline.llm import pieces


@pytest.mark.parametrize("held", [6_000_000, 0])
def test_runs_of_many_pieces_shift_no_others(spark, held):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["some common words here", "x" * 140_000, "other words, and a number 12345", "ab" * 70_000, "the last words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = pieces.decode(pieces.encode(docs, path, broadcast_words=held), path, out="back").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == model.encode(r["text"]) and r["back"] == r["text"]
    assert max(len(r["ids"]) for r in rows) > 65_535
