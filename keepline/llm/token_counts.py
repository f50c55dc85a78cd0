"""Token counts of whole texts: batch encoding in Arrow functions that returns lengths only."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_batches, table, texts_of

#: White space that both the splitter below and every tokenizer's patterns take as such.
SPACES = "\t\n\v\f\r"
BATCH_CHARS = 1 << 20
CACHED_UNITS = 400_000
_loaded: dict[str, tuple] = {}


def _units_are_words(path: str) -> bool:
    """Whether white space always ends a token and yields none itself.

    True for a splitter that keeps only matches of patterns without white space and for
    normalizers that treat each character by itself (or compose it with marks, which never
    join across a space). Then a text's count is the sum over its words.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    splits = [p for p in parts if p["type"] == "Split"]
    return (
        all(n["type"] in ("NFC", "Lowercase") or n.get("pattern") == {"Regex": "\\s+"} for n in steps)
        and len(splits) == 1 and splits[0]["behavior"] == "Removed" and splits[0]["invert"]
        and "[^\\s" in splits[0]["pattern"].get("Regex", "")
        and not any(c in t["content"] for t in spec["added_tokens"] for c in " " + SPACES)
    )


def _load(path: str) -> tuple:
    """(lengths of a list of strings, whether words may be counted apart, counts of words)."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)],
                             False, {})
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            _loaded[path] = (
                lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)],
                _units_are_words(path), {})
    return _loaded[path]


def _words(text: str) -> list[str]:
    for c in SPACES:
        text = text.replace(c, " ")
    return text.split(" ")


def _lengths(texts: list[str], path: str) -> Iterator[int]:
    lengths, by_word, known = _load(path)
    for run in byte_batches(texts, BATCH_CHARS):
        if not by_word:
            yield from lengths(run)
            continue
        split = [_words(t) for t in run]
        if len(known) > CACHED_UNITS:
            known.clear()
        new = list(set().union(*split) - known.keys())
        for words in byte_batches(new, BATCH_CHARS):
            known.update(zip(words, lengths(words)))
        for words in split:
            yield sum(map(known.__getitem__, words))


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each text, without begin, end or added special tokens.

    ``path`` is a tokenizer file that every executor has: ``.json`` for tokenizers, ``.model``
    for sentencepiece. Special strings in a text are taken as the library takes them by
    default; nothing is cut or padded. Work runs in batches of about equal size in bytes. Where
    white space is a safe boundary, long texts are split there and a word that was counted
    before is not encoded again (a bounded store per worker, emptied when full).

    Null and empty texts have 0 tokens. Repeated rows are counted each. A column named ``out``
    is replaced; other columns pass through. An empty table stays empty.
    """
    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_lengths(texts_of(batch), path), pa.int64())

    return docs.withColumn(out, count(F.col(text)))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))
