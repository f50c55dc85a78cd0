"""op12_byte_bpe holds a part of a batch at once, in the Python helpers and on the way to them."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

from keepline.llm import byte_bpe

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def helper(monkeypatch, spark, build):
    """The function that the operator hands to Spark."""
    made = []
    arrow_udf = F.arrow_udf

    def kept(returns):
        def wrap(f):
            made.append(f)
            return arrow_udf(returns)(f)
        return wrap

    with monkeypatch.context() as m:
        m.setattr(byte_bpe.F, "arrow_udf", kept)
        build(spark.createDataFrame([("a", [1])], "text string, ids array<int>"))
    return made[0]


def test_helpers_pass_parts_of_a_batch_on(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "RUN_CHARS", 1 << 17)
    monkeypatch.setattr(byte_bpe, "IDS_AT_ONCE", 1 << 17)
    encode = helper(monkeypatch, spark, lambda d: byte_bpe.encode(d, PATH, public_tokenizers.PATTERN))
    decode = helper(monkeypatch, spark, lambda d: byte_bpe.decode(d, PATH))
    texts = [("one  two three\n" * 300)[i % 40:] for i in range(3_000)]
    texts[7], texts[2_000] = None, ""
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe._load(PATH)[0].ranks)
    expected = {t: library.encode_ordinary(t or "") for t in set(texts)}
    column = pa.array(texts)
    ids = list(encode(iter([column, column.slice(0, 3)])))
    assert [x for part in ids for x in part.to_pylist()] == [expected[t] for t in [*texts, *texts[:3]]]
    whole = pa.concat_arrays(ids[:-1])
    back = list(decode(iter([whole])))
    assert [x for part in back for x in part.to_pylist()] == [(t or "").encode() for t in texts]
    del ids, back
    for f, rows in ((encode, column), (decode, whole)):
        tracemalloc.start()
        sizes = [len(part) for part in f(iter([rows]))]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(sizes) == len(texts) and max(sizes) < len(texts) // 2
        assert peak < 16 << 20


def test_texts_of_the_query_travel_a_few_rows_at_a_time(spark, monkeypatch):
    name, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", [], byte_bpe.materialize
    before = spark.conf.get(name)
    monkeypatch.setattr(byte_bpe, "materialize", lambda *x: seen.append(int(spark.conf.get(name))) or write(*x))
    assert byte_bpe.op12_byte_bpe(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert seen and max(seen) <= 1000 and spark.conf.get(name) == before
