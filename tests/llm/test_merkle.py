"""The manifest against plain recursion over lists, with partitions of few leaves, and against SQL."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from keepline.llm import merkle

from ..compare import compare, connect

SMALL = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """(top, siblings of each leaf level by level)."""
    proofs, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(own):
            run = at - at % 3
            proofs[i] += nodes[run:at] + nodes[at + 1:run + 3]
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        own = [at // 3 for at in own]
    return nodes[0], proofs


def plain(leaves):
    """{(source, doc_id, leaf): [(subroot, root, proof)]} of rows (source, doc_id, leaf)."""
    order = sorted({s for s, _, _ in leaves}, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted(((d is not None, d or 0, leaf) for x, d, leaf in leaves if x == s)) for s in order}
    inner = {s: climb([leaf for _, _, leaf in held[s]]) for s in order}
    root, upper = climb([inner[s][0] for s in order])
    out = {}
    for s, up in zip(order, upper):
        for (known, d, leaf), proof in zip(held[s], inner[s][1]):
            out.setdefault((s, d if known else None, leaf), []).append((inner[s][0], root, "".join(proof + up)))
    return out


def awkward_rows():
    rng = random.Random(2)
    rows = [("hot", i, h(str(i))) for i in range(250)]
    rows += [(f"s{rng.randrange(40)}", i, h(str(i))) for i in range(250, 330)]
    rows += [(None, 400, h("a")), (None, None, h("b")), ("", 401, h("c")), ("é", 402, h("d")), ("z\U0001f600", 403, h("e"))]
    return rows + [rows[5]] * 40 + [("hot", None, h("f")), ("hot", 7, h("again"))]


def frame_of(spark, rows):
    frame = spark.createDataFrame([(s, d, leaf) for s, d, leaf in rows], "source string, doc_id long, leaf string")
    return frame.repartition(7).withColumn("root", F.lit("own")).withColumn("pos", F.lit("own")).withColumn("node", F.lit(1))


@pytest.mark.parametrize("leaves,askers,n", [(5, 2, None), (64, 1024, None), (4096, 1024, None), (4, 2, 1), (4, 2, 82)])
def test_proofs_equal_plain_trees(spark, monkeypatch, leaves, askers, n):
    monkeypatch.setattr(merkle, "PART_LEAVES", leaves)
    monkeypatch.setattr(merkle, "ASKERS", askers)
    rows = awkward_rows()[:n]
    got = merkle.manifest(frame_of(spark, rows)).withColumn("folded", merkle.fold_proof("leaf", "proof", "places")).withColumn(
        "wrong", merkle.fold_proof(F.lit(h("x")), "proof", "places"))
    assert set(got.columns) == {"source", "doc_id", "leaf", "pos", "node", "subroot", "root", "proof", "places", "folded", "wrong"}
    found = {}
    for r in got.collect():
        assert r["pos"] == "own" and r["folded"] == r["root"] != r["wrong"]
        found.setdefault((r["source"], r["doc_id"], r["leaf"]), []).append((r["subroot"], r["root"], r["proof"]))
    want = plain(rows)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_empty_and_null(spark):
    frame = frame_of(spark, awkward_rows()[:3])
    assert merkle.manifest(frame.limit(0)).count() == 0
    nothing = F.lit(None).cast("string")
    assert frame.select(merkle.fold_proof(nothing, "leaf", F.lit(b""))).distinct().collect() == [(None,)]
    rows = spark.createDataFrame([(1, None, "é\n", None)], "doc_id long, source string, text string, lang string")
    digest = rows.select(merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("text"))).first()[0]
    assert digest == h("1:1", "-", "3:é\n")


def test_tampering_is_found(spark):
    """Exactly the documents with a line break and an even checksum fail."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = merkle.op13_merkle(spark, SMALL).collect()
    assert len(rows) == len(texts) and len({r["root"] for r in rows}) == 1
    for r in rows:
        broken = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (texts[r["doc_id"]] or "")
        assert r["verified"] is (not broken)


def test_sql(spark):
    assert compare(merkle.op13_merkle(spark, SMALL), connect(SMALL), merkle.OP13_SQL) == []
