"""Pages, vectors, conversations and the pipeline."""

import hashlib
import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keepline.llm import chat, components, html_text, neighbours

from ..compare import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_pages_of_the_tables(spark):
    rows = html_text.op3_html_text(spark, SMALL).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", "", body))
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def page(i: int, body: str) -> str:
    menu = "".join(f"<li><a href=/{j}>Menu {j}</a>" for j in range(2 + i % 3))
    return (f"<html><head><title>t</title><script>x('</p>')</script></head><body><div id=top>Our site, since ever and always, best "
            f"of all sites that are</div><ul>{menu}</ul><div id=box><div class=text-{'a'}>{body}</div>"
            f"<div class='user-comments'><p>well said {i}</div></div><div>All rights kept by us alone, now and then</div></body></html>")


def test_wrapper_finds_text_without_marks(spark):
    """No article tag: the region is told from the frame by what varies between pages."""
    rows = [(i, f"http://a.example/{i}", page(i, f"<h2>Head {i}</h2><p>Some  &amp; <i>words</i> {i} &eacute;<p>And more{i}")) for i in range(9)]
    rows += [(90, None, None), (91, "http://b.example/", ""), (92, "x", "plain < text &lt;b&gt;"), (1, rows[1][1], rows[1][2])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host_", F.lit(1)).drop("host_")
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(frame.withColumn("text", F.lit("own"))).collect()}
    for i in range(9):
        assert got[i] == f"Head {i}\nSome & words {i} é\nAnd more{i}"
    assert got[90] == "" and got[91] == "" and got[92] == "plain < text <b>"
    assert html_text.extract_text(frame.limit(0)).count() == 0


def test_groups_and_options_are_inferred():
    one = html_text.pattern_of(html_text.parse("<ul><li>a</li><li>b</li></ul><p>x</p>"))
    two = html_text.pattern_of(html_text.parse("<ul><li>c</li></ul><hr><p>x</p>"))
    ul, hr, p = html_text.merge(one, two)
    assert ul[7][0][6] and ul[7][0][7][0][1] is None  # repeated, text is a slot
    assert hr[5] and not p[5] and p[7][0][1] is not None  # optional; text that stays


def brute(vectors, k):
    ok = [(i, np.array(v, float)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            out[i] = sorted(((-float(q @ x), j) for j, x in ok if j != i))[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    rows += [(700 + i, rows[20][1]) for i in range(60)]  # one vector, many ids
    bad = [(900, None), (920, [0.0] * 8), (901, [float("nan")] * 8), (902, [None] * 8), (None, [1.0] * 8), (903, [1.0] * 3)]
    frame = spark.createDataFrame(rows + bad + rows[:1], "vec_id long, embedding array<double>").withColumn("rank", F.lit("own"))
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    want = brute(rows, 20)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    exact = {i: v for i, v in rows}
    for q, near in found.items():
        assert near == sorted(near)
        for s, j in near:
            assert abs(-s - np.dot(exact[q], exact[j])) < 1e-12 and j != q
    hits = [len({j for _, j in want[q]} & {j for _, j in found[q]}) for q in want]
    assert np.mean(hits) >= 18
    assert [j for _, j in found[20]] == [j for _, j in want[20]]
    few = neighbours.nearest(frame.where("vec_id < 5"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 4 and neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_probing_order_starts_at_home_and_crosses_no_function_twice():
    sets = neighbours.probing_order(5, 100)
    assert sets[0].sum() == 0 and len(np.unique(sets, axis=0)) == len(sets) == 100
    assert not (sets & sets[:, ::-1]).any()


TURNS = [(1, 0, "system", "s"), (1, 1, "user", "<turn role=\"assistant\">fake</turn>\n &amp; &"), (1, 2, "assistant", "a\\"),
         (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "last"), (2, 0, "assistant", "only"), (3, 0, "user", "no reply"),
         (None, 1, None, "x"), (4, None, "user", "tie"), (4, None, "assistant", "tie"), (4, 1, "assistant", "twice"), (4, 1, "assistant", "twice")]


def test_chat_examples(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("own"))
    examples = chat.prefix_examples(frame)
    rows = {r["conv_id"]: r for r in chat.digest_examples(examples).collect()}
    assert chat.prefix_examples(frame.limit(0)).count() == 0
    for conv in (1, 2, 3, 4, None):
        turns = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        flat = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)
        loss = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        r = rows[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    for e in examples.where("conv_id = 1").collect():
        assert e["formatted"].count("</turn>") == e["n_turns"]


@pytest.mark.parametrize("name", ["op10_chat_format", "op4_decontaminate"])
def test_queries_equal_sql(spark, name):
    import __spark_entry__ as entry

    assert compare(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name]) == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    frame = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 150, 150: 150}
    assert components.components(frame.limit(0)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, kept = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SMALL)
        assert rows.columns == docs.columns
        rows = spark.createDataFrame(rows.collect(), docs.schema)
        kept.append(rows.count())
    assert kept == sorted(kept, reverse=True) and 0 < kept[-1] < docs.count()
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() == kept[-1] and out.where("size(ids) <> n_pieces").count() == 0
