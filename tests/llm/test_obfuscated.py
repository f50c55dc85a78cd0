"""Personal data in other than plain forms."""

import numpy as np
from pyspark.sql import functions as F

from keepline.llm import private_data
from keepline.session import materialize


def test_obfuscated_forms_are_found(spark):
    """Other forms, as frequent in the fit as plain ones, are found; numbers of other shapes are left."""
    rng = np.random.default_rng(11)
    texts, other, junk = [], [], []
    for i in range(600):
        a, b, c, d = (int(x) for x in rng.integers(200, 999, 4))
        n = int(rng.integers(1000, 9999))
        forms = [f"write to user{a}@host{b}.org now", f"call +1 ({a}) {b}-{n} today", f"code {a}{b}{c}{d}{n}77{n} end",
                 f"write to user{a} [at] host{b} [dot] org now", f"call ({a}) {b}-{n} today"]
        k = i % 5
        texts.append(f"Some words here, then {forms[k]} and more words")
        if k > 2:
            value = forms[k].removeprefix("write to ").removeprefix("call ").removesuffix(" now").removesuffix(" today")
            other.append((i, texts[-1].index(value), texts[-1].index(value) + len(value), "email" if k == 3 else "phone"))
        elif k == 2:
            junk.append(i)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = private_data.fit_spans(docs)
    found = private_data.private_spans(docs, model).withColumn("red", private_data.redact(F.col("text"), F.col("spans")))
    got = {r["doc_id"]: r for r in found.collect()}
    hits = {k: [any((s["kind"], s["start"]) == (k, a) and s["stop"] >= b for s in got[i]["spans"])
                for i, a, b, kind in other if kind == k] for k in ("email", "phone")}
    assert np.mean(hits["email"]) > 0.9 and np.mean(hits["phone"]) > 0.9
    assert np.mean([got[i]["red"] == got[i]["text"] for i in junk]) > 0.9


def test_least_score_follows_the_masked_forms():
    assert private_data.least_score([(2.0, 50), (1.0, 50), (0.0, 0)]) == 1.0
    assert private_data.least_score([(0.0, 4), (1.0, 6), (2.0, 90)]) == 1.0
    assert private_data.least_score([(2.0, 0)]) is None


def test_every_document_is_fitted_on(spark):
    """Addresses that stand only in texts of great hash, behind thousands of others, have their threshold too."""
    calls = spark.range(2500).selectExpr("concat('call +1 (', id % 700 + 200, ') 555-', id + 1000, ' today, code ', id * 7919 + 100000) as text")
    hosts = spark.range(1000).selectExpr("concat('the host 10.', id % 200, '.', id % 150, '.', id % 100, ' answers ', id) as text")
    late = materialize(hosts.where(F.xxhash64("text") > 7_500_000_000_000_000_000), "late-hosts")
    docs = materialize(calls.union(late).union(late), "late-hosts")
    model = private_data.fit_spans(docs)
    assert model.least["ip"] is not None and model.least["phone"] is not None
    found = private_data.labelled_proposals(docs)
    assert found.where("kind = 'ip' and not masked").agg(F.sum("n")).first()[0] == late.count()


def test_stage_of_the_pipeline_fits_on_every_document(spark):
    from corpus_pipeline import hide_private

    calls = spark.range(2500).selectExpr("id as doc_id", "concat('call +1 (', id % 700 + 200, ') 555-', id + 1000, ' today, code ', id * 7919 + 100000) as text")
    hosts = spark.range(3000, 6000).selectExpr("id as doc_id", "concat('the host ', replace(concat('10.', id % 200, '.1.', id % 100), '.', if(id % 6 = 0, '[.]', '.')), ' answers ', id) as text")
    late = hosts.where(F.xxhash64("text") > 7_500_000_000_000_000_000)
    docs = materialize(calls.union(late), "late-hosts")
    out = [r["text"] for r in hide_private(spark, docs, "").collect() if r["text"].startswith("the host")]
    assert docs.where("text like '%[.]%'").count() > 30
    assert len(out) == docs.where("doc_id >= 3000").count() and np.mean(["[IP]" in t for t in out]) > 0.95
