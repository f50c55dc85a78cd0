"""Whitening against an exact covariance and a plain eigensolver; the refinement on clustered eigenvalues."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepline.llm import whitening

SMALL = "/root/testdata/sf0.001"


def exact(vectors):
    """(distinct grid vectors, sums, covariance in fractions rounded once)."""
    x = sorted({tuple(math.floor(256 * float(c)) for c in v) for v in vectors})
    n, sums = len(x), [sum(c) for c in zip(*x)]
    z = [[n * c - s for c, s in zip(v, sums)] for v in x]
    d = len(sums)
    v = [[float(Fraction(sum(r[i] * r[j] for r in z), n**3)) for j in range(d)] for i in range(d)]
    return x, sums, np.array(v)


def check(rows, vectors, components=4):
    ids = [i for i, v in vectors]
    x, sums, v = exact([v for _, v in vectors])
    n = len(x)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    assert sorted((r["vec_id"], r["component"]) for r in rows) == sorted((i, c + 1) for i in ids for c in range(components))
    own = dict(vectors)
    signs = {}
    for r in rows:
        k, g = r["component"] - 1, [math.floor(256 * float(c)) for c in own[r["vec_id"]]]
        deviation = sum((n * c - s) ** 2 for c, s in zip(g, sums))
        assert r["n"] == n and r["deviation"] == (deviation if deviation < 2**63 else None)
        want = float(np.array([(n * c - s) / n for c, s in zip(g, sums)]) @ q[:, k] / math.sqrt(e[k]))
        sign = signs.setdefault(k, 1 if want * r["whitened"] >= 0 else -1) if abs(want) > 1e-3 else signs.get(k, 1)
        assert abs(sign * r["whitened"] - want) < 1e-7 * max(1, abs(want))
        assert abs(r["explained"] - e[k] / np.trace(v)) < 1e-9 and r["identity_error"] < 1e-9


def test_vectors_of_the_tables(spark):
    rows = whitening.op11_whitening(spark, SMALL).collect()
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(rows, [(i, v) for i, v in vectors if v is not None and None not in v and np.isfinite(v).all()])


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)
    return frame.withColumn("x", whitening.grid(F.col("embedding"))).withColumn("whitened", F.lit("own"))


def result(frame, model):
    out = whitening.whiten(frame, model).where("x is not null")
    return [{"vec_id": r["vec_id"], "component": i + 1, "n": model.n, "deviation": r["deviation"], "whitened": w,
             "explained": model.values[i] / model.trace, "identity_error": model.identity_error}
            for r in out.collect() for i, w in enumerate(r["whitened"])]


@pytest.mark.parametrize("scale,fan_in", [(1.0, 2), (3e4, 64), (1e12, 2)])
def test_awkward_vectors(spark, monkeypatch, scale, fan_in):
    """Repeated vectors, nulls, entries that are not finite; far from the origin; several rounds of merging."""
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    rng = np.random.default_rng(5)
    base = (rng.normal(size=(60, 6)) * [5, 4, 3, 2, 1, 1] + 40) * scale
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, base[0].tolist()) for i in range(50)]
    bad = [(900, None), (901, [math.nan] * 6), (902, [None] * 6), (903, [math.inf] + [0.0] * 5), (904, [])]
    frame = frame_of(spark, rows + bad)
    model = whitening.fit_whitening(frame)
    assert model.n == len({tuple(math.floor(256 * c) for c in v) for _, v in rows})
    if scale < 1e9:
        check(result(frame, model), rows)
    else:
        x, sums, v = exact([v for _, v in rows])
        assert model.sums == sums and abs(model.values[0] / np.linalg.eigvalsh(v)[-1] - 1) < 1e-12
        out = whitening.whiten(frame, model).where("vec_id < 3").collect()
        assert all(r["deviation"] is None for r in out) and model.identity_error < 1e-9
    assert whitening.whiten(frame, model).where("x is null and whitened is null").count() == 5


def test_parts_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rows = [(i, p, [1 << 33, -p], [0xFFFFFFFF, i]) for i in range(2) for p in range(20)]
    parts = spark.createDataFrame(rows, "row long, part long, high array<long>, low array<long>")
    for r in whitening._merged(parts, "parts").collect():
        total = [(h << 32) + lo for h, lo in zip(r["high"], r["low"])]
        assert total == [20 * ((1 << 65) + 0xFFFFFFFF), (-190 << 32) + 20 * r["row"]]


def test_many_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 5)) * [5, 4, 3, 2, 1])]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = frame_of(spark, rows)
        check(result(frame, whitening.fit_whitening(frame)), rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_few_vectors(spark):
    none = frame_of(spark, [(1, None)])
    model = whitening.fit_whitening(none)
    assert model.n == 0 and whitening.whiten(none, model).first()["whitened"] is None
    assert whitening.whiten(none.limit(0), model).count() == 0
    one = whitening.fit_whitening(frame_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    assert one.n == 1 and len(one.values) == 0 and one.identity_error is None
    line = frame_of(spark, [(i, [float(i), 2.0 * i]) for i in range(4)] + [(9, [1.0])])
    model = whitening.fit_whitening(line)
    assert model.n == 4 and len(model.values) == 1
    assert {r["vec_id"]: r["whitened"] is None for r in whitening.whiten(line, model).collect()}[9]


def jacobi(a):
    """Eigenvalues and vectors in extended precision by plane rotations."""
    a, q = a.astype(np.longdouble), np.eye(len(a), dtype=np.longdouble)
    for _ in range(40):
        for i in range(len(a)):
            for j in range(i + 1, len(a)):
                if a[i, j] == 0:
                    continue
                t = (a[j, j] - a[i, i]) / (2 * a[i, j])
                t = (1 if t >= 0 else -1) / (abs(t) + np.sqrt(1 + t * t))
                c = 1 / np.sqrt(1 + t * t)
                turn = np.eye(len(a), dtype=np.longdouble)
                turn[i, i] = turn[j, j] = c
                turn[i, j], turn[j, i] = t * c, -t * c
                a, q = turn.T @ a @ turn, q @ turn
    order = np.argsort(-np.diag(a))
    return np.diag(a)[order], q[:, order]


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 2, 1], [5, 5 - 1e-6, 5 - 2e-6, 2, 1, 0.5], [5, 5 - 1e-9, 4, 4 - 1e-8, 1, 1 - 1e-10], [3, 3, 3, 1, 1, 0],
    [1, 1e-3, 1e-5, 1e-6, 1e-7, 1e-9]])
def test_refinement_reaches_double_precision(values):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.eigen(a)
    want, y = jacobi(a)
    assert np.abs(e - want.astype(float)).max() < 4e-15 * max(values)
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-14
    assert np.abs(a @ x - x * e).max() < 1e-14 * max(values)
    for i in range(6):
        gap = min(abs(values[i] - v) for j, v in enumerate(values) if j != i)
        if gap > 1e-12:
            assert 1 - abs(float(x[:, i] @ y[:, i].astype(float))) < 1e-15 + (1e-15 * max(values) / gap) ** 2
            assert min(np.abs(x[:, i] - y[:, i]).max(), np.abs(x[:, i] + y[:, i]).max()) < 2e-15 + 1e-17 * max(values) / gap
