"""Quality classifier by positive-unlabelled learning (non-negative unbiased risk)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import each_text, table

#: Most rows of each kind (trusted positives, unlabelled) that the fit reads.
SAMPLE_ROWS = 8000
HIDDEN = 16
EPOCHS = 400
#: Weight decay of the network.
DECAY = 0.01
#: Share of a standard error that is added to the estimated prior's ratios.
MARGIN = 0.3
_PUNCT = np.array([b for b in range(33, 127) if not chr(b).isalnum()])


def text_features(text: str) -> np.ndarray:
    """Form of a whole text: shares of characters, of repeated words and lines; no identities."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256).astype(float)
    n, words = max(len(raw), 1), text.split()
    w, lines = max(len(words), 1), [x for x in text.split("\n") if x.strip()]
    marks = counts[_PUNCT]
    shares = [
        counts[97:123].sum(), counts[65:91].sum(), counts[48:58].sum(), counts[32],
        counts[10], counts[:9].sum() + counts[127], counts[128:].sum(), marks.sum()]
    alike = sum(map(str.__eq__, words, words[1:]))
    return np.array([
        np.log1p(len(raw)), np.log1p(len(words)), float(not words), len(text) / w,
        len(set(words)) / w, len(set(lines)) / max(len(lines), 1), alike / w,
        len(lines) / w, sum(map(str.isupper, words)) / w, sum(map(str.isalpha, words)) / w,
        max(map(len, words), default=0) / n, np.sqrt((marks / n).max()),
        *np.sqrt(np.array(shares) / n), *np.sqrt(marks / n)])


N_FEATURES = len(text_features(""))


@dataclass
class Scorer:
    """A small network on standardised features; ``prior`` is the estimated share of positives."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(_forward(_standard(x, self.mean, self.scale), self.weights)[0])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6)


def _forward(x: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = weights
    h = np.tanh(x @ w1 + b1)
    return h @ w2 + b2[0], h


def _train(xp: np.ndarray, xu: np.ndarray, risk, seed: int = 7) -> list[np.ndarray]:
    """Minimise a risk whose gradient with respect to the outputs is ``risk(zp, zu)``."""
    rng = np.random.default_rng(seed)
    d = xp.shape[1]
    weights = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    x = np.concatenate([xp, xu])
    for step in range(1, EPOCHS + 1):
        z, h = _forward(x, weights)
        g = np.concatenate(risk(z[:len(xp)], z[len(xp):]))
        dh = np.outer(g, weights[2]) * (1 - h * h)
        grads = [x.T @ dh + DECAY * weights[0], dh.sum(0), h.T @ g + DECAY * weights[2],
                 np.array([g.sum()])]
        for i, grad in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.99 * v[i] + 0.01 * grad * grad
            weights[i] = weights[i] - 0.02 * (m[i] / (1 - 0.9 ** step)) / (
                np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return weights


def _logistic_risk(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (_sigmoid(zp) - 1) / len(zp), _sigmoid(zu) / len(zu)


def non_negative_risk(prior: float):
    """Gradient of pi R+(positives) + max(0, R-(unlabelled) - pi R-(positives)), logistic loss.

    While the second part is negative, only its reverse is followed, as the correction asks.
    """
    def risk(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sp, su = _sigmoid(zp), _sigmoid(zu)
        loss = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = -prior * sp / len(zp), su / len(zu)
        if loss < 0:
            return -gp, -gu
        return gp + prior * (sp - 1) / len(zp), gu

    return risk


def estimate_prior(sp: np.ndarray, su: np.ndarray) -> float:
    """Share of positives among the unlabelled from scores of held positives and unlabelled.

    Above any threshold the unlabelled hold at least ``prior`` times the positives' share. The
    smallest ratio over thresholds, with a margin for chance, is the estimate.
    """
    cuts = np.quantile(sp, np.linspace(0.02, 0.8, 79))
    fp = np.array([(sp >= c).mean() for c in cuts])
    fu = np.array([(su >= c).mean() for c in cuts])
    spread = np.sqrt(fu * (1 - fu) / len(su)) + np.sqrt(fp * (1 - fp) / len(sp))
    ratio = (fu + MARGIN * spread) / np.maximum(fp, 1e-9)
    return float(np.clip(ratio.min(), 0.02, 0.98))


def fit_scorer(positives: np.ndarray, unlabelled: np.ndarray) -> Scorer:
    both = np.concatenate([positives, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    xp, xu = _standard(positives, mean, scale), _standard(unlabelled, mean, scale)
    held = np.arange(len(xp)) % 3 == 0
    if held.all() or not held.any():
        prior = 0.5
    else:
        w = _train(xp[~held], xu, _logistic_risk)
        prior = estimate_prior(_forward(xp[held], w)[0], _forward(xu, w)[0])
    return Scorer(mean, scale, _train(xp, xu, non_negative_risk(prior)), prior)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels no fit may see; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def _features_of(rows: DataFrame, text: str) -> np.ndarray:
    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([text_features(t) for t in each_text(batch)], pa.list_(pa.float64()))

    got = [r["f"] for r in rows.select(features(F.col(text)).alias("f")).toLocalIterator()]
    return np.array(sorted(got)).reshape(-1, N_FEATURES)


def fit_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> Scorer | None:
    """Fit on at most ``sample_rows`` trusted positives and as many unlabelled documents.

    Both are the rows of smallest id hash that are not held out, so the choice does not depend
    on the order of reading. Only the sampled ids (bounded) are broadcast. None where there is no positive.
    """
    own = F.col(doc_id)
    order = [F.xxhash64(own), own]
    good = labels.where((F.col(label) == 1) & ~held_out(doc_id)).select(doc_id).distinct()
    good = good.orderBy(*order).limit(sample_rows)
    web = docs.where(~held_out(doc_id)).select(doc_id).orderBy(
        F.xxhash64(own, F.lit(1)), own).limit(sample_rows)
    picked = docs.select(own.alias("id_"), F.col(text).alias("text_"))

    def features(ids: DataFrame) -> np.ndarray:
        return _features_of(picked.join(F.broadcast(ids.select(own.alias("id_")).distinct()), "id_"), "text_")

    xp, xu = features(good), features(web)
    return fit_scorer(xp, xu) if len(xp) and len(xu) else None


def score_quality(docs: DataFrame, scorer: Scorer | None, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to each document.

    Null texts are scored as empty ones; equal texts get equal scores. Without a scorer every
    score is 0.5. Columns of these names are replaced, others pass through.
    """
    if scorer is None:
        scored = docs.withColumn("score", F.lit(0.5))
    else:
        @F.arrow_udf("double")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                x = np.array([text_features(t) for t in each_text(batch)]).reshape(-1, N_FEATURES)
                yield pa.array(scorer(x), pa.float64())

        scored = docs.withColumn("score", score(F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, scorer).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
