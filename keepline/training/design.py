"""The encoded table of a cross-validation: written once, with what each fit learns from the other folds.

Statistics are taken per fold in one pass (counts, sums, quantile sketches). A fit that leaves out a
fold merges those of the others, so ten folds and the final fit cost one pass and not eleven.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    BIN_COLS, BOOLEAN_COLS, CATEGORICAL_COLS, KEY_COL, MONTHLY_BINS, NUMERIC_COLS, TOTAL_BINS,
)
from ..operators.cleaning import impute_total_from_monthly
from ..operators.features import (
    ltv, monthly_charges_squared, one_plus_year_customer, service_flags, total_charges_per_month,
)
from ..session import materialize
from .rounds import Batch, n_partitions, summed

#: Size of a quantile sketch: so many values are held exactly, the rank error beyond is below 0.1 %.
SKETCH = 4000
#: Quantile bins that mutual information and boosted trees use for a number.
MI_BINS, TREE_BINS = 10, 64
#: Levels of a category that become slots of their own; more are an error.
MOST_LEVELS = 1000
#: Rows of a written file, read by one task of a round.
ROWS_PER_TASK = 16_384
_SOURCE = {BIN_COLS[0]: ("MonthlyCharges", MONTHLY_BINS), BIN_COLS[1]: ("TotalCharges", TOTAL_BINS)}


@dataclass
class Learned:
    """What one fit learned from its own rows: fills, scales, bin edges, and the slots by information."""

    fills: np.ndarray
    modes: np.ndarray
    edges: dict[str, np.ndarray]
    mi_edges: list[np.ndarray]
    tree_edges: list[np.ndarray]
    n: int
    positives: int
    means: np.ndarray = field(default_factory=lambda: np.zeros(0))
    deviations: np.ndarray = field(default_factory=lambda: np.zeros(0))
    information: np.ndarray = field(default_factory=lambda: np.zeros(0))
    varying: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def best(self, k) -> np.ndarray:
        """The varying slots with the most information, in slot order; ties go to the first."""
        slots = np.flatnonzero(self.varying)
        if k == "all" or k >= len(slots):
            return slots
        return np.sort(slots[np.argsort(-self.information[slots], kind="stable")[:int(k)]])


@dataclass
class Shape:
    """Names of the raw slots and what each fit learned; fits 0 to n_folds - 1 leave a fold out, the last one none."""

    n_folds: int
    numbers: list[str]
    flags: list[str]
    levels: dict[str, list[str]]
    learned: list[Learned]

    @property
    def width(self) -> int:
        """Raw columns of a row."""
        return len(self.numbers) + len(self.flags) + len(self.levels)

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *BIN_COLS, *self.flags, *(f"{c}={v}" for c, vs in self.levels.items() for v in vs)]

    def slots(self, x: np.ndarray, of: Learned) -> np.ndarray:
        """Numbers with fills, bins, flags and one slot per level, not scaled."""
        n, m = len(self.numbers), len(self.flags)
        numbers = np.where(np.isnan(x[:, :n]), of.fills, x[:, :n])
        bins = [right_closed(x[:, self.numbers.index(_SOURCE[b][0])], of.edges[b]) for b in BIN_COLS]
        flags = np.where(np.isnan(x[:, n:n + m]), of.modes[:m], x[:, n:n + m])
        parts = [numbers, np.stack(bins, axis=1), flags]
        for i, c in enumerate(self.levels):
            own = np.where(np.isnan(x[:, n + m + i]), of.modes[m + i], x[:, n + m + i])
            parts.append(own[:, None] == np.arange(len(self.levels[c])))
        return np.concatenate(parts, axis=1, dtype=np.float64)

    def scaled(self, x: np.ndarray, of: Learned) -> np.ndarray:
        """Slots with numbers and bins at mean 0 and deviation 1."""
        out = self.slots(x, of)
        k = len(of.means)
        out[:, :k] = np.where(of.deviations > 0, (out[:, :k] - of.means) / np.where(of.deviations > 0, of.deviations, 1), 0)
        return out

    def picked(self, x: np.ndarray, of: Learned, pick: np.ndarray) -> np.ndarray:
        """``scaled(x, of)[:, pick]``, from the columns that it needs."""
        n, m, bins = len(self.numbers), len(self.flags), len(BIN_COLS)
        levels = [(i, v) for i, c in enumerate(self.levels) for v in range(len(self.levels[c]))]
        out = np.empty((len(x), len(pick)))
        for at, j in enumerate(pick):
            if n <= j < n + bins:
                source = _SOURCE[BIN_COLS[j - n]][0]
                own = right_closed(x[:, self.numbers.index(source)], of.edges[BIN_COLS[j - n]])
            else:
                i, v = (j, None) if j < n else (j - bins, None) if j < n + bins + m else levels[j - n - bins - m]
                i, missing = (i, of.fills[i]) if j < n else (i, of.modes[i - n]) if v is None else (n + m + i, of.modes[m + i])
                own = np.where(np.isnan(x[:, i]), missing, x[:, i])
                own = own if v is None else own == v
            if j < len(of.means):
                own = (own - of.means[j]) / of.deviations[j] if of.deviations[j] > 0 else 0.0
            out[:, at] = own
        return out

    def codes(self, x: np.ndarray, of: Learned) -> np.ndarray:
        """Slots as small whole numbers: the quantile bin of a number, the value of anything else."""
        out = self.slots(x, of)
        for j, edges in enumerate(of.tree_edges):
            out[:, j] = np.searchsorted(edges, out[:, j], side="left")
        out[:, len(self.numbers):len(self.numbers) + len(BIN_COLS)] += 1
        return out.astype(np.uint8)


@dataclass
class Design:
    """``rows``: row_id, fold, label, a hash of the key, and raw slots (``x``); ``parts`` is their number of partitions,
    ``count`` the number of rows."""

    rows: DataFrame
    shape: Shape
    parts: int
    count: int

    def encoded(self, left_out: int, k="all") -> DataFrame:
        """All rows as that fit sees them: key, fold, label, weights, ``features`` as a vector."""
        from pyspark.ml.functions import array_to_vector

        shape, of = self.shape, self.shape.learned[left_out]
        pick = of.best(k)

        @F.arrow_udf("array<double>")
        def features(x: pa.Array) -> pa.Array:
            raw = np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.float64)
            m = shape.scaled(raw.reshape(len(x), -1), of)[:, pick]
            return pa.ListArray.from_arrays(
                pa.array(np.arange(0, m.size + 1, max(1, m.shape[1]), dtype=np.int32)[:len(x) + 1]), pa.array(m.ravel()))

        pos, neg = max(of.positives, 1), max(of.n - of.positives, 1)
        balanced = F.when(F.col("label") == 1, of.n / (2.0 * pos)).otherwise(of.n / (2.0 * neg))
        return self.rows.select("row_id", "fold", "label", array_to_vector(features("x")).alias("features"),
                                F.lit(1.0).alias("w_none"), balanced.alias("w_balanced"))


def right_closed(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin of (a, b] with the lowest edge included and outer values in the outer bins; -1 for a missing value."""
    bins = np.clip(np.searchsorted(edges, x, side="left") - 1, 0, max(len(edges) - 2, 0))
    return np.where(np.isnan(x), -1, bins).astype(np.float64)


def _raw(df: DataFrame) -> tuple[DataFrame, list[str], list[str], list[str]]:
    """Columns that a row has by itself, as doubles and text."""
    flags = {**service_flags(), "onePlusYearCustomer": one_plus_year_customer()}
    numbers = {"ltv": ltv(), "TotalChargesPerMonth": total_charges_per_month(),
               "MonthlyCharges_squared": monthly_charges_squared()}
    num = [c for c in NUMERIC_COLS if c in df.columns or c in numbers]
    boo = [c for c in BOOLEAN_COLS if c in df.columns or c in flags]
    cat = [c for c in CATEGORICAL_COLS if c in df.columns]
    filled = impute_total_from_monthly(df).select(
        "fold", "label", F.col(KEY_COL).alias("row_id"),
        *[numbers.get(c, F.col(c)).cast("double").alias(c) for c in num],
        *[flags.get(c, F.col(c)).cast("double").alias(c) for c in boo], *[F.col(c).cast("string").alias(c) for c in cat])
    return filled, num, boo, cat


def _sketches(rows: DataFrame, numbers: list[str], n_folds: int) -> list[dict]:
    """Per fit: count, positives and quantile grid of every number, from one sketch per fold and number."""
    own = rows.groupBy("fold").agg(
        F.count("label").alias("n"), F.sum("label").alias("positives"),
        *[F.kll_sketch_agg_double(F.nanvl(c, F.lit(None).cast("double")), SKETCH).alias(c) for c in numbers])
    own = materialize(own, "sketches")
    sets = own.withColumn("set_", F.explode(F.sequence(F.lit(0), F.lit(n_folds)))).where("set_ <> fold")
    merged = sets.groupBy("set_").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"), *[
        F.kll_merge_agg_double(c).alias(c) for c in numbers])
    ranks = sorted({i / q for q in (2, MI_BINS, TREE_BINS, MONTHLY_BINS, TOTAL_BINS) for i in range(q + 1)})
    grid = F.array(*map(F.lit, ranks))
    found = merged.select("set_", "n", "positives", *[
        F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, grid)).alias(c) for c in numbers])
    out = []
    for r in found.orderBy("set_").collect():
        quantiles = {c: dict(zip(ranks, r[c])) if r[c] else None for c in numbers}
        out.append({"n": int(r["n"]), "positives": int(r["positives"] or 0), "q": quantiles})
    return out


def _edges(quantiles: dict | None, bins: int) -> np.ndarray:
    if quantiles is None:
        return np.array([-1.0, 1.0])
    edges = np.unique([quantiles[i / bins] for i in range(bins + 1)])
    return edges if len(edges) > 1 else np.array([edges[0] - 1, edges[0] + 1])


def _modes(rows: DataFrame, columns: list[str], n_folds: int) -> tuple[dict[str, list[str]], list[dict[str, str]]]:
    """(levels of each column in order, most frequent level per fit; ties go to the first)."""
    long = rows.select("fold", *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        ["fold"], columns, "feature", "level").where("level is not null")
    counts = long.groupBy("fold", "feature", "level").count()
    sizes = counts.groupBy("feature").agg(F.countDistinct("level").alias("n")).where(F.col("n") > MOST_LEVELS).collect()
    if sizes:
        raise ValueError(f"too many levels: {sizes[0]['feature']}")
    levels: dict[str, set] = {c: set() for c in columns}
    by_set: list[dict[str, dict]] = [{c: {} for c in columns} for _ in range(n_folds + 1)]
    for r in counts.collect():
        levels[r["feature"]].add(r["level"])
        for s in range(n_folds + 1):
            if s != r["fold"]:
                held = by_set[s][r["feature"]]
                held[r["level"]] = held.get(r["level"], 0) + r["count"]
    modes = [{c: min(h, key=lambda v, h=h: (-h[v], v)) if h else None for c, h in held.items()} for held in by_set]
    return {c: sorted(v) for c, v in levels.items()}, modes


def _contingency(rows: DataFrame, parts: int, shape: Shape) -> None:
    """Scales, information and varying slots of every fit, from one pass that counts levels by class."""
    width, n_numbers = 1 + max(MI_BINS, TOTAL_BINS), len(shape.numbers)
    n_slots, first_flag = len(shape.names), len(shape.numbers) + len(BIN_COLS)

    def work(batch: Batch, s: int) -> np.ndarray:
        own = shape.learned[s]
        used = batch.fold != s
        slots, y = shape.slots(batch.x[used], own), batch.y[used].astype(int)
        level = slots.copy()
        for j, edges in enumerate(own.mi_edges):
            level[:, j] = np.searchsorted(edges, slots[:, j], side="left")
        level[:, n_numbers:first_flag] += 1
        flat = (np.arange(n_slots) * width + np.clip(level, 0, width - 1).astype(int)) * 2 + y[:, None]
        counts = np.bincount(flat.ravel(), minlength=n_slots * width * 2).astype(np.float64)
        # Sums around the fill, which lies among the values.
        off = slots[:, :n_numbers] - own.fills
        return np.concatenate([counts, off.sum(axis=0), (off * off).sum(axis=0)])

    for s, total in summed(rows, work, list(range(shape.n_folds + 1)), parts=parts).items():
        own = shape.learned[s]
        counts = total[:n_slots * width * 2].reshape(n_slots, width, 2)
        off, squares = np.split(total[n_slots * width * 2:], 2)
        n = max(own.n, 1)
        bins = counts[n_numbers:first_flag].sum(axis=2)
        steps = np.arange(width) - 1.0
        bin_means = (bins * steps).sum(axis=1) / n
        bin_squares = (bins * steps**2).sum(axis=1) / n
        own.means = np.concatenate([own.fills + off / n, bin_means])
        own.deviations = np.sqrt(np.maximum(np.concatenate([squares / n - (off / n) ** 2, bin_squares - bin_means**2]), 0))
        own.information = _information(counts)
        own.varying = ((counts.sum(axis=2) > 0).sum(axis=1) > 1)
        own.varying[:first_flag] |= own.deviations > 1e-12


def _information(counts: np.ndarray) -> np.ndarray:
    """Mutual information in nats of each slot's table of levels by class."""
    p = counts / np.maximum(counts.sum(axis=(1, 2), keepdims=True), 1)
    independent = p.sum(axis=2, keepdims=True) * p.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log(p / independent), 0.0)
    return np.maximum(terms.sum(axis=(1, 2)), 0)


def fold_design(df: DataFrame, n_folds: int) -> Design:
    """Read a training table (cleaned features, ``label``, ``fold``) and learn for every left-out fold at once.

    Three passes whatever the number of folds: sketches and levels per fold, then the tables of levels by class. Numbers
    are filled with the median, flags and categories with the mode, charges are binned by quantiles; medians and edges
    come from sketches of ``SKETCH`` values, exact for as many rows. A level that a fit does not see among its own rows
    is a constant slot there and left out.
    """
    raw, numbers, flags, cats = _raw(df)
    raw = materialize(raw, "raw")
    found = _sketches(raw, numbers, n_folds)
    levels, modes = _modes(raw, [*flags, *cats], n_folds)
    missing = F.lit(float("nan"))
    index = [F.coalesce(F.nullif((F.array_position(F.array(*map(F.lit, levels[c] or [""])), F.col(c)) - 1).cast("double"),
                                 F.lit(-1.0)), missing) for c in cats]
    x = F.array(*[F.coalesce(F.col(c), missing) for c in [*numbers, *flags]], *index)
    n_rows = raw.count()
    rows = raw.select("row_id", F.col("fold").cast("int").alias("fold"), F.col("label").cast("double").alias("label"),
                      F.xxhash64(F.col("row_id").cast("string")).alias("hash"), x.alias("x"))
    rows = materialize(rows.where("label is not null").repartition(max(1, -(-n_rows // ROWS_PER_TASK)), "hash"), "design")
    learned = []
    for s, stats in enumerate(found):
        q = stats["q"]
        mode = [float(modes[s][c] or 0) for c in flags] + [
            float(levels[c].index(modes[s][c])) if modes[s][c] is not None else 0.0 for c in cats]
        learned.append(Learned(
            fills=np.array([q[c][0.5] if q[c] else 0.0 for c in numbers]), modes=np.array(mode),
            edges={b: _edges(q[c], bins) for b, (c, bins) in _SOURCE.items()},
            mi_edges=[_edges(q[c], MI_BINS)[1:-1] for c in numbers],
            tree_edges=[_edges(q[c], TREE_BINS)[1:-1] for c in numbers], n=stats["n"], positives=stats["positives"]))
    shape, parts = Shape(n_folds, numbers, flags, {c: levels[c] for c in cats}, learned), n_partitions(rows)
    _contingency(rows, parts, shape)
    return Design(rows, shape, parts, n_rows)
