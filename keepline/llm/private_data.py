"""Personal data: generators of candidate spans, boosted trees on their form and context."""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import table

KINDS = ("email", "ip", "card", "phone")
#: The plain forms. Loops are possessive and starts anchored where that changes no
#: match, so that long runs take linear time; a card's pattern admits whole runs of 13 to 19 digits.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High-recall generators of further candidates.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[\[(]at[\])])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\])[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?=[0-9])(?<![0-9])[0-9]{4}+(?:[\x20.-]{0,2}[0-9]{3,6}+){2,4}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])[(]?+[0-9](?:[\x20()./-]{0,2}[0-9]){8,14}+(?![0-9])",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_CUES = r"(?i)\b(?:tel|phone|call|mobile|fax|sms|card|visa|account|ip|host|mail|contact|write)\w*\W{0,8}$"
SPAN = "struct<kind: string, start: long, stop: long>"
#: Plain forms written otherwise: (pattern, replacement) one after the other, by kind.
MASKS = {
    "email": [[("@", " [at] "), (r"\.", " [dot] ")], [("@", "(at)"), (r"\.", "(dot)")], [("@", "[at]")]],
    "ip": [[(r"\.", "[.]")]],
    "card": [[(r"[\x20-]", ""), (r"^([0-9]{4})([0-9]{4})([0-9]{4})", "$1.$2.$3.")]],
    "phone": [[(r"^\+", "")], [(r"^\+[0-9]{1,3}[\x20.-]+", "")], [(r"^\+[0-9]{1,3}[\x20.-]+[(]?", "0")]],
}
#: Characters of context that a masked form keeps.
CONTEXT = 32
#: Trees, their depth, least bins of a feature, and the share of masked forms that a threshold must let through.
TREES, DEPTH, LEAST_BINS, RECALL = 12, 3, 32, 0.95
#: What a text has that may hold any proposal.
MAY_HOLD = "[0-9]|@|[\\[(]at[\\])]"
_BLOCK = 256


def _sums(lengths: Column) -> Column:
    """Running sums of an array, in blocks so that long arrays stay cheap."""
    none = F.array().cast("array<long>")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))
    own = F.transform(blocks, lambda block: F.aggregate(
        block, none, lambda acc, x: F.concat(acc, F.array(
            F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("long")) + x))))
    before = F.aggregate(own, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(
        acc, F.array(F.try_element_at(acc, F.lit(-1)) + F.try_element_at(x, F.lit(-1)))))
    return F.flatten(F.zip_with(
        own, F.slice(before, 1, F.size(own)), lambda x, o: F.transform(x, lambda v: v + o)))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (value, start, stop) in code points."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(values))
    both = F.zip_with(gaps, values, lambda g, v: F.struct(
        v.alias("value"), (F.char_length(g) + F.char_length(v)).cast("long").alias("n")))
    stops = _sums(F.transform(both, lambda x: x["n"]))
    found = F.zip_with(both, stops, lambda x, stop: F.struct(
        x["value"].alias("value"), (stop - F.char_length(x["value"])).alias("start"), stop.alias("stop")))
    empty = F.array().cast("array<struct<value: string, start: long, stop: long>>")
    return F.when(F.size(values) > 0, found).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + part(i)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    n = F.char_length(_digits(value))
    return {"email": F.lit(True), "ip": value.rlike("^" + r"\.".join([_PART] * 4) + "$"),
            "card": n.between(13, 19) & luhn(_digits(value)), "phone": n.between(9, 15)}[kind]


def base_spans(text: Column) -> Column:
    """The plain forms: array of (kind, start, stop), by kind as listed and then by start."""
    none = F.array().cast(f"array<{SPAN}>")
    may = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}

    def of(kind: str) -> Column:
        kept = F.filter(matches(text, BASE[kind]), lambda m: _holds(kind, m["value"]))
        spans = F.transform(kept, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"], m["stop"]))
        return F.when(may.get(kind, text.rlike("[0-9]")), spans.cast(f"array<{SPAN}>")).otherwise(none)

    return F.concat(*(of(k) for k in KINDS))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _features(code: int, value: Column, before: Column, after: Column) -> list[Column]:
    """Form and context, without the marks (a plus, an @) that make a form plain."""
    digits = _digits(value)
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, F.char_length)
    count = lambda rx: F.regexp_count(value, F.lit(rx))
    n = F.char_length(digits)
    flags = [
        F.when(n.between(13, 19), luhn(digits)).otherwise(F.lit(False)),
        value.rlike("[(]"), value.rlike("^" + r"(?:\.|\[\.\])".join([_PART] * 4) + "$"),
        value.rlike("^[0-9]+$"), before.rlike("[A-Za-z0-9=_]$"),
        after.rlike("^[A-Za-z0-9_]"), before.rlike(_CUES)]
    numbers = [
        F.lit(code), n, F.char_length(value), F.size(groups), F.coalesce(F.array_max(sizes), F.lit(0)),
        F.coalesce(F.array_min(sizes), F.lit(0)), F.coalesce(F.try_element_at(sizes, F.lit(-1)), F.lit(0)),
        count(r"\."), count("-"), count(r"\x20"), count("[A-Za-z]")]
    return [c.cast("double") for c in numbers + flags]


def candidates(text: Column, base: Column) -> Column:
    """All spans that the generators propose: (kind, start, stop, features, plain).

    ``plain`` tells whether the proposal meets a plain form of its kind; others are not labelled.
    """
    def of(code: int, kind: str) -> Column:
        def one(m: Column) -> Column:
            before = F.substring(text, F.greatest(m["start"] - 23, F.lit(1)).cast("int"),
                                 F.least(m["start"], F.lit(24)).cast("int"))
            after = F.substring(text, (m["stop"] + 1).cast("int"), F.lit(4))
            plain = F.exists(base, lambda b: (b["kind"] == kind) & (b["start"] <= m["stop"] - 1)
                             & (m["start"] < b["stop"]))
            return F.struct(
                F.lit(kind).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop"),
                F.array(*_features(code, m["value"], before, after)).alias("features"), plain.alias("plain"))

        return F.transform(matches(text, LOOSE[kind]), one)

    return F.concat(*(of(i, k) for i, k in enumerate(KINDS)))


def masked(text: Column, base: Column) -> Column:
    """Plain forms in their context, written as MASKS says: array of (text, the span in it)."""
    def one(span: Column, kind: str, steps: list[tuple[str, str]]) -> Column:
        before = _between(text, F.greatest(span["start"] - CONTEXT, F.lit(0)), span["start"])
        after = _between(text, span["stop"], span["stop"] + CONTEXT)
        plain = value = _between(text, span["start"], span["stop"])
        for pattern, other in steps:
            value = F.regexp_replace(value, pattern, other)
        start = F.char_length(before).cast("long")
        at = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.char_length(value)).alias("stop"))
        return F.when(value != plain, F.struct(F.concat(before, value, after).alias("text"), at.cast(SPAN).alias("span")))

    def all_of(kind: str, steps: list[tuple[str, str]]) -> Column:
        return F.transform(_of_kind(base, kind), lambda s: one(s, kind, steps))

    lists = [all_of(kind, steps) for kind, ways in MASKS.items() for steps in ways]
    return F.filter(F.concat(*lists), lambda x: x.isNotNull())


def least_score(rows: list[tuple[float, float]], recall: float = RECALL) -> float | None:
    """The greatest score that lets this share of the masked forms through, from (score, masked forms) of one kind.

    Unlabelled proposals may be of either sort, so they are not counted. None if no form is masked.
    """
    total, above = sum(m for _, m in rows), 0.0
    for s, m in sorted(rows, reverse=True):
        above += m
        if total and above >= recall * total:
            return s
    return None


@dataclass
class SpanModel:
    """Fitted trees as nested (feature, threshold, left, right) or leaf values, with their weights, and the least
    score by kind (None: no candidate of the kind is taken)."""

    trees: list
    weights: list[float]
    least: dict[str, float | None]

    def score(self, features: Column) -> Column:
        def branch(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            i, cut, left, right = node
            return F.when(features[i] <= cut, branch(left)).otherwise(branch(right))

        return sum((F.lit(w) * branch(t) for w, t in zip(self.weights, self.trees)), F.lit(0.0))


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    split = node.split()
    return split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild())


def labelled_proposals(docs: DataFrame, text: str = "text") -> DataFrame:
    """All proposals of every distinct text, plain ones also as their masked forms: half, kind, label, masked, f, n.

    Equal ones are one row, ``n`` tells how many they are. ``half`` is the parity of the text's hash.
    """
    body = F.col(text)
    rows = docs.where(body.rlike(MAY_HOLD)).select(body.alias("text"), F.xxhash64(body).alias("h"))
    rows = rows.withColumn("base", base_spans(F.col("text")))

    def listed(proposals: Column, is_masked: bool) -> Column:
        return F.transform(proposals, lambda c: F.struct(
            c["kind"].alias("kind"), c["plain"].cast("double").alias("label"), F.lit(is_masked).alias("masked"), c["features"].alias("f")))

    written = F.flatten(F.transform(masked(F.col("text"), F.col("base")), lambda m: listed(
        F.filter(candidates(m["text"], F.array(m["span"])), lambda c: c["plain"]), True)))
    rows = rows.select("h", F.concat(listed(candidates(F.col("text"), F.col("base")), False), written).alias("all_"))
    # Copies are left out after their proposals were found, so no text is shuffled.
    rows = rows.dropDuplicates(["h"])
    return rows.select(F.pmod("h", F.lit(2)).alias("half"), F.inline("all_")).groupBy(
        "half", "kind", "label", "masked", "f").agg(F.count("*").cast("double").alias("n"))


def fit_spans(docs: DataFrame, text: str = "text") -> SpanModel | None:
    """Fit on the proposals in all documents, each distinct text once.

    Proposals that meet a plain form are positive, as are those that meet a masked one; all others are unlabelled: the
    trees tell the two apart, and no feature tells plain from masked. Half of the documents fit the trees, the other
    half sets the least score of each kind (``least_score``). None if there is nothing to tell apart.

    Trees are grown on the distinct proposals with their numbers as weights. The trees look for their cut points in
    the square of ``maxBins`` rows at least, so that many bins make them look in all rows.
    """
    found = labelled_proposals(docs, text)
    found = materialize(found.sortWithinPartitions(*found.columns), "proposals")
    fit = found.where("half = 0").select("label", "n", array_to_vector("f").alias("features"))
    n_rows, n_labels = fit.agg(F.count("*"), F.countDistinct("label")).first()
    if n_labels < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3, weightCol="n",
                          maxBins=max(LEAST_BINS, isqrt(n_rows) + 1)).fit(fit)
    trees = [_tree(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t.rootNode()) for t in model.trees]
    spans = SpanModel(trees, list(model.treeWeights), dict.fromkeys(KINDS))
    # Masked forms of each distinct held-out score (few, as leaves are few).
    held = found.where("half = 1").groupBy("kind", spans.score(F.col("f")).alias("s")).agg(
        F.sum(F.col("n") * F.col("masked").cast("double")).alias("masked"))
    by_kind: dict[str, list] = {}
    for r in held.collect():
        by_kind.setdefault(r["kind"], []).append((r["s"], r["masked"]))
    spans.least |= {kind: least_score(scores) for kind, scores in by_kind.items()}
    return spans


def _added(text: Column, base: Column, model: SpanModel) -> Column:
    """Selected proposals that touch no plain form; of overlapping ones the best, then the first."""
    scored = F.transform(candidates(text, base), lambda c: F.struct(
        c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"), c["plain"].alias("plain"),
        model.score(c["features"]).alias("score")))

    def taken(c: Column) -> Column:
        above = F.lit(False)
        for kind, least in model.least.items():
            if least is not None:
                above = above | ((c["kind"] == kind) & (c["score"] >= least))
        return above & ~c["plain"] & ~F.exists(
            base, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))

    rows = F.array_sort(F.filter(scored, taken))
    kind = "array<struct<start: long, stop: long, kind: string, plain: boolean, score: double>>"

    def step(acc: Column, c: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        clear = last.isNull() | (c["start"] >= last["stop"])
        better = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(c))
        return F.when(clear, F.concat(acc, F.array(c))).when(c["score"] > last["score"], better).otherwise(acc)

    kept = F.aggregate(rows, F.array().cast(kind), step)
    return F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop")))


def private_spans(docs: DataFrame, model: SpanModel | None, text: str = "text") -> DataFrame:
    """Add ``base`` (plain forms) and ``spans`` (with the model's additions): arrays of (kind, start, stop).

    Only built-in functions, no shuffle: trees become conditional expressions over each proposal. Null and empty
    texts have no spans. Columns of these names are replaced, others pass through; repeated rows are treated alike.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("base", base_spans(body))
    if model is None:
        return out.withColumn("spans", F.col("base"))
    may = body.rlike(MAY_HOLD)
    none = F.array().cast(f"array<{SPAN}>")
    added = F.when(may, _added(body, F.col("base"), model).cast(f"array<{SPAN}>")).otherwise(none)
    out = out.withColumn("added_", added)
    by_kind = [F.array_sort(_of_kind(F.concat("base", "added_"), k)) for k in KINDS]
    return out.withColumn("spans", F.concat(*by_kind)).drop("added_")


def redact(text: Column, spans: Column) -> Column:
    """Text with each span (overlapping ones together) replaced by its kind in brackets."""
    rows = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    kind = "array<struct<start: long, stop: long, kind: string>>"

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"),
                          last["kind"].alias("kind"))
        return F.when(last.isNull() | (s["start"] >= last["stop"]), F.concat(acc, F.array(s))).otherwise(
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined)))

    merged = F.aggregate(rows, F.array().cast(kind), step)
    parts = F.transform(merged, lambda s, i: F.concat(
        _between(text, F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(merged, i - 1)["stop"]), s["start"]),
        F.lit("["), F.upper(s["kind"]), F.lit("]")))
    tail = F.substring(text, (F.try_element_at(merged, F.lit(-1))["stop"] + 1).cast("int"), F.char_length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(text)


def _between(text: Column, start: Column, stop: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), (stop - start).cast("int"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private_spans(docs, fit_spans(docs))
    counts = [F.size(_of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
