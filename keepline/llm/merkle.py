"""Merkle manifest of a table: ternary trees by group, and one octopus multiproof for each partition of leaves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import table

#: Nodes of a run that become one node above; levels that one shuffle builds.
RUN, TIER = 3, 4
#: Consecutive leaves that share one multiproof; such partitions that ask for a node in one row.
PART_LEAVES, ASKERS = 4096, 1024
#: The tree above all groups: no key of a group begins like it.
TOP = "^"
#: Powers of the run's length as far as a long goes.
POWERS = [RUN**i for i in range(40)]


def field(value: Column) -> Column:
    """A value with its length in bytes in front, ``-`` for null."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 in lowercase hex of some values of a row; integers count as decimals."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Written rows in that order over all partitions, with ``part_`` and, from 0, ``number_``.

    Ranges are cut by the whole order and the place a row is read at, so equal rows are split as well. Only one count per
    partition is accumulated, and broadcast.
    """
    rows = rows.withColumn("place_", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "place_").sortWithinPartitions(*order, "place_").drop("place_")
    rows = materialize(rows.withColumn("at_", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("part_", F.shiftright("at_", 33))
    counts = rows.groupBy("part_").agg(F.count(F.lit(1)).alias("n_")).orderBy("part_").collect()
    before, offsets = 0, []
    for r in counts:
        offsets.append((r["part_"], before - (r["part_"] << 33)))
        before += r["n_"]
    offsets = rows.sparkSession.createDataFrame(offsets, "part_ long, shift_ long")
    rows = rows.join(F.broadcast(offsets), "part_")
    return rows.withColumn("number_", F.col("at_") + F.col("shift_")).drop("at_", "shift_")


def _tier(nodes: DataFrame, level: int) -> DataFrame:
    """(tree, level, pos, count, node) of the next levels above (tree, pos, count, node), grouped once."""
    width = RUN**TIER
    run = F.sort_array(F.collect_list(F.struct("pos", "node")))
    rows = nodes.groupBy("tree", "count", F.expr(f"pos div {width}").alias("group_")).agg(run.alias("run_"))
    rows = rows.select("tree", "count", "group_", F.col("run_.node").alias("row_0"))

    def above(below: str) -> Column:
        ends = F.sequence(F.lit(0), F.expr(f"(size({below}) - 1) div {RUN}").cast("int"))
        return F.transform(ends, lambda j: F.sha2(F.array_join(F.slice(below, RUN * j + 1, F.lit(RUN)), ""), 256))

    def with_places(i: int) -> Column:
        count = F.expr(f"(count + {RUN**i - 1}) div {RUN**i}")
        first = F.col("group_") * RUN**(TIER - i)
        return F.transform(f"row_{i}", lambda node, j: F.struct(
            F.lit(level + i).alias("level"), (first + j).alias("pos"), count.alias("count"), node.alias("node")))

    for i in range(1, TIER + 1):
        rows = rows.withColumn(f"row_{i}", above(f"row_{i - 1}"))
    # A level is there as long as the one below has more than one node.
    made = [F.when(F.col("count") > RUN**(i - 1), with_places(i)) for i in range(1, TIER + 1)]
    return rows.select("tree", F.inline(F.flatten(F.array_compact(F.array(*made)))))


def _nodes(leaves: DataFrame) -> DataFrame:
    """All nodes of the trees above (tree, pos, count, node), with their level; leaves are level 0."""
    todo, level, parts = leaves, 0, [leaves.withColumn("level", F.lit(0))]
    while not (todo := todo.where("count > 1")).isEmpty():
        made = materialize(_tier(todo, level), "nodes")
        parts.append(made)
        level += TIER
        todo = made.where(F.col("level") == level).drop("level")
    return reduce(DataFrame.unionByName, parts)


def _missing(runs: DataFrame) -> DataFrame:
    """(part, tree, level, pos) of the nodes that runs of leaves (part, tree, low, high, count) do not give themselves.

    Of every level, the siblings of the run's ends: whatever lies between is known or follows from below.
    """
    powers = F.array(*(F.lit(p).cast("long") for p in POWERS))
    levels = F.filter(F.sequence(F.lit(0), F.lit(len(POWERS) - 1)), lambda i: F.get(powers, i) < F.col("count"))
    rows = runs.select("part", "tree", "low", "high", "count", F.explode(levels).alias("level"))
    rows = rows.withColumn("p", F.get(powers, F.col("level")))
    rows = rows.selectExpr("part", "tree", "level", "low div p as low", "high div p as high",
                           "(count + p - 1) div p as count")
    begin = F.col("low") - F.col("low") % RUN
    end = F.least(F.col("high") - F.col("high") % RUN + RUN - 1, F.col("count") - 1)
    none = F.array().cast("array<long>")
    ends = F.concat(F.when(begin < F.col("low"), F.sequence(begin, F.col("low") - 1)).otherwise(none),
                    F.when(F.col("high") < end, F.sequence(F.col("high") + 1, end)).otherwise(none))
    return rows.select("part", "tree", "level", F.explode(ends).alias("pos"))


def _hash(*digests: bytes) -> bytes:
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def _climb(tree: str, first: int, nodes: list[bytes], count: int, fetched: dict) -> tuple[list, bytes]:
    """Levels (first position, nodes) of consecutive leaves with the siblings of their ends, and the top node."""
    levels: list[tuple[int, list[bytes]]] = []
    while count > 1:
        level, last = len(levels), first + len(nodes) - 1
        begin, end = first - first % RUN, min(last - last % RUN + RUN - 1, count - 1)
        nodes = [*(fetched[tree, level, i] for i in range(begin, first)), *nodes,
                 *(fetched[tree, level, i] for i in range(last + 1, end + 1))]
        levels.append((begin, nodes))
        nodes = [_hash(*nodes[i:i + RUN]) for i in range(0, len(nodes), RUN)]
        first, count = begin // RUN, -(-count // RUN)
    return levels, nodes[0]


def _proofs(levels: list, first: int, n: int) -> list[tuple[bytes, bytes]]:
    """(siblings up to the top, how many left and right of each level) of n leaves; what paths share is joined once."""
    above, at = [(b"", b"")], 0
    for begin, nodes in reversed(levels):
        here = []
        for i in range(len(nodes)):
            run = i - i % RUN
            siblings = nodes[run:i] + nodes[i + 1:run + RUN]
            proof, places = above[(begin + i) // RUN - at]
            place = (i - run) * RUN + len(siblings) - (i - run)
            here.append((b"".join(siblings) + proof, bytes([place]) + places))
        above, at = here, begin
    return above[first - at:first - at + n]


def manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """Add ``subroot``, ``root``, ``proof`` and ``places`` to rows that hold a leaf digest (see ``leaf_digest``).

    Leaves of a group ascend by ``order`` (null first, equal ones by digest); runs of three become a node until one is
    left, the group's subroot. Subroots by group (null first, then by bytes) are the leaves of the tree above. ``proof``
    holds the sibling digests from the leaf up to the root as one string of hex digits, ``places`` a byte per level,
    three times those left of the node plus those right of it: ``fold_proof`` takes both.

    Leaves are numbered over ranges of (group, order, digest), so a group with most rows is spread evenly. Nodes are built
    four levels a shuffle. Each partition of consecutive leaves asks once for the least set of nodes that it can't
    derive (the siblings of its ends), rebuilds what its leaves share, and writes out their single proofs. Nothing but
    one count per partition reaches the driver.

    Nulls in any other column pass through; a null digest is an error. Repeated rows are leaves of their own. A group of
    one leaf is its own subroot, a table of one group has that subroot as root. Columns named like results are replaced.
    An empty table stays empty.
    """
    results = ["subroot", "root", "proof", "places"]
    columns = [c for c in rows.columns if c not in results]
    # A struct keeps names apart; keys begin with a mark, so null sorts first and equals itself.
    rows = rows.select(F.struct(*columns).alias("row_"), F.col(order).alias("order_"), F.col(leaf).alias("node"),
                       F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"))
    leaves = _numbered(rows, ["tree", "order_", "node"], "leaves").drop("order_")
    runs = materialize(leaves.groupBy("part_", "tree").agg(
        F.min("number_").alias("low"), F.count(F.lit(1)).alias("n")), "runs")
    groups = runs.groupBy("tree").agg(F.min("low").alias("first"), F.sum("n").alias("count"))
    groups = _numbered(groups, ["first"], "groups").withColumnRenamed("number_", "group_").drop("part_")
    n_groups = groups.count()
    # Joined by partition and group: no key has more rows than a partition.
    runs = materialize(runs.select("part_", "tree").join(groups, "tree"), "runs")
    leaves = leaves.join(runs, ["part_", "tree"]).select(
        "row_", "tree", "node", "count", "group_", (F.col("number_") - F.col("first")).alias("pos"), "number_",
        F.expr(f"number_ div {PART_LEAVES}").alias("part"))

    nodes = _nodes(leaves.select("tree", "pos", "count", "node"))
    subroots = nodes.where("count = 1").join(groups.drop("count"), "tree").select(
        F.lit(TOP).alias("tree"), F.col("group_").alias("pos"), F.lit(n_groups).cast("long").alias("count"), "node")
    nodes = nodes.unionByName(_nodes(materialize(subroots, "subroots")))

    held = leaves.groupBy("part", "tree").agg(
        F.min("pos").alias("low"), F.max("pos").alias("high"), F.first("count").alias("count"),
        F.first("group_").alias("group_"))
    held = materialize(held, "held")
    above = held.groupBy("part").agg(F.min("group_").alias("low"), F.max("group_").alias("high")).select(
        "part", F.lit(TOP).alias("tree"), "low", "high", F.lit(n_groups).cast("long").alias("count"))
    asked = _missing(held.drop("group_").unionByName(above))
    # Nodes near the root are asked for by all partitions: one row for many of them.
    at = ["tree", "level", "pos"]
    asked = asked.groupBy(*at, F.expr(f"part div {ASKERS}").alias("askers_")).agg(F.collect_list("part").alias("parts"))
    fetched = materialize(nodes.join(asked, at).select(F.explode("parts").alias("part"), *at, "node"), "fetched")

    schema = T.StructType([T.StructField("row_", leaves.schema["row_"].dataType), *(
        T.StructField(c, T.BinaryType() if c == "places" else T.StringType()) for c in results)])

    def prove(own: pa.Table, given: pa.Table) -> pa.Table:
        own = own.sort_by("number_")
        names, positions, counts, digests = (own[c].to_pylist() for c in ("tree", "pos", "count", "node"))
        digests = [d.encode() for d in digests]
        got = {(t, i, p): d.encode() for t, i, p, d in zip(*(given[c].to_pylist() for c in (*at, "node")))}
        starts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
        lists, tops = [], []
        for a, b in zip(starts, [*starts[1:], len(names)]):
            levels, top = _climb(names[a], positions[a], digests[a:b], counts[a], got)
            lists.append(_proofs(levels, positions[a], b - a))
            tops.append(top)
        first = own["group_"][0].as_py()
        levels, root = _climb(TOP, first, tops, n_groups, got)
        subroots, proofs, places = [], [], []
        for inner, top, (proof, place) in zip(lists, tops, _proofs(levels, first, len(tops))):
            subroots += [top.decode()] * len(inner)
            proofs += [(p + proof).decode() for p, _ in inner]
            places += [x + place for _, x in inner]
        return pa.table([own["row_"], pa.array(subroots, pa.string()), pa.array([root.decode()] * len(own), pa.string()),
                         pa.array(proofs, pa.string()), pa.array(places, pa.binary())], ["row_", *results])

    proven = leaves.select("part", "number_", "row_", "tree", "node", "pos", "count", "group_").groupBy("part").cogroup(
        fetched.groupBy("part")).applyInArrow(prove, schema)
    return proven.select("row_.*", *results)


@F.arrow_udf(T.StringType())
def fold_proof(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The root that a leaf digest, its proof and its places lead to; null where one of them is null."""
    for leaves, proofs, places in batches:
        roots: list[str | None] = []
        for leaf, proof, place in zip(leaves.to_pylist(), proofs.to_pylist(), places.to_pylist()):
            if leaf is None or proof is None or place is None:
                roots.append(None)
                continue
            node, siblings, at = leaf.encode(), proof.encode(), 0
            for p in place:
                left, right = divmod(p, RUN)
                middle, end = at + 64 * left, at + 64 * (left + right)
                node, at = _hash(siblings[at:middle], node, siblings[middle:end]), end
            roots.append(node.decode())
        yield pa.array(roots, pa.string())


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    whole = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    shorter = leaf_digest(*whole[:4], F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    leaves = docs.select("doc_id", "source", leaf_digest(*whole).alias("leaf"), F.when(tampered, shorter).alias("other"))
    proven = manifest(leaves)
    folded = fold_proof(F.coalesce("other", "leaf"), F.col("proof"), F.col("places"))
    return proven.withColumn("folded_root", folded).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


#: The same by recursion over levels: nodes upwards, then proofs and folded digests along every leaf's path.
OP13_SQL = """
with recursive numbers as (
  select *, concat_ws('', coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'),
      coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
      coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) as head,
    list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) as crc
  from documents),
digests as (
  select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    -- the last step of the checksum flips every bit, so an even one ends odd here
    case when crc % 2 = 1 then sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) end as other
  from numbers),
leaves as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by source) as n from digests),
inner_nodes as (
  select source, 0 as level, pos, n, leaf as node from leaves
  union all
  select source, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' order by pos))
  from inner_nodes where n > 1 group by source, level, pos // 3),
subroots as (
  select source, node as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n
  from inner_nodes where n = 1),
top_nodes as (
  select 0 as level, pos, n, subroot as node from subroots
  union all
  select level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' order by pos))
  from top_nodes where n > 1 group by level, pos // 3),
nodes as (
  select coalesce('=' || source, '') as tree, level, pos, n, node from inner_nodes
  union all select '^', level, pos, n, node from top_nodes),
sides as (
  select a.tree, a.level, a.pos, a.n, coalesce(string_agg(b.node, '' order by b.pos) filter (b.pos < a.pos), '') as before,
    coalesce(string_agg(b.node, '' order by b.pos) filter (b.pos > a.pos), '') as after
  from nodes a join nodes b on a.tree = b.tree and a.level = b.level and a.pos // 3 = b.pos // 3
  where a.n > 1 group by all),
paths as (
  select doc_id, leaf, source, coalesce('=' || source, '') as tree, 0 as level, pos, '' as proof,
    coalesce(other, leaf) as node, false as done from leaves
  union all
  select p.doc_id, p.leaf, p.source, case when s.tree is null then '^' else p.tree end,
    case when s.tree is null then 0 else p.level + 1 end, case when s.tree is null then t.pos else p.pos // 3 end,
    p.proof || coalesce(s.before || s.after, ''),
    case when s.tree is null then p.node else sha256(s.before || p.node || s.after) end, s.tree is null and p.tree = '^'
  from paths p left join sides s on s.tree = p.tree and s.level = p.level and s.pos = p.pos
  join subroots t on t.source is not distinct from p.source
  where not p.done)
select p.doc_id, p.leaf, t.subroot, r.node as root, sha256(p.proof) as proof_sha256, p.node as folded_root,
  p.node = r.node as verified
from paths p join subroots t on t.source is not distinct from p.source cross join (select node from top_nodes where n = 1) r
where p.done
"""
