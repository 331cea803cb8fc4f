"""A Merkle manifest of a table, with every row's proof, by a butterfly exchange.

The leaves of a tree lie in order and are cut into aligned blocks of ``FANOUT ** HEIGHT``. A task
hashes a block up to its top and knows the lower proof of each of its leaves. Then the blocks
exchange tops: in round r each block asks one block of each sibling subtree of ``FANOUT ** r``
blocks for that subtree's top, and hashes the parent itself. All blocks below a parent work it out
redundantly, so after the last round each of them holds the root and its own upper proof; nothing
is handed down. Only one row per block takes part in the rounds, and a subtree that is asked by
many blocks shares the requests out among its own.

A tree of n > 1 nodes replaces every ``FANOUT`` consecutive ones (the last run may be shorter, even
one) by the hash of their digests, as hexadecimal text, until one is left; a single node is its own
top. The rows of a source make one tree, the tops of the sources another.

Defined results: a NULL column value is hashed as a mark of its own; NULL sources form one source,
the first; rows with equal ids are ordered by digest (a NULL id first), so repeated rows have equal
leaves and neighbouring places; an empty text is a value of no bytes; an empty table gives no rows.
Input columns named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.llm.scratch import aside, kept
from foldcast.operators.joins import lookup_join, sized_join

FANOUT = 3
#: Levels that one task hashes: a block has FANOUT ** HEIGHT leaves.
HEIGHT = 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = "array<struct<before: string, after: string>>"


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: each value with its byte count, so that no two rows run together."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, digest, lambda node, step: F.sha2(
        F.concat(step["before"], node, step["after"]), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a proof, level by level, each level from left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def numbered(rows: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (stored) with their place ``_pos`` in their ``tree`` and the tree's number of nodes.

    The rows are range-sorted over all trees, so one large tree lies in many ranges; a range's
    start is the sum of the earlier ranges of that tree. That table has one row per range and tree
    that meet.
    """
    placed = kept(rows.repartitionByRange(tree, *order).withColumn("_range", F.spark_partition_id()),
                  name)
    met = placed.groupBy(tree, "_range").agg(F.count(F.lit(1)).alias("_here"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = met.select(tree, "_range", F.sum("_here").over(whole).alias("_nodes"),
                        F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range", tree).orderBy(*order)) - 1
    found = lookup_join(placed.withColumn("_place", place), starts, [tree, "_range"], order)
    return found.withColumn("_pos", (F.col("_start") + F.col("_place")).cast("long")).drop(
        "_range", "_start", "_place")


def levels(nodes: int) -> int:
    """Levels above the leaves of a tree."""
    height = 0
    while FANOUT ** height < nodes:
        height += 1
    return height


def hashed(digests: list[str], height: int) -> tuple[list[list[str]], str]:
    """The nodes of each level below the top of a block, and its top."""
    floors = []
    for _ in range(height):
        floors.append(digests)
        digests = [hashlib.sha256("".join(digests[i:i + FANOUT]).encode()).hexdigest()
                   for i in range(0, len(digests), FANOUT)]
    return floors, digests[0]


def _block(table: pa.Table, height: int) -> tuple[pa.Table, list[list[str]], str]:
    table = table.sort_by("_pos")
    height = min(height, levels(table.column("_nodes")[0].as_py()))
    floors, top = hashed(table.column("_digest").to_pylist(), height)
    return table, floors, top


def _tops(table: pa.Table, height: int) -> pa.Table:
    """One row per block: its top."""
    table, _, top = _block(table, height)
    blocks = -(-table.column("_nodes")[0].as_py() // FANOUT ** height)
    return pa.table({
        "_tree": table.column("_tree")[:1], "_block": table.column("_block")[:1],
        "_blocks": pa.array([blocks], pa.int64()), "_top": [top]})


def _lower(table: pa.Table, height: int) -> pa.Table:
    """Every leaf of a block with the steps of its proof up to the block's top."""
    table, floors, _ = _block(table, height)
    n, before, after, where, base = table.num_rows, [], [], [], 0
    for level, nodes in enumerate(floors):
        for i in range(len(nodes)):
            first = i - i % FANOUT
            before.append("".join(nodes[first:i]))
            after.append("".join(nodes[i + 1:first + FANOUT]))
        where.append(base + np.arange(n) // FANOUT ** level)
        base += len(nodes)
    steps = pa.StructArray.from_arrays(
        [pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
    at = np.stack(where, 1).ravel() if where else np.empty(0, np.int64)
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1) * len(floors), pa.int32()), steps.take(pa.array(at)))
    return table.drop_columns(["_nodes"]).append_column("_lower", lists)


def exchange(tops: DataFrame, name: str) -> DataFrame:
    """Blocks (``_tree``, ``_block``, ``_blocks``, ``_top``) with their tree's top and upper proof."""
    state = kept(tops.withColumn("_upper", F.expr(f"cast(array() as {STEP})")), f"{name}-0")
    count, most = state.agg(F.count(F.lit(1)), F.coalesce(F.max("_blocks"), F.lit(1))).first()
    for r in range(levels(most)):
        span = FANOUT ** r
        first = F.expr(f"_block - _block % {FANOUT * span}")
        digit = F.expr(f"_block div {span} % {FANOUT}")
        # one block of every sibling subtree, each of whose blocks is asked about equally often
        asked = state.where(f"_blocks > {span}").select(
            "_tree", "_block", "_blocks", digit.alias("_own"), first.alias("_first"),
            F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("_digit"))
        asked = asked.withColumn("_start", F.expr(f"_first + _digit * {span}")).where(
            "_digit <> _own and _start < _blocks")
        asked = asked.withColumn("_partner", F.expr(
            f"_start + _block % {span} % least({span}, _blocks - _start)"))
        held = state.select("_tree", F.col("_block").alias("_partner"), F.col("_top").alias("_got"))
        got = asked.join(held, ["_tree", "_partner"]).groupBy("_tree", "_block", "_own").agg(
            F.array_sort(F.collect_list(F.struct("_digit", "_got"))).alias("_others"))

        def side(which: str) -> Column:
            return F.expr(f"coalesce(array_join(transform(filter(_others, x -> x._digit {which} _own),"
                          " x -> x._got), ''), '')")

        joined = state.join(got, ["_tree", "_block"], "left").withColumn(
            "_before", side("<")).withColumn("_after", side(">"))
        # a run of one node is hashed as well, while its tree has others
        live = F.col("_blocks") > span
        state = kept(joined.select(
            "_tree", "_block", "_blocks",
            F.when(live, F.sha2(F.concat("_before", "_top", "_after"), 256))
            .otherwise(F.col("_top")).alias("_top"),
            F.when(live, F.concat("_upper", F.array(F.struct(
                F.col("_before").alias("before"), F.col("_after").alias("after")))))
            .otherwise(F.col("_upper")).alias("_upper")), f"{name}-{r + 1}", count)
    return state


def proofs(rows: DataFrame, order: Sequence[str], name: str, height: int = HEIGHT) -> DataFrame:
    """``rows`` (stored; ``_tree``, ``_digest`` and others) with their tree's ``_top`` and ``_proof``."""
    placed = kept(numbered(rows, "_tree", order, f"{name}-ranges").withColumn(
        "_block", F.expr(f"_pos div {FANOUT ** height}")), f"{name}-placed")
    groups = placed.groupBy("_tree", "_block")
    tops = groups.applyInArrow(lambda t: _tops(t, height),
                               "_tree string, _block long, _blocks long, _top string")
    upper = exchange(tops, name).select("_tree", "_block", "_top", "_upper")
    # a step of a proof holds FANOUT - 1 digests; the table is broadcast only while it is small
    size = sum(r["n"] * (512 + 224 * r["steps"]) for r in upper.groupBy(
        F.size("_upper").alias("steps")).agg(F.count(F.lit(1)).alias("n")).collect())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields
                       if f.name != "_nodes")
    lower = groups.applyInArrow(lambda t: _lower(t, height), f"{fields}, _lower {STEP}")
    found = sized_join(lower, upper, size, ["_tree", "_block"], order)
    return found.select(*rows.columns, "_top", F.concat("_lower", "_upper").alias("_proof"))


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, height: int = HEIGHT,
             ) -> DataFrame:
    """Every row's ``doc_id``, ``leaf``, ``subroot`` (its source's), ``root`` and ``proof``.

    ``proof`` leads from the leaf to the root, a step per level: the siblings ``before`` and
    ``after`` the node. ``changed`` replaces columns in a second version of the rows, whose digest
    is the column ``changed_leaf``.
    """
    rows, _ = aside(docs, FIELDS)
    columns = {c: F.col(c) for c in FIELDS}
    # NULL sorts before every source, the empty one too; the tie parts repeated rows over ranges
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    leaves = kept(rows.select(
        "doc_id", tree.alias("_tree"), leaf(columns).alias("_digest"),
        leaf(columns | (changed or {})).alias("_changed"),
        F.monotonically_increasing_id().alias("_tie")), "merkle-leaves")
    own = kept(proofs(leaves, ["doc_id", "_digest", "_changed", "_tie"], "merkle-rows", height),
               "merkle-own")
    tops = kept(own.groupBy("_tree").agg(F.first("_top").alias("_digest")).select(
        F.lit("").alias("_tree"), "_digest", F.col("_tree").alias("_source")), "merkle-sources")
    above = proofs(tops, ["_source"], "merkle-tops", height).select(
        F.col("_source").alias("_tree"), F.col("_top").alias("root"), F.col("_proof").alias("_above"))
    # one row per source, as wide as its proof is long
    above = kept(above, "merkle-above")
    size = above.agg(F.sum(512 + F.octet_length("_tree") + 224 * F.size("_above"))).first()[0] or 0
    found = sized_join(own, above, size, ["_tree"], ["doc_id", "_digest"])
    return found.select(
        "doc_id", F.col("_digest").alias("leaf"), F.col("_changed").alias("changed_leaf"),
        F.col("_top").alias("subroot"), "root", F.concat("_proof", "_above").alias("proof"))
