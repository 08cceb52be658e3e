"""Shards by a hierarchical weighted hash tree (regions, racks, shards), in Spark expressions alone.

Law ``key``: a row's shard is decided by its doc_id and the tree alone.  Each leaf (shard)
``l`` of weight ``w`` draws ``-ln(u) / w`` with ``u`` uniform in (0, 1] from a hash of
(doc_id, l); the draw of a subtree is the least draw of its leaves, which by the law of minima
of exponential variables is a draw of the subtree's total weight.  A row descends from the
root, at every level into the child with the least draw (ties: the child listed first), down
to a shard.  When a subtree's weight changes because a shard joins it, the draws of all other
leaves stay as they were, so rows move only into the subtrees that hold the new shard and
there only into the new shard itself: one more shard takes rows only into itself.

A draw per level from a hash of (doc_id, node) and the node's weight alone (the plain straw
descent) would also move rows only into the grown region, but then spread them over its old
racks and shards too; the least-of-leaves draw is what confines movement to the new leaf.
Its cost is one hash per leaf and row, which codegen does in a few nanoseconds at 16 leaves.

``slot`` numbers the rows of each shard from 0 without gaps: rows keep the order of their
input part (a written table, so a lost executor recomputes the same numbers), counts per
(part, shard) are summed along the parts (a table of parts x shards rows), and a row's slot is
its part's base plus its place among that part's rows of its shard.  No step gathers a shard
into one task; a group of equal texts or of repeated doc_ids is spread over parts like any
other rows (equal doc_ids share a shard, which the law requires).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import Scratch, fresh

#: The tree of the query: 2 regions of 2 racks of 4 shards, each of weight 1.
REGIONS, RACKS, SHARDS = 2, 2, 4

#: Bits of a hash taken as the uniform number of a draw.
DRAW_BITS = 52


@dataclass(frozen=True)
class Node:
    """A subtree: its children, or, at a leaf, its shard number and weight."""

    children: tuple[Node, ...] = ()
    shard: int | None = None
    weight: float = 1.0

    def leaves(self) -> list[Node]:
        return [self] if self.shard is not None else [leaf for c in self.children for leaf in c.leaves()]


def tree(regions: int = REGIONS, racks: int = RACKS, shards: int = SHARDS) -> Node:
    """Equal regions of equal racks of equal shards, numbered in order."""
    n = iter(range(regions * racks * shards))
    return Node(tuple(Node(tuple(Node(tuple(Node(shard=next(n)) for _ in range(shards))) for _ in range(racks))) for _ in range(regions)))


def grown(root: Node, region: int = 0, rack: int = 0, weight: float = 1.0) -> Node:
    """``root`` with one more shard, numbered next, in the given rack of the given region."""
    new = Node(shard=len(root.leaves()), weight=weight)
    regions = list(root.children)
    racks = list(regions[region].children)
    racks[rack] = Node(racks[rack].children + (new,))
    regions[region] = Node(tuple(racks))
    return Node(tuple(regions))


def leaf_draw(key: Column, leaf: Node) -> Column:
    """``-ln(u) / weight``, u in (0, 1] from the hash of (key, shard); a smaller draw wins."""
    u = F.shiftrightunsigned(F.xxhash64(key, F.lit(leaf.shard)), 64 - DRAW_BITS) + 1
    return -F.log(u / float(1 << DRAW_BITS)) / F.lit(float(leaf.weight))


def descend(root: Node, key: Column) -> Column:
    """The shard that a row of ``key`` reaches from ``root``, level by level."""
    draws = {leaf.shard: leaf_draw(key, leaf) for leaf in root.leaves()}

    def draw(node: Node) -> Column:
        parts = [draws[leaf.shard] for leaf in node.leaves()]
        return parts[0] if len(parts) == 1 else F.least(*parts)

    def choose(node: Node) -> Column:
        if node.shard is not None:
            return F.lit(node.shard)
        if len(node.children) == 1:
            return choose(node.children[0])
        best = F.least(*[draw(c) for c in node.children])
        first, *rest = node.children  # the first child whose draw is the least
        pick = F.when(draw(first) == best, choose(first))
        for child in rest:
            pick = pick.when(draw(child) == best, choose(child))
        return pick

    return choose(root)


def shard(docs: DataFrame, spark_scratch: Scratch | None = None, root: Node | None = None, grow: Node | None = None) -> DataFrame:
    """Every row of ``docs`` with its shard by law ``key``.

    Returns doc_id, size (UTF-8 bytes of text plus 1; null text counts 0 bytes), text_crc32
    (unsigned crc32 of the UTF-8 text; null text: crc32 of no bytes, 0), law ``key``, shard,
    slot (gapless from 0 within a shard) and grown_shard (the shard under ``grow``, by default
    the tree with one more shard).  A null doc_id is a key like any other (its hash is the
    seed's), so all such rows share a shard.  Repeated rows each get their own slot.  An
    empty table gives no rows.  Further columns of ``docs``, clashing names included, are
    not read.
    """
    root = root or tree()
    grow = grow or grown(root)
    spark = docs.sparkSession
    scratch = spark_scratch or Scratch(spark, "shards")
    row = fresh(docs, "row")
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        descend(root, F.col("doc_id").cast("long")).cast("int").alias("shard"),
        descend(grow, F.col("doc_id").cast("long")).cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias(row),
    )
    placed = scratch.put("placed", placed)
    part = fresh(placed, "part")
    placed = placed.withColumn(part, F.shiftright(F.col(row), 33))  # the input part that the id was made in
    counts = placed.groupBy(part, "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(part, "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(part, "shard").orderBy(row)
    slot = (F.col("base") + F.row_number().over(inside) - 1).cast("long")
    # bases has one row per (part, shard), parts x shards rows, and is joined on those keys
    return placed.join(bases, [part, "shard"]).select("doc_id", "size", "text_crc32", "law", "shard", slot.alias("slot"), "grown_shard")
