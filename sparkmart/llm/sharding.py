"""Sharding by a hierarchical weighted hash tree (operator 8).

A key descends from the root over regions and racks to a shard. At every node
each child draws `-ln(u) / weight` with a hash u of key and child; the smallest
draw wins, so children get keys in proportion to their weights. A draw depends
on nothing but the key, the child and its weight: if weights change inside a
subtree, keys only move between that subtree and others as its total weight
asks for, and all other subtrees keep what they have among themselves.

New shards come in as a region of their own. The regions that were there keep
their weights, so one more shard takes keys only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import blobs
from .components import written

#: Shards of the default tree: racks of four, regions of two racks.
SHARDS_PER_RACK, RACKS_PER_REGION = 4, 2


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard has no children and its number in `shard`."""

    name: str
    weight: float = 1.0
    children: tuple[Node, ...] = ()
    shard: int = -1

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


def tree(shards: int, per_rack: int = SHARDS_PER_RACK, racks: int = RACKS_PER_REGION) -> Node:
    """Shards 0 to `shards - 1` of weight 1 in full racks and regions, the last of them as full as the numbers allow."""
    leaves = [Node(f"shard {i}", shard=i) for i in range(shards)]
    grouped = [Node(f"rack {i}", children=tuple(leaves[i * per_rack : (i + 1) * per_rack])) for i in range(-(-shards // per_rack))]
    return Node("root", children=tuple(Node(f"region {i}", children=tuple(grouped[i * racks : (i + 1) * racks])) for i in range(-(-len(grouped) // racks))))


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a rack and region of its own."""
    new = Node(f"region of {shard}", children=(Node(f"rack of {shard}", children=(Node(f"shard {shard}", weight, shard=shard),)),))
    return Node(root.name, root.weight, (*root.children, new))


def _levels(root: Node) -> tuple[Column, Column, int]:
    """For each node, numbered from the root: its children (number, name, weight) and its shard; and the number of levels."""
    nodes, depth = [root], 0
    level = [root]
    while any(n.children for n in level):
        level = [c for n in level for c in n.children]
        nodes += level
        depth += 1
    number = {id(n): i for i, n in enumerate(nodes)}

    def entry(node: Node) -> Column:
        return F.struct(F.lit(number[id(node)]).alias("number"), F.lit(node.name).alias("name"), F.lit(float(node.total)).alias("weight"))

    # a shard above the lowest level is its own only child
    children = F.array(*(F.array(*(entry(c) for c in (n.children or (n,)) if c.total > 0)) for n in nodes))
    return children, F.array(*(F.lit(n.shard) for n in nodes)), depth


def placed(key: Column, root: Node) -> Column:
    """The shard that `key` (a string) descends to: one weighted draw among the children of each node on its way."""
    children, shards, depth = _levels(root)

    def draw(child: Column) -> Column:
        # 52 bits of the hash, in the middle of their interval: never 0 or 1
        u = (F.shiftrightunsigned(F.xxhash64(child["name"], key), 12).cast("double") + 0.5) / F.lit(float(1 << 52))
        return F.struct((-F.ln(u) / child["weight"]).alias("draw"), child["number"].alias("number"))

    node = F.lit(0)
    for _ in range(depth):
        node = F.array_min(F.transform(F.get(children, node), draw))["number"]
    return F.get(shards, node)


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40) -> DataFrame:
    """Key, `size` (bytes of the text and 16), `text_crc32`, `law`, `shard`, `slot` and `grown_shard` of every row.

    The key and the number of shards decide the shard; equal keys, also null
    ones, share it. Slots number the rows of a shard from 0 without gaps, in
    pieces that are counted first, so that no task has a whole shard to number.
    Equal rows get different slots. A null text has no bytes. A key with the
    name of another result column keeps its name, which then stands twice.
    """
    own = F.col(f"`{key}`")
    name = F.coalesce(own.cast("string"), F.lit("null"))
    root = tree(shards)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(own.alias("key"), (F.octet_length(whole) + 16).cast("long").alias("size"), F.crc32(whole).alias("text_crc32"), placed(name, root).cast("int").alias("shard"), placed(name, grown(root, shards)).cast("int").alias("grown_shard"))
    pieces = max(1, blobs.partitions(docs) * 4 // shards)
    rows = rows.withColumn("piece", F.floor(F.rand(8) * pieces).cast("int"))
    rows = written(rows, "placed")  # pieces stay as they were drawn
    counts = rows.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("key", "text_crc32", "size"))
    numbered = rows.withColumn("inside", inside).join(offsets, ["shard", "piece"])
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("inside") - 1).alias("slot"), "grown_shard")
