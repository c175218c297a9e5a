"""Hierarchical weighted hash tree: region, rack and shard are drawn in turn.

At each level every child of the chosen node draws -ln(u)/weight, u a hash of
the key and the child; the least draw wins. So a child gets keys in proportion
to its weight, and when weights change below one child, keys move only into or
out of that child's subtree: the draws of all others stay as they were.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import broadcast_if_small, materialise, unit_draw

#: Rows of a shard are numbered in so many blocks, each sorted by a task of its own.
BLOCKS = 2048


@dataclass
class Node:
    """name: stays the same however the tree grows. shard: of a leaf."""

    name: str
    weight: float = 0.0
    shard: int | None = None
    children: list[Node] = field(default_factory=list)

    def total(self) -> float:
        return self.weight if self.shard is not None else sum(x.total() for x in self.children)


def build_tree(shards: int, weights: dict[int, float] | None = None, rack_shards: int = 4, region_racks: int = 2) -> Node:
    """Shards fill racks, racks fill regions. weights: of shards, 1 where not given; 0 takes a shard out.

    A shard beyond full regions opens a region of its own, and so takes keys
    only into itself; one beyond that shares the region's keys.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    root, weights = Node("root"), weights or {}
    for s in range(shards):
        region, rack = s // (rack_shards * region_racks), s // rack_shards
        if region == len(root.children):
            root.children.append(Node(f"region-{region}"))
        racks = root.children[region].children
        if not racks or racks[-1].name != f"rack-{rack}":
            racks.append(Node(f"rack-{rack}"))
        racks[-1].children.append(Node(f"shard-{s}", float(weights.get(s, 1.0)), s))
    return root


def shard_of(root: Node, *key: Column) -> Column:
    """The shard that the key's draws lead to. Equal keys meet; a null key is a key like others."""
    if root.shard is not None:
        return F.lit(root.shard)
    live = [x for x in root.children if x.total() > 0]
    if not live:
        raise ValueError(f"{root.name} has no weight")
    if len(live) == 1:
        return shard_of(live[0], *key)
    draws = [F.struct((-F.ln(unit_draw(F.lit(x.name), *key)) / F.lit(x.total())).alias("draw"), F.lit(i).alias("child")) for i, x in enumerate(live)]
    won = F.array_min(F.array(*draws))["child"]
    if all(x.shard is not None for x in live):
        return F.get(F.array(*[F.lit(x.shard) for x in live]), won)
    then = None
    for i, x in enumerate(live):
        then = (F if then is None else then).when(won == i, shard_of(x, *key))
    return then


def assign(docs: DataFrame, shards: int, weights: dict[int, float] | None = None, grown: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (of a tree of `grown` shards, else null), slot; one row per row of docs.

    doc_id and the tree alone decide the shard: repeated ids meet, null ids are
    one key. A null text has no bytes (size 8, CRC-32 of the empty text). Slots
    of a shard run from 0 without gaps; rows alike in all columns get any order.
    Other columns of docs are not read. An empty table gives an empty one.

    Slots need an order within each shard, but no task sorts a shard: rows fall
    into BLOCKS blocks of it by hash, are numbered there, and are moved up by
    the rows of the blocks before, of which there are shards x BLOCKS at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    narrow = materialise(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            shard_of(build_tree(shards, weights), key).alias("shard"),
            (shard_of(build_tree(grown, weights), key) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        ).withColumn("__block", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(BLOCKS)).cast("int"))
    )
    counts = narrow.groupBy("shard", "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("shard", "__block").orderBy("doc_id", "text_crc32", "size")
    numbered = narrow.withColumn("__row", F.row_number().over(within))
    return numbered.join(broadcast_if_small(starts, shards * BLOCKS), ["shard", "__block"]).select("doc_id", "size", "text_crc32", "shard", "grown_shard", (F.col("__start") + F.col("__row") - 1).cast("long").alias("slot"))
