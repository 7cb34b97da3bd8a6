"""Sharding by a weighted hash tree: region, rack, shard.

At each level every child draws an exponential variate from the hash of the key and
the child's name, at the rate of its weight; the smallest draw wins. A child's share
is thus its weight's, and a draw depends on nothing but key, name and weight: when a
weight changes, keys move only to or from the subtree whose weight changed.

A shard added inside a region raises that region's weight, and keys drawn into the
region may land on any of its shards. ``grow`` therefore opens a region for the new
shard: keys then move to it and nowhere else, at every size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

#: Slots are counted in this many chunks of a shard, so that no task holds a shard.
#: The table of chunk sizes, the only thing broadcast, has at most this many rows a shard.
CHUNKS = 2048


@dataclass(frozen=True)
class Node:
    """A subtree: ``shard`` is its number if it is a leaf."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int = -1

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def even_tree(regions: int, racks: int, shards: int) -> Node:
    """``regions`` of ``racks`` of ``shards`` each, all of weight 1, numbered in order."""

    def rack(r: int, k: int) -> Node:
        first = (r * racks + k) * shards
        name = f"region{r}/rack{k}"
        return inner(name, [Node(f"{name}/shard{i}", 1.0, (), i) for i in range(first, first + shards)])

    return inner("", [inner(f"region{r}", [rack(r, k) for k in range(racks)]) for r in range(regions)])


def grow(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own."""
    region = f"region{len(tree.children)}"
    leaf = Node(f"{region}/rack0/shard", weight, (), max(x.shard for x in tree.leaves()) + 1)
    return inner(tree.name, [*tree.children, inner(region, [inner(f"{region}/rack0", [leaf])])])


def descend(tree: Node, key: Column) -> Column:
    """The shard of ``key``, as one expression of built-in functions."""
    if not tree.children:
        return F.lit(tree.shard)
    if len(tree.children) == 1:
        return descend(tree.children[0], key)

    def draw(child: Node, i: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(child.name), key), 11)
        uniform = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(uniform) / F.lit(child.weight)).alias("draw"), F.lit(i).alias("i"))

    won = F.least(*(draw(c, i) for i, c in enumerate(tree.children)))["i"]
    chosen = [descend(c, key) for c in tree.children]
    return F.transform(
        F.array(won), lambda w: reduce(lambda rest, ic: F.when(w == ic[0], ic[1]).otherwise(rest), enumerate(chosen[:-1]), chosen[-1])
    )[0]


def place(
    docs: DataFrame, tree: Node, id_col: str = "doc_id", text_col: str = "text", chunks: int = CHUNKS
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 1; the law is ``key``: the id and the
    tree decide. Slots of a shard run from 0 without gaps, by chunk, id, size and CRC.

    The text itself isn't shuffled. Equal rows are counted before the shuffle and
    unfolded after it, so copies of a row don't crowd a task. A null id is a key as
    any other; a null text has size 1 and the CRC of no bytes. Other columns don't matter.
    """
    row = ["doc_id", "size", "text_crc32"]
    sized = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    placed = sized.select(
        *row,
        descend(tree, F.col("doc_id")).alias("shard"),
        descend(grow(tree), F.col("doc_id")).alias("grown_shard"),
        F.pmod(F.xxhash64(*row), F.lit(chunks)).cast("int").alias("chunk"),
    )
    counted = placed.groupBy("shard", "chunk", *row, "grown_shard").agg(F.count("*").alias("copies"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy("shard", "chunk")
        .agg(F.sum("copies").alias("rows"))
        .select("shard", "chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "chunk").orderBy(*row).rowsBetween(Window.unboundedPreceding, -1)
    started = counted.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    return (
        started.join(F.broadcast(offsets), ["shard", "chunk"])
        # in two steps, so that no array grows with the number of copies
        .withColumn("run", F.explode(F.sequence(F.lit(0), F.expr("(copies - 1) div 10000"))))
        .withColumn(
            "copy",
            F.explode(F.sequence(F.col("run") * 10000, F.least(F.col("run") * 10000 + 9999, F.col("copies") - 1))),
        )
        .select(
            *row,
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("before") + F.col("copy")).alias("slot"),
            "grown_shard",
        )
    )
