"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweir.storage import materialize

#: Added to the bytes of each text.
ROW_OVERHEAD = 16
#: Bits of a hash that choose a child at one level of the tree.
LEVEL_BITS = 21
#: Draws of one pass, at most; the rows that a pass leaves are aimed to be fewer than one in 10^12.
MOST_DRAWS, LEFT = 64, 1e-12


@dataclass(frozen=True)
class Tree:
    """Regions of racks of slots, all of one capacity. Shard n has slot n; a slot without a shard has weight 0.

    The shape is fixed when rows are first placed: shards come, go and change their
    weights within it, and another shape is another placement.
    """

    regions: int = 4
    racks: int = 3
    slots: int = 4
    capacity: float = 1.0

    @property
    def size(self) -> int:
        return self.regions * self.racks * self.slots

    def checked(self, weights: list[float]) -> list[float]:
        """A weight for each slot; raises if the shards don't fit into the tree."""
        if len(weights) > self.size:
            raise ValueError(f"{len(weights)} shards in a tree of {self.size} slots: give the tree more regions")
        if not all(0 <= w <= self.capacity for w in weights) or not any(weights):
            raise ValueError(f"weights lie between 0 and the capacity of a slot ({self.capacity}), and one is above 0")
        return [*map(float, weights), *[0.0] * (self.size - len(weights))]


def _bits(hashed: Column, level: int) -> Column:
    return F.shiftrightunsigned(hashed, LEVEL_BITS * level).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))


def _slot(path: Column, tree: Tree) -> Column:
    """Down the tree by one hash: region, rack in it and slot in that, each by its share of the capacity above."""
    region, rack, slot = (F.pmod(_bits(path, level), F.lit(n)) for level, n in enumerate((tree.regions, tree.racks, tree.slots)))
    return ((region * tree.racks + rack) * tree.slots + slot).cast("int")


def _chance(hashed: Column) -> Column:
    return (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) * 2.0**-53


def descend(rows: DataFrame, key: str, tree: Tree, layouts: dict[str, list[float]]) -> DataFrame:
    """``rows``, written, with a column for each layout: the shard that the key descends to under its weights.

    A draw descends from region to rack to slot by hashes of key and number of the draw,
    each child by its capacity, and stays with a chance of weight by capacity; else the
    next draw descends from the root anew. Where a draw leads doesn't depend on weights,
    so a weight that grows, or a shard that an empty slot gets, takes only the keys whose
    draws meet that slot, and one that shrinks gives up only its own: no key moves between
    slots whose weights stay. Shares of shards, racks and regions are those of their
    weights. A pass makes as many draws as should do for all; rows that are left over, if
    any, are drawn for again in a further pass, until none is left.
    """
    weights = {name: tree.checked(w) for name, w in layouts.items()}
    stays = min(sum(w) for w in weights.values()) / (tree.size * tree.capacity)
    draws = 1 if stays >= 1 else min(MOST_DRAWS, math.ceil(math.log(LEFT) / math.log1p(-stays)))
    done, todo, start = None, rows, 0
    while True:
        hashed = {
            "_paths": F.array(*[F.xxhash64(F.col(key), F.lit(start + k), F.lit("path")) for k in range(draws)]),
            "_chances": F.array(*[F.xxhash64(F.col(key), F.lit(start + k), F.lit("stays")) for k in range(draws)]),
        }
        drawn = todo.withColumns(hashed).withColumns(
            {"_slots": F.array(*[_slot(F.col("_paths")[k], tree) for k in range(draws)]), "_at": F.array(*[_chance(F.col("_chances")[k]) * tree.capacity for k in range(draws)])}
        )
        for name, of in weights.items():
            table = F.array(*map(F.lit, of))
            first = [F.when(F.col("_at")[k] < table[F.col("_slots")[k]], F.col("_slots")[k]) for k in range(draws)]
            drawn = drawn.withColumn(name, F.coalesce(*([F.col(name)] if start else []), *first))
        todo = materialize(drawn.drop("_paths", "_chances", "_slots", "_at"), "shards")
        missing = " OR ".join(f"`{name}` IS NULL" for name in weights)
        settled = todo.where(f"NOT ({missing})")
        done, todo, start = settled if done is None else done.unionByName(settled), todo.where(missing), start + draws
        if todo.isEmpty():
            return done


def shard_documents(docs: DataFrame, n_shards: int = 40, weights: dict[int, float] | None = None, tree: Tree | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: doc_id and the shards decide, and one more shard takes rows only
    into itself. Rows of one doc_id go to one shard; a null doc_id is a key like any
    other. A null text has size 16 and the checksum of the empty text. Slots of a shard
    count from 0 without gaps, in the order in which the rows were scanned: rows are
    numbered within (shard, scan partition), and the counts of those (a row each) give
    every run its start, so no shard and no key is gathered in one task. Repeated rows
    give a row each, with slots of their own. Other columns are ignored; an empty table
    gives an empty result.
    """
    tree = tree or Tree()
    present = [(weights or {}).get(n, 1.0) for n in range(n_shards)]
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row_id"),
    ).withColumn("part", F.shiftright("row_id", 33))
    placed = descend(rows, "doc_id", tree, {"shard": present, "grown_shard": [*present, 1.0]})
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("row_id")
    return (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("start") + F.col("place")).cast("bigint").alias("slot"),
            F.col("grown_shard").cast("int").alias("grown_shard"),
        )
    )
