"""Shard assignment by a hierarchical weighted hash tree, in DataFrame functions only.

A tree has regions, their racks and the racks' shards. A row descends it: at each level every
child draws -ln(u) / weight, with u a hash of (key, child), and the least draw wins, so a child
gets its weight's share. A draw depends on the child alone. Hence

* changing a shard's weight, or adding a shard to a rack, changes draws only along the path
  from the root to that shard, and rows move only where such a subtree wins or loses;
* `grow` puts the new shard into a region of its own: no other draw changes, a row either keeps
  its shard or moves into the new one (the law `key`).

Defined cases: a null key counts as one key of its own; a null text has no bytes and crc32 0;
rows with the same key always share a shard; shards without rows are absent; an empty table
gives an empty result. Slots number the rows of a shard from 0 without a gap; identical rows get
their slots in any order.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import stored

# Rows of the offset table over all shards: it is broadcast, so this bounds its size.
SLOT_BUCKETS = 1 << 18


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def uniform_tree(shards: int, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """Equal shards 0..n-1, filled rack by rack and region by region."""
    return [Leaf(i // (per_rack * racks), i // per_rack, i) for i in range(shards)]


def grow(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a new region and rack of its own."""
    region = max((leaf.region for leaf in tree), default=-1) + 1
    rack = max((leaf.rack for leaf in tree), default=-1) + 1
    shard = max((leaf.shard for leaf in tree), default=-1) + 1
    return [*tree, Leaf(region, rack, shard, weight)]


def _levels(tree: list[Leaf]) -> tuple[dict, dict, dict]:
    """Children with their weights: of the root, by region, by rack."""
    if len({leaf.shard for leaf in tree}) != len(tree):
        raise ValueError("a shard occurs twice")
    regions: dict[int, float] = defaultdict(float)
    racks: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    shards: dict[tuple[int, int], dict[int, float]] = defaultdict(dict)
    owner: dict[int, int] = {}
    for leaf in tree:
        if owner.setdefault(leaf.rack, leaf.region) != leaf.region:
            raise ValueError("a rack is in two regions")
        if leaf.weight > 0:
            regions[leaf.region] += leaf.weight
            racks[leaf.region][leaf.rack] += leaf.weight
            shards[leaf.rack][leaf.shard] = leaf.weight
    if not regions:
        raise ValueError("no shard has a weight")
    return regions, racks, shards


def _children(weights: dict[int, float]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(int(child)).alias("id"), F.lit(float(w)).alias("weight"))
            for child, w in sorted(weights.items())
        ]
    )


def _below(tables: dict[int, dict[int, float]], node: Column) -> Column:
    entries = [c for k, w in sorted(tables.items()) for c in (F.lit(int(k)), _children(w))]
    return F.element_at(F.create_map(*entries), node)


def _winner(key: Column, level: str, children: Column) -> Column:
    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), child["id"], key), 11)
        u = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["id"].alias("id"))

    return F.array_min(F.transform(children, draw))["id"]


def with_shard(df: DataFrame, tree: list[Leaf], key: str, out: str) -> DataFrame:
    """Add the shard that `key` descends to, as `out`."""
    regions, racks, shards = _levels(tree)
    return (
        df.withColumn("__region", _winner(F.col(key), "region", _children(regions)))
        .withColumn("__rack", _winner(F.col(key), "rack", _below(racks, F.col("__region"))))
        .withColumn(out, _winner(F.col(key), "shard", _below(shards, F.col("__rack"))))
        .drop("__region", "__rack")
    )


def with_slots(placed: DataFrame, order: list[str], shards: int) -> DataFrame:
    """Number the rows of each `shard` from 0, as `slot`.

    Shards are divided into hash buckets of whole rows' keys. Bucket counts are scanned per
    shard, and a row's slot is its rank in its bucket plus the rows of earlier buckets: no task
    holds more than one bucket. `placed` is read twice and should be stored.
    """
    buckets = max(1, SLOT_BUCKETS // max(shards, 1))
    bucketed = placed.withColumn(
        "__bucket", F.pmod(F.xxhash64(F.lit("slot"), *order), F.lit(buckets)).cast("int")
    )
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        bucketed.groupBy("shard", "__bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    )
    rank = F.row_number().over(Window.partitionBy("shard", "__bucket").orderBy(*order))
    return (
        bucketed.withColumn("__rank", rank)
        .join(F.broadcast(offsets), ["shard", "__bucket"])
        .withColumn("slot", (F.col("__base") + F.col("__rank") - 1).cast("bigint"))
        .drop("__bucket", "__rank", "__base")
    )


def assign_shards(
    docs: DataFrame, tree: list[Leaf], *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row of `docs`.

    size is the UTF-8 length of the text plus 16; grown_shard is the shard after `grow`.
    """
    data = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key),
        (F.octet_length(data) + 16).cast("bigint").alias("size"),
        F.crc32(data.cast("binary")).cast("bigint").alias("text_crc32"),
    )
    placed = with_shard(narrow, tree, key, "shard")
    placed = with_shard(placed, grow(tree), key, "grown_shard").withColumn("law", F.lit("key"))
    slots = with_slots(stored(placed, "shards"), [key, "size", "text_crc32"], len(tree))
    return slots.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
