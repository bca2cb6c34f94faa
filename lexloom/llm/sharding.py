"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions and racks; a node weighs what its
leaves weigh together.  A row descends: at each level it draws, for every child
of the node it is at, ``-ln(u) / weight`` with u uniform from a hash of the
row's key and the child's path, and goes to the child of the least draw.  So a
level chooses in proportion to weight, and a row of the default tree takes 5
draws of regions, 2 of racks and 4 of shards.

A draw depends on the key, the path and the weight of one node.  If the weight of
a leaf changes, so do only its own, its rack's and its region's draws: rows move
between that region and the others, or within it, and rows between two other
regions never do; the same holds for racks within the region.  A shard that is
added is a region of its own, so that it takes rows only into itself.

Law: ``key`` - the key and the weights decide, nothing else does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

#: Shape of the tree: shard s is in rack s // RACK, which is in region s // (RACK * REGION).
RACK, REGION = 4, 2
#: Rows of a shard are numbered within so many blocks of rows, so no shard is one task.
SLOT_BLOCKS = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def known_key(key: Column) -> Column:
    """The key as text; a null key is a key of its own."""
    return F.coalesce(key.cast("string"), F.lit("\0null"))


def draw(known: Column, path: Column, weight: Column) -> Column:
    """The draw of a node: exponential, with its weight as rate; without weight, infinite."""
    # 53 bits, one added: u is in (0, 1]
    u = (F.shiftrightunsigned(F.xxhash64(known, path), 11) + 1).cast("double") / F.lit(float(2**53))
    return F.when(weight > 0, -F.ln(u) / weight).otherwise(F.lit(float("inf")))


def tree(weights: Sequence[float]) -> Column:
    """The tree of some leaves as a literal: regions, their racks, their shards, each with path and weight."""
    if not any(w > 0 for w in weights):
        raise ValueError("a tree needs a leaf of positive weight")
    leaves = [max(0.0, float(w)) for w in weights]

    def node(path: str, number: int, weight: float, below: Column | None = None) -> Column:
        own = [F.lit(path).alias("path"), F.lit(number).alias("number"), F.lit(weight).alias("w")]
        return F.struct(*own, *([] if below is None else [below.alias("below")]))

    def shards(k: int) -> Column:
        own = range(k * RACK, min((k + 1) * RACK, len(leaves)))
        return F.array(*[node(f"{k // REGION}/{k}/{s}", s, leaves[s]) for s in own])

    def racks(r: int) -> Column:
        own = range(r * REGION, min((r + 1) * REGION, -(-len(leaves) // RACK)))
        return F.array(*[node(f"{r}/{k}", k, sum(leaves[k * RACK : (k + 1) * RACK]), shards(k)) for k in own])

    width = RACK * REGION
    return F.array(*[node(f"{r}", r, sum(leaves[r * width : (r + 1) * width]), racks(r)) for r in range(-(-len(leaves) // width))])


def descend(known: Column, regions: Column) -> Column:
    """Struct (region, rack, shard, draw): the way down the tree, and the draw of the region."""

    def pick(nodes: Column) -> Column:
        """(draw, place) of the child of the least draw; of equal ones the first."""
        return F.array_min(F.transform(nodes, lambda x, i: F.struct(draw(known, x["path"], x["w"]).alias("draw"), i.alias("i"))))

    def in_region(best: Column, region: Column) -> Column:
        def in_rack(rack: Column) -> Column:
            shard = let(pick(rack["below"]), lambda b: F.get(rack["below"], b["i"])["number"])
            return F.struct(region["number"].alias("region"), rack["number"].alias("rack"), shard.alias("shard"), best["draw"].alias("draw"))

        return let(let(pick(region["below"]), lambda b: F.get(region["below"], b["i"])), in_rack)

    return let(pick(regions), lambda best: let(F.get(regions, best["i"]), lambda region: in_region(best, region)))


def grown(known: Column, place: Column, count: int, added: float) -> Column:
    """The shard where a leaf of weight ``added`` is a region of its own beside a tree of ``count`` leaves."""
    own = draw(known, F.lit(f"added {count}"), F.lit(float(added)))
    return F.when(own < place["draw"], F.lit(count)).otherwise(place["shard"])


def shard_documents(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 40,
    added: float = 1.0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Shard, slot and size of every row, without its text.

    Returns key, size, text_crc32, law, region, rack, shard, slot, grown_shard.
    ``grown_shard`` is the place with one more shard, of weight ``added``.
    A null text has no bytes; its crc32 is that of the empty text.  Rows with
    the same key go to the same shard with slots of their own.  Groups (equal
    texts) are not kept together: the key decides alone.  No rows: no result
    rows.  Slots number a shard's rows from 0 by block of key and text, key,
    crc32, size.  Other columns are ignored, whatever their names.
    """
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    read = docs.select(F.col(key).alias("key"), (F.octet_length(body).cast("long") + 16).alias("size"), F.crc32(body).alias("text_crc32"))
    regions, n = tree(weights), len(weights)
    way = let(
        known_key(F.col("key")),
        lambda known: let(descend(known, regions), lambda place: F.struct(place["region"].alias("region"), place["rack"].alias("rack"), place["shard"].alias("shard"), grown(known, place, n, added).alias("grown_shard"))),
    )
    # the texts are read once: what the rest needs of a row is a few numbers
    placed = stored(read.withColumn("way", way).withColumn("block", F.pmod(F.xxhash64("key", "text_crc32"), F.lit(SLOT_BLOCKS)).cast("int")).select("*", "way.*").drop("way"), "placed")
    blocks = placed.groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "block").orderBy(F.col("key").asc_nulls_first(), "text_crc32", "size")
    # at most len(weights) * SLOT_BLOCKS rows, whatever the input
    return (
        placed.withColumn("rank", F.row_number().over(within))
        .join(F.broadcast(starts), ["shard", "block"])
        .select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "region", "rack", "shard", (F.col("start") + F.col("rank") - 1).alias("slot"), "grown_shard")
    )


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * 40, key: str = "doc_id") -> None:
    """Write the rows of ``docs`` as Parquet under ``path/shard=<n>``; a column called shard is replaced."""
    regions = tree(weights)
    shard = let(known_key(F.col(key)), lambda known: descend(known, regions)["shard"])
    docs.withColumn("shard", shard).write.partitionBy("shard").parquet(path)
