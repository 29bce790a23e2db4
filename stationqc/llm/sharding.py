"""Sharding by a hierarchical weighted hash tree (native Spark only).

A tree of regions, racks and shards carries a weight per shard; a rack and a
region weigh what their members weigh.  A row descends level by level: each child
of the node draws ``-ln(u) / weight`` with u from a hash of the row's key and the
child's name, and the smallest draw wins.  A child's draw depends on its own
weight only, so a changed weight moves rows only into or out of the subtrees that
contain it.  A new shard that enters as a region of its own leaves every other
weight unchanged: it takes rows only into itself.

The placement is a function of the key and the tree, so a lost executor's rows
land where they did.  Slots number the rows of a shard without gaps by a two-level
prefix sum: rows are ranked inside (shard, bucket), and only the bucket counts
meet per shard.

Defined results: a null key is a key of its own; null text has no bytes; repeated
rows get the same shard and different slots; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationqc.llm.common import md5_int, running_offsets, settle

Tree = Sequence[Sequence[Sequence[float]]]          # regions of racks of shard weights

#: Hash buckets that cut a shard for the numbering of its rows (fixed: the result depends on it).
SLOT_BUCKETS = 4096


def even_tree(regions: int = 4, racks: int = 3, shards: int = 2, extra: int = 0) -> list[list[list[float]]]:
    """Equal weights; ``extra`` further shards enter as a region of one rack each."""
    return [[[1.0] * shards for _ in range(racks)] for _ in range(regions)] + [[[1.0]] for _ in range(extra)]


def _array(values: Sequence, kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) if not isinstance(v, Column) else v for v in values])


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _choose(key: Column, node: Column, weights: Column, width: int) -> Column:
    """Index of the child with the smallest weighted draw; children without weight never win."""
    def draw_with(row: Column) -> Column:
        def draw(k: Column) -> Column:
            u = (md5_int(F.concat(row, k.cast("string")), 13) + F.lit(1)) / F.lit(float(16 ** 13 + 1))
            weight = F.get(weights, k)
            return F.when(weight > 0, F.struct((-F.ln(u) / weight).alias("d"), k.alias("k")))
        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), draw))["k"]

    return _let(F.concat(F.coalesce(key, F.lit("null")), F.lit("|"), node, F.lit("/")), draw_with)


def shard_of(key: Column, tree: Tree) -> Column:
    """Shard number (shards counted in tree order) that a key descends to."""
    key = key.cast("string")
    racks = max(len(region) for region in tree)
    leaves = max(len(rack) for region in tree for rack in region)
    first, numbers = 0, []
    for region in tree:
        numbers.append([])
        for rack in region:
            numbers[-1].append(first)
            first += len(rack)
    w_region = _array([float(sum(map(sum, region))) for region in tree], "double")
    w_rack = _array([_array([float(sum(rack)) for rack in region], "double") for region in tree], "array<double>")
    w_leaf = _array([_array([_array(rack, "double") for rack in region], "array<double>") for region in tree],
                    "array<array<double>>")
    base = _array([_array(starts, "int") for starts in numbers], "array<int>")
    name = lambda *parts: F.concat_ws("/", F.lit("t"), *[p.cast("string") for p in parts])

    def in_region(g: Column) -> Column:
        def in_rack(r: Column) -> Column:
            leaf = _choose(key, name(g, r), F.get(F.get(w_leaf, g), r), leaves)
            return F.get(F.get(base, g), r) + leaf
        return _let(_choose(key, name(g), F.get(w_rack, g), racks), in_rack)

    return _let(_choose(key, F.lit("t"), w_region, len(tree)), in_region).cast("int")


def assign_shards(docs: DataFrame, tree: Tree, grown: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and the shard in the grown tree."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = settle(rows.withColumn("shard", shard_of(F.col("doc_id"), tree))
                  .withColumn("grown_shard", shard_of(F.col("doc_id"), grown))
                  .withColumn("bucket", md5_int(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), 3)))
    offsets = running_offsets(rows.withColumn("one", F.lit(1)), ["shard"], "bucket", "one", "before")
    w = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("rank", F.row_number().over(w)).join(offsets, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard"))
