"""Shards by a hierarchical weighted hash tree; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICES = 256
Tree = dict[str, dict[str, dict[int, int]]]


def even_tree(shards: int, per_rack: int = 2, per_region: int = 2) -> Tree:
    """Shards 0 to ``shards`` - 1 of weight 1, filling racks and regions in order."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // per_rack
        region = tree.setdefault(f"region{rack // per_region}", {})
        region.setdefault(f"rack{rack}", {})[shard] = 1
    return tree


def _weight(node) -> int:
    return node if isinstance(node, int) else sum(_weight(child) for child in node.values())


def _draw(key: Column, path: str, weight: int) -> Column:
    """A hash draw of ``key`` at a node; the largest among siblings wins in proportion to weight."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(path), key), 11)
    return F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))


def _descend(key: Column, path: str, node) -> Column:
    """The shard below ``node``: one draw per child on the way, none off it."""
    children = [(name, child) for name, child in node.items() if _weight(child) > 0]

    def below(name, child) -> Column:
        return F.lit(name) if isinstance(child, int) else _descend(key, f"{path}/{name}", child)

    if len(children) == 1:
        return below(*children[0])
    draws = [
        F.struct(_draw(key, f"{path}/{name}", _weight(child)).alias("draw"), F.lit(i).alias("child"))
        for i, (name, child) in enumerate(children)
    ]
    won = F.greatest(*draws)["child"]
    chosen = F.when(won == 0, below(*children[0]))
    for i, (name, child) in enumerate(children[1:-1], start=1):
        chosen = chosen.when(won == i, below(name, child))
    return chosen.otherwise(below(*children[-1]))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of ``key``: descend region, rack and shard by weighted hash draws.

    Draws depend on the key and the node alone. Changing a weight moves rows only between that
    node's subtree and its siblings', and within the subtree only where weights below differ. A
    shard added in a region of its own therefore takes rows only into itself. Null keys share one
    place.
    """
    return _descend(key, "", tree)


def assign_shards(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """Every row with its shard and a gapless slot there.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, shard, slot and grown_shard
    (null without ``grown``). Null text counts as empty; a null id is a key like any other; rows
    that repeat an id go to the same shard and to neighbouring slots. Slots are numbered in slices of
    each shard, whose counts are added up first, so no task orders a whole shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slice"), key), F.lit(SLICES)).cast("int").alias("slice"),
    )
    counts = rows.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    in_shard = Window.partitionBy("shard").orderBy("slice")
    starts = counts.select(
        "shard", "slice", (F.sum("n").over(in_shard) - F.col("n")).alias("start")
    )
    in_slice = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(in_slice) - 1)
        .join(starts, ["shard", "slice"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
