"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each node that has a link: node, root.

    ``links`` has columns a and b, in any direction and number. A round links every node's larger
    neighbours to its smallest one, then its smaller neighbours and itself to the smallest of them;
    it repeats until the links stay the same, when each component is a star around its smallest
    node. Links never grow in number. Minima are aggregated before the shuffle, written, and joined
    back, so a node with very many links is split like any skewed join key. Rounds grow with the logarithm
    of the longest chain; each is written to the shared folder, and the driver sees two numbers.
    """

    def small_to_large(pairs: DataFrame) -> DataFrame:
        return pairs.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).where("a <> b").distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    pairs = stage(small_to_large(links), "links")
    seen = mark(pairs)
    while True:
        both = pairs.union(pairs.select("b", "a"))
        least = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")
        # Large star: neighbours larger than the node, to the smallest of node and neighbours.
        large = both.join(least, F.col("a") == F.col("node")).where("b > a").select(
            F.col("b").alias("a"), F.least("a", "least").alias("b")
        )
        pairs = stage(small_to_large(large), "links")
        # Small star: smaller neighbours and the node itself, to the smallest neighbour.
        least = stage(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")
        small = pairs.join(least, F.col("a") == F.col("node")).select(
            F.explode(F.array(F.struct("b", "least"), F.struct(F.col("a").alias("b"), "least"))).alias("s")
        )
        pairs = stage(
            small_to_large(small.select(F.col("s.b").alias("a"), F.col("s.least").alias("b"))), "links"
        )
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
