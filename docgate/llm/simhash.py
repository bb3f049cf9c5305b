"""Near copies by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import stage
from docgate.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
# (lowest bit, width) of each segment. Of 4 differing bits in 3 segments, either one of the last
# two has at most one, or both have two and the first has none.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
RADIUS = (0, 1, 1)
_AT_ONCE = 100_000


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The SimHash of every whole text: doc_id, fp (long), text_key (SHA-256 of the text).

    Words are runs free of ASCII white space, A-Z in lower case; a bit is set if over half of the
    shingles' XXH64 hashes (seed 42) have it. Fewer words than a shingle make one shingle; no words,
    also null, give 0.
    """

    def digest(frames: Iterable) -> Iterator:
        import numpy as np
        import pandas as pd
        import xxhash

        hashed = xxhash.xxh64_intdigest

        def of(text: bytes | None) -> int:
            words = (text or b"").lower().split()
            n = len(words)
            if not n:
                return 0
            joined = b" ".join(words)
            if n < shingle:
                return hashed(joined, SEED)
            sizes = np.fromiter(map(len, words), np.int64, n)
            starts = np.cumsum(sizes + 1) - sizes - 1
            ends = starts[shingle - 1 :] + sizes[shingle - 1 :]
            count = np.zeros(64, dtype=np.int64)
            for at in range(0, len(ends), _AT_ONCE):
                spans = zip(
                    starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist(), strict=False
                )
                some = np.array([hashed(joined[a:b], SEED) for a, b in spans], dtype="<u8")
                bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                count += bits.sum(axis=0, dtype=np.int64)
            packed = np.packbits(2 * count > len(ends), bitorder="little")
            return int(packed.view("<u8")[0])

        for frame in frames:
            fps = np.array([of(text) for text in frame["text"]], dtype=np.uint64)
            frame["fp"] = fps.astype(np.int64)
            yield pd.DataFrame(frame[["doc_id", "fp", "text_key"]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("binary")
    key = F.unhex(F.sha2(F.coalesce(text, F.lit("").cast("binary")), 256)).alias("text_key")
    return docs.select("doc_id", text.alias("text"), key).mapInPandas(
        digest, f"doc_id {kind}, fp long, text_key binary"
    )


def _segment(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs (a, b) of different values of ``fp`` that differ in at most ``max_bits`` (4) bits.

    Multi-index hashing: each fingerprint is in a table by each of its segments, and looks up the
    Hamming ball of each segment: the segment itself, and in the last two every segment one bit
    away. Of two segments one bit apart, only the one without the bit looks up the other. Matches
    are verified on the whole fingerprint inside the join. ``fps`` must be distinct.
    """
    if max_bits > sum(RADIUS) + len(RADIUS) - 1:
        raise ValueError("the segments cover at most 4 differing bits")
    tables, probes = [], []
    for i, ((low, width), radius) in enumerate(zip(SEGMENTS, RADIUS, strict=True)):
        own = _segment(F.col("fp"), low, width)
        flips = [F.lit(0).cast("long")]
        if radius:
            free = [F.lit(1 << k).cast("long") for k in range(width)]
            flips += [F.when(own.bitwiseAND(bit) == 0, bit) for bit in free]
        tables.append(fps.select(F.lit(i).alias("table"), own.alias("value"), F.col("fp").alias("b")))
        probes.append(
            fps.select(
                F.lit(i).alias("table"),
                own.alias("own"),
                F.col("fp").alias("a"),
                F.explode(F.array_compact(F.array(*flips))).alias("flip"),
            ).select("table", F.col("own").bitwiseOR(F.col("flip")).alias("value"), "a", "flip")
        )
    table = reduce(DataFrame.union, tables)
    probe = reduce(DataFrame.union, probes)
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = (far <= max_bits) & ((F.col("flip") != 0) | (F.col("a") < F.col("b")))
    found = probe.join(
        table,
        (probe["table"] == table["table"]) & (probe["value"] == table["value"]) & near,
    )
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_copies(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Every row with its fingerprint and class.

    Returns doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links,
    null only if all ids there are null), fp, n_links (fingerprints linked to the row's own) and text_key. Copies
    share a fingerprint and are linked through it, so a group of copies is one node however large;
    texts without words share fingerprint 0. Rows that repeat an id each keep their own; an empty
    table gives no rows; other columns are ignored.
    """
    rows = stage(fingerprints(docs), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    pairs = stage(links(nodes.select("fp"), max_bits), "pairs")
    degree = (
        pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    )
    roots = stage(components(pairs), "roots")
    placed = (
        nodes.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), "first")
        .join(degree, "fp", "left")
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = placed.join(least, "root").select(
        F.col("fp").alias("of"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return rows.join(classes, F.col("fp") == F.col("of")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "fp",
        "n_links",
        "text_key",
    )


def drop_near_copies(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id, its columns unchanged.

    Of rows that share this id, the one with the smallest text hash stays. Rows without an id stay
    only in classes that have no other.
    """
    return keep_one(docs, near_copies(docs, max_bits), "fp")


def keep_one(docs: DataFrame, found: DataFrame, node: str) -> DataFrame:
    """One row of each class of ``found`` (doc_id, component_id, text_key and ``node``)."""
    # Classes without any id are told apart by node.
    alone = F.when(F.col("component_id").isNull(), F.col(node))
    keep = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component_id", alone.alias("alone"))
        .agg(F.min("text_key").alias("keep_key"))
        .select(F.col("component_id").alias("keep_id"), "keep_key")
    )
    # Whole rows travel in one column, so no name of theirs can clash.
    key = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), key.alias("key"))
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("key") == F.col("keep_key"))
    return marked.join(keep, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
