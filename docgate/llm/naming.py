"""Exact copies by deterministic block naming.

Texts are cut into blocks of fixed size. All blocks are sorted and their ranks become integer
names; then adjacent pairs of names are sorted and named again, level by level, until each document
is one name. Equal names at the same level mean equal texts, without any hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import named, one_spaced, stage

BLOCK_CHARS = 4096


def name_texts(rows: DataFrame, text: str, row: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One identity (``level``, ``name``) per row; equal exactly for equal texts.

    ``row`` must identify a row; the other columns are carried along. Null text counts as empty.
    The text is shuffled once; every later level moves integers only, half as many each time.
    """
    carried = [c for c in rows.columns if c not in (text, row)]
    cut = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?s).{{1,{block_chars}}}"), 0)
    blocks = rows.select(
        F.col(row).alias("row"),
        F.struct(*carried).alias("carried"),
        F.posexplode(F.when(F.size(cut) > 0, cut).otherwise(F.array(F.lit("")))).alias(
            "place", "block"
        ),
        F.greatest(F.size(cut), F.lit(1)).alias("left"),
    ).withColumn("carried", F.when(F.col("place") == 0, F.col("carried")))
    blocks = blocks.withColumns(
        {"start": F.substring("block", 1, 16), "hash": F.xxhash64("block")}
    )
    ties = ["row", "place"]
    names = stage(named(blocks, ["block"], ties, "name", coarse=["start", "hash"]), "blocks")
    most = names.agg(F.max("left")).first()[0] or 1
    done, level = [], 0
    while True:
        done.append(names.where("left = 1").select("row", "carried", F.lit(level).alias("level"), "name"))
        if most == 1:
            break
        pairs = (
            names.where("left > 1")
            .groupBy("row", F.expr("place div 2").cast("int").alias("place"))
            .agg(
                F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("a"),
                F.max(F.when(F.col("place") % 2 == 1, F.col("name"))).alias("b"),
                F.max("carried").alias("carried"),
                F.ceil(F.max("left") / 2).cast("int").alias("left"),
            )
        )
        names = stage(named(stage(pairs, "pairs"), ["a", "b"], ties, "name"), "level")
        most, level = (most + 1) // 2, level + 1
    return reduce(DataFrame.unionByName, done).select(
        F.col("row").alias(row), *[F.col(f"carried.{c}").alias(c) for c in carried], "level", "name"
    )


def exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Every row with its group of equal texts.

    Texts are equal when identical after each run of ASCII white space became one blank; null
    counts as empty. Returns doc_id, keep_id (smallest id of the group, nulls last), group_size,
    kept, text_sha256. Rows that repeat an id are separate rows: exactly one row of a group is
    kept. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        one_spaced(F.col(text_col)).alias("text"),
    ).withColumn("sha", F.unhex(F.sha2("text", 256)))
    found = stage(name_texts(rows, "text", "row", block_chars), "identities")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    # Written before the join: only between two plain exchanges is a hot group split.
    groups = found.groupBy("level", "name").agg(
        first.alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    groups = stage(groups, "groups")
    return found.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, its columns unchanged."""
    keep = (
        exact_copies(docs, id_col, text_col)
        .where("kept")
        .select(F.col("doc_id").alias("keep_id"), F.unhex("text_sha256").alias("keep_sha"))
    )
    # Whole rows travel in one column, so no name of theirs can clash.
    marked = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(one_spaced(F.col(text_col)), 256)).alias("sha"),
    )
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha"))
    return marked.join(keep, same, "left_semi").dropDuplicates(["id", "sha"]).select("row.*")
