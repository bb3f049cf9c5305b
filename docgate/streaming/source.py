"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_line_stream(
    spark: SparkSession, root: str, max_files_per_batch: int | None = None
) -> DataFrame:
    """New NDJSON files below ``root`` as a stream of lines (value, source_path, source_block).

    Where to go on after a restart is the query's checkpoint; a query without one starts with the
    oldest file.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return (
        reader.text(root)
        .where(F.col("value") != "")
        .select(
            "value",
            F.col("_metadata.file_path").alias("source_path"),
            F.col("_metadata.file_block_start").alias("source_block"),
        )
    )


def read_payload_stream(
    spark: SparkSession,
    source_format: str,
    options: dict[str, str],
    data: str = "value",
) -> DataFrame:
    """Payloads of a message connector (its jar must be on the classpath), earliest first.

    The connector keeps the offsets of every shard in the query's checkpoint. A trigger takes all
    that has arrived, unless ``options`` bound it; they also win over the default set here.
    """
    defaults = {"startingOffsets": "earliest"}
    stream = spark.readStream.format(source_format).options(**{**defaults, **options}).load()
    return stream.withColumnRenamed(data, "data")
