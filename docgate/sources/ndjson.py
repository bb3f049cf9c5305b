"""Newline-delimited JSON scans with provenance."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgate.functions.once import with_once
from docgate.schemas import RECORD_FIELDS
from docgate.session import (
    bytes_setting,
    copy_file,
    hidden_files,
    matches,
    scratch_path,
)

#: Columns every scan carries. ``source_block`` and ``source_seq`` give the order inside a file.
LINE_SCHEMA = (
    "value STRING, source_bucket STRING, source_key STRING, source_block BIGINT, source_seq BIGINT"
)
#: Order of the source: files by name, then position inside the file.
SOURCE_ORDER = ["source_key", "source_block", "source_seq"]

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?"
_RAW_FIELDS = ", ".join(f"{name} VARIANT" for name in RECORD_FIELDS)
_RAW_SCHEMA = f"{_RAW_FIELDS}, _corrupt STRING"
_RAW_OPTIONS = {
    "columnNameOfCorruptRecord": "_corrupt",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
_END_KEY = "#end"
#: So many splits, about 100 bytes each, may be sent to every executor: 128 TB in splits of 128 MB.
BROADCAST_SPLITS = 1_000_000
#: Splits smaller than this are stored several to a task.
TASK_BYTES = 32 << 20


def read_ndjson(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Every non-empty line of every file whose key starts with ``prefix``, with provenance.

    ``root`` plays the bucket: ``source_bucket`` is its last path part and ``source_key`` the path
    of the file below it. A prefix is a string, not a folder: ``logs/2024-0`` takes in
    ``logs/2024-01/a``, and only a final slash ends a folder's name. Files whose names Spark's readers skip
    (``_`` or a dot in front) are copied to the shared folder under other names first, and keep
    their own keys. A line of blanks is kept; it is malformed, not empty.
    """
    root = root.rstrip("/")
    wanted = re.sub(r"([\\\[\]{}*?])", r"\\\1", prefix.lstrip("/"))
    pattern = root if not wanted else f"{root}/{wanted.rstrip('/')}" + ("" if wanted.endswith("/") else "*")
    found = matches(spark, pattern)
    scans = []
    if any(not path.rsplit("/", 1)[-1].startswith(("_", ".")) for path, _ in found) or pattern == root:
        if found:
            lines = spark.read.option("recursiveFileLookup", "true").text(pattern)
            scans.append(_with_provenance(lines, root))
    skipped = hidden_files(spark, pattern) if found else []
    if skipped:
        scans.append(_skipped_lines(spark, root, skipped))
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], LINE_SCHEMA)


def _skipped_lines(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Lines of files that the readers skip, by way of copies that they do not."""
    folder = scratch_path(spark, "skipped")
    keys = []
    for number, path in enumerate(paths):
        copy_file(spark, path, f"{folder}/{number}.txt")
        plain_root = re.sub(_SCHEME, "", root)
        keys.append((f"{number}.txt", re.sub(_SCHEME, "", path)[len(plain_root) + 1 :]))
    names = spark.createDataFrame(keys, "name STRING, own_key STRING")
    lines = spark.read.text(folder)
    named = _with_provenance(lines, root, F.col("_metadata.file_name").alias("name"))
    return named.join(names, "name").withColumn("source_key", F.col("own_key")).drop("name", "own_key")


def read_ndjson_day(spark: SparkSession, root: str, prefix: str, day: date) -> DataFrame:
    """The lines below ``root/prefix/YYYY/MM/DD`` only; a day without folder gives no rows."""
    return read_ndjson(spark, root, f"{prefix.strip('/')}/{day:%Y/%m/%d}/")


def _with_provenance(lines: DataFrame, root: str, *more: Column) -> DataFrame:
    plain_root = re.sub(_SCHEME, "", root)
    # The path comes percent-encoded, with plus signs as they are.
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    plain_path = F.regexp_replace(decoded, _SCHEME, "")
    return lines.where(F.col("value") != "").select(
        "value",
        F.lit(plain_root.rsplit("/", 1)[-1]).alias("source_bucket"),
        F.substring(plain_path, len(plain_root) + 2, 2**31 - 1).alias("source_key"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_seq"),
        *more,
    )


def row_key() -> Column:
    """Identity of an input line: equal lines of one file share it and are staged together."""
    return F.sha2(F.concat_ws("\n", F.coalesce("source_key", F.lit("")), "value"), 256)


def store_lines(lines: DataFrame, path: str | None = None, waves: int = 1) -> DataFrame:
    """``lines`` written once, with ``row_key`` and its ``wave`` (0 to ``waves`` - 1), and read again.

    How a scan cuts files into splits depends on the executors there are at that moment, so
    ``source_block`` and ``source_seq`` of two scans need not agree. Here they are fixed as data, and
    all that follows reads the same values. Waves are folders: reading one leaves the others alone.
    ``path`` is replaced; by default it is a fresh one in the shared folder. Where the session cuts files
    into splits of less than ``TASK_BYTES``, a task stores that much of them, so tasks and files
    grow with the bytes, not with the splits; the splits, and so the positions, stay as they are.
    """
    spark = lines.sparkSession
    path = path or scratch_path(spark, "lines")
    keyed = lines.withColumn("row_key", row_key()).withColumn(
        "wave", F.pmod(F.xxhash64("row_key"), F.lit(waves)).cast("int")
    )
    split = bytes_setting(spark, "spark.sql.files.maxPartitionBytes")
    if split < TASK_BYTES:
        splits = lines.rdd.getNumPartitions()
        tasks = max(-(-splits * split // TASK_BYTES), spark.sparkContext.defaultParallelism)
        keyed = keyed.coalesce(tasks) if tasks < splits else keyed
    keyed.write.mode("overwrite").option("compression", "zstd").partitionBy("wave").parquet(path)
    return spark.read.schema(keyed.schema).parquet(path)


def with_line_ordinal(lines: DataFrame, stored: bool = False) -> DataFrame:
    """Add ``line_ordinal``: the position of the line among the non-empty lines of its file, from 1.

    Lines that do not come from :func:`store_lines` (``stored``) are written by it first; their other
    columns stay. A file is never gathered in one task. Each split contributes one row (first
    position, row count); a running sum over those few rows gives every split its offset, and the
    lines get their ordinal by adding it. Up to ``BROADCAST_SPLITS`` splits, counted first, go to the
    lines, which then are not shuffled; beyond, lines and splits meet by hash.
    """
    if not stored:
        lines = store_lines(lines).drop("row_key", "wave")
    split = ["source_key", "source_block"]
    splits = lines.groupBy(*split).agg(
        F.min("source_seq").alias("first_seq"), F.count("*").alias("split_rows")
    )
    path = scratch_path(lines.sparkSession, "splits")
    splits.write.parquet(path)
    splits = lines.sparkSession.read.schema(splits.schema).parquet(path)
    earlier = Window.partitionBy("source_key").orderBy("source_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = splits.select(
        *split,
        (F.coalesce(F.sum("split_rows").over(earlier), F.lit(0)) - F.col("first_seq") + 1).alias(
            "shift"
        ),
    )
    if splits.count() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    # A stored line always finds its split; should one not, the job must stop, not lose it.
    lost = F.raise_error(F.concat(F.lit("no count for a split of "), F.col("source_key")))
    shift = F.when(F.col("shift").isNull(), lost.cast("bigint")).otherwise(F.col("shift"))
    return (
        lines.join(offsets, split, "left")
        .withColumn("line_ordinal", F.col("source_seq") + shift)
        .drop("shift")
    )


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON text into ``raw`` (one VARIANT per known field), ``keys`` and ``malformed``.

    The last of several equal keys wins. Lines that are not one JSON object - bad syntax, trailing
    text, bytes that are no UTF-8, lists, bare numbers - are ``malformed``.

    A line is parsed once, as the first member of a list whose second member proves that the parser
    reached the end of the line. Only lines that cannot be read so are parsed again, by field: broken
    ones, those with equal keys, and those that hold that member's text themselves.
    """
    text = F.col(value)
    listed = F.try_parse_json(
        F.when(
            ~F.contains(text, F.lit(f'"{_END_KEY}"')),
            F.concat(F.lit("["), text, F.lit(f',"{_END_KEY}"]')),
        )
    )
    pair = F.try_variant_get("listed", "$", "array<variant>")
    whole = (F.size("pair") == 2) & (
        F.try_variant_get(F.col("pair")[1], "$", "string") == F.lit(_END_KEY)
    )
    fields = F.when(whole, F.try_variant_get(F.col("pair")[0], "$", "map<string,variant>"))
    parsed = (
        lines.withColumn("listed", listed).withColumn("pair", pair).withColumn("fields", fields)
    )
    once, again = F.col("fields").isNotNull(), _by_field(text)
    members = [F.col("fields")[name].alias(name) for name in RECORD_FIELDS]
    read = {
        "raw": F.struct(*members, F.lit(None).cast("string").alias("_corrupt")),
        "keys": F.map_keys("fields"),
        "closed": F.lit(True),
    }
    parsed = parsed.withColumns(
        {name: F.when(once, column).otherwise(again[name]) for name, column in read.items()}
    )
    return with_once(parsed, {"malformed": _malformed(text)}).drop(
        "listed", "pair", "fields", "closed"
    )


def _by_field(text: Column) -> dict[str, Column]:
    """``raw``, ``keys`` and ``closed`` of an object, which may have equal keys; nulls for the rest."""
    keys = F.json_object_keys(text)
    # A second key after the line proves that the parser reached the end of the line.
    closed = F.json_object_keys(F.concat(F.lit('{"r":'), text, F.lit(f',"{_END_KEY}":0}}')))
    return {
        # Compiled, from_json fails on text without any token instead of giving null.
        "raw": F.when(keys.isNotNull(), F.from_json(text, _RAW_SCHEMA, _RAW_OPTIONS)),
        "keys": keys,
        "closed": closed == F.array(F.lit("r"), F.lit(_END_KEY)),
    }


def _malformed(text: Column) -> Column:
    broken = (
        F.col("raw").isNull()
        | F.col("raw._corrupt").isNotNull()
        | F.col("keys").isNull()
        | ~F.is_valid_utf8(text)
        | ~F.coalesce("closed", F.lit(False))
    )
    return F.coalesce(broken, F.lit(True))


def well_formed(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """The parsable lines. ``strict`` fails the read on the first malformed line instead."""
    if strict:
        message = F.concat(F.lit("not a JSON object: line in "), F.col("source_key"))
        return parsed.where(
            F.when(F.col("malformed"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        )
    return parsed.where(~F.col("malformed"))


def malformed_lines(parsed: DataFrame) -> DataFrame:
    """The lines that :func:`well_formed` leaves out, for the dead letter."""
    return parsed.where(F.col("malformed"))
