"""A log of shards as a streaming source with its own positions.

A log is a folder of appends, each a folder that ``_SUCCESS`` ends, so an append is seen as a whole or not
at all. An append has one folder per shard, ``shard=<id>``, of Parquet files with ``sequence`` (a whole
number) and ``data`` (bytes). A shard's sequences grow from append to append, with one writer per shard
at a time. Appends are never changed; old ones may be removed once they have been read.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "shard_log"
SHARD_SCHEMA = "shard STRING, sequence BIGINT, data BINARY"
#: Before the first record of a shard.
TRIM_HORIZON = -1
#: Rows of one shard that one task reads, as far as whole files allow.
TASK_ROWS = 1_000_000
BATCH_ROWS = 10_000


@dataclass(frozen=True)
class Segment(InputPartition):
    """Files of one shard, of which the records after ``start`` up to ``end`` are wanted."""

    shard: str
    files: tuple[str, ...]
    start: int
    end: int


@dataclass(frozen=True)
class _File:
    path: str
    first: int
    last: int
    rows: int


def _open(path: str):
    """The filesystem that ``path`` names, and the path in it."""
    from pyarrow import fs

    if re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*:", path):
        scheme, rest = path.split(":", 1)
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme.lower(), scheme)
        rest = "//" + rest if scheme == "file" and not rest.startswith("//") else rest
        return fs.FileSystem.from_uri(f"{scheme}:{rest}")
    return fs.LocalFileSystem(), path


def _describe(filesystem, path: str) -> _File:
    """First and last sequence and the rows of one file, from its footer alone."""
    import pyarrow.parquet as pq

    with filesystem.open_input_file(path) as handle:
        footer = pq.ParquetFile(handle).metadata
        groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
    column = footer.schema.names.index("sequence")
    known = [group.column(column).statistics for group in groups if group.num_rows]
    if any(each is None or not each.has_min_max or each.null_count for each in known):
        raise ValueError(f"{path} has records without a sequence")
    if not known:
        return _File(path, 0, TRIM_HORIZON, 0)
    return _File(path, min(s.min for s in known), max(s.max for s in known), footer.num_rows)


class ShardReader(DataSourceStreamReader):
    """Positions are ``{shard: last sequence}``; a shard that has none yet is read from its start.

    The driver sees file footers only, each once. A shard with very many new records is split
    between tasks at its files.
    """

    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        self.task_rows = int(options.get("taskrows", TASK_ROWS))
        self.known: dict[str, _File] = {}

    def _log(self) -> dict[str, list[_File]]:
        from pyarrow import fs

        filesystem, root = _open(self.root)
        shards: dict[str, list[_File]] = {}
        wanted = fs.FileSelector(root, recursive=True, allow_not_found=True)
        files = [info.path for info in filesystem.get_file_info(wanted) if info.is_file]
        below = {path: path[len(root.rstrip("/")) + 1 :].split("/") for path in files}
        whole = {parts[0] for parts in below.values() if parts[1:] == ["_SUCCESS"]}
        for path, parts in below.items():
            if len(parts) != 3 or parts[0] not in whole or not parts[1].startswith("shard="):
                continue
            if parts[2].startswith(("_", ".")):
                continue
            if path not in self.known:
                self.known[path] = _describe(filesystem, path)
            shards.setdefault(unquote(parts[1][6:]), []).append(self.known[path])
        return shards

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {
            shard: last
            for shard, files in self._log().items()
            if (last := max(each.last for each in files)) > TRIM_HORIZON
        }

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        log = self._log()
        found = []
        for shard, last in end.items():
            first = start.get(shard, TRIM_HORIZON)
            if last <= first:
                continue
            if last > max((each.last for each in log.get(shard, [])), default=TRIM_HORIZON):
                raise ValueError(f"shard {shard} no longer has its records up to {last}")
            files, rows = [], 0
            for each in sorted(log[shard], key=lambda each: (each.first, each.path)):
                if not each.rows or each.last <= first or each.first > last:
                    continue
                if files and rows + each.rows > self.task_rows:
                    found.append(Segment(shard, tuple(files), first, last))
                    files, rows = [], 0
                files.append(each.path)
                rows += each.rows
            if files:
                found.append(Segment(shard, tuple(files), first, last))
        return found

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        filesystem, _ = _open(self.root)
        for path in partition.files:
            with filesystem.open_input_file(path) as handle:
                batches = pq.ParquetFile(handle).iter_batches(BATCH_ROWS, columns=["sequence", "data"])
                for batch in batches:
                    sequence = batch.column("sequence").cast(pa.int64())
                    wanted = pc.and_(
                        pc.greater(sequence, partition.start), pc.less_equal(sequence, partition.end)
                    )
                    kept = pa.record_batch(
                        [
                            pa.array([partition.shard] * len(batch), pa.string()),
                            sequence,
                            batch.column("data").cast(pa.binary()),
                        ],
                        ["shard", "sequence", "data"],
                    ).filter(wanted)
                    if len(kept):
                        yield kept


class ShardLog(DataSource):
    """``spark.readStream.format("shard_log").load(root)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SHARD_SCHEMA

    def streamReader(self, schema) -> ShardReader:
        return ShardReader({name.lower(): value for name, value in self.options.items()})


def read_shards(spark: SparkSession, root: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """The records of every shard below ``root`` as a stream: shard, sequence, data.

    The last sequence read of each shard is kept in the query's checkpoint, so a restart goes on
    after it, and a query without one starts with each shard's first record. Shards may be added at
    any time. A shard without records gives no rows; a position beyond a shard's end, after records were
    removed, stops the query, and so does a file with a null sequence.
    """
    spark.dataSource.register(ShardLog)
    return spark.readStream.format(FORMAT).option("taskRows", task_rows).load(root)


def append_shards(records: DataFrame, root: str) -> None:
    """Add records (shard, sequence, data) to the log below ``root`` as one append.

    A record without shard or sequence stops the write. Nothing is shuffled: each task writes its
    own records, in order of their sequence.
    """
    lacking = F.raise_error(F.lit("a record of a log needs a shard and a sequence"))
    rows = records.select(
        F.coalesce("shard", lacking.cast("string")).alias("shard"),
        F.coalesce(F.col("sequence").cast("bigint"), lacking.cast("bigint")).alias("sequence"),
        F.col("data").cast("binary").alias("data"),
    )
    ordered = rows.sortWithinPartitions("shard", "sequence")
    folder = f"{root.rstrip('/')}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    ordered.write.partitionBy("shard").parquet(folder)
