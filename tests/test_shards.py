"""The shard log: positions of its own, restarts, new shards, hot shards."""

from __future__ import annotations

import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docgate.streaming.shards import Segment, ShardReader, append_shards, read_shards


def log(spark, root, low, high, shards=3):
    rows = spark.range(low, high).select(
        F.concat(F.lit("s-"), (F.col("id") % shards).cast("string")).alias("shard"),
        F.col("id").alias("sequence"),
        F.concat(F.lit("record "), F.col("id").cast("string")).cast("binary").alias("data"),
    )
    append_shards(rows, root)


def drain(spark, root, out, **options):
    query = (
        read_shards(spark, root, **options)
        .writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def seen(spark, out):
    rows = spark.read.parquet(f"{out}/rows").collect()
    return sorted((r.sequence, r.shard, bytes(r.data).decode()) for r in rows)


def expected(high, shards):
    return [(i, f"s-{i % shards(i)}", f"record {i}") for i in range(high)]


def test_restarts_go_on_after_the_last_sequence_of_each_shard(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    log(spark, root, 0, 90)
    drain(spark, root, out)
    assert seen(spark, out) == expected(90, lambda i: 3)
    log(spark, root, 90, 150, shards=5)  # two shards are new
    drain(spark, root, out)
    drain(spark, root, out)  # nothing is new
    assert seen(spark, out) == expected(150, lambda i: 3 if i < 90 else 5)
    newest = max(Path(out, "checkpoint", "offsets").glob("[0-9]*"), key=lambda p: int(p.name))
    assert json.loads(newest.read_text().splitlines()[-1]) == {
        "s-0": 145, "s-1": 146, "s-2": 147, "s-3": 148, "s-4": 149
    }


def test_a_hot_shard_is_split_at_its_files(spark, tmp_path):
    root = str(tmp_path / "log")
    for low in range(0, 100, 20):
        log(spark, root, low, low + 20, shards=1)
    reader = ShardReader({"path": root, "taskrows": "25"})
    end = reader.latestOffset()
    parts = reader.partitions({}, end)
    assert end == {"s-0": 99} and len(parts) >= 4
    got = [n for part in parts for batch in reader.read(part) for n in batch["sequence"].to_pylist()]
    assert sorted(got) == list(range(100))
    middle = reader.partitions({"s-0": 30}, {"s-0": 70})
    got = [n for part in middle for batch in reader.read(part) for n in batch["sequence"].to_pylist()]
    assert sorted(got) == list(range(31, 71))
    assert reader.partitions(end, end) == []


def test_empty_log_odd_names_null_data_and_lost_records(spark, tmp_path):
    root = str(tmp_path / "log")
    reader = ShardReader({"path": root})
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []
    rows = spark.createDataFrame(
        [("a/b=c d", 1, None), ("a/b=c d", 2, b"")],
        "shard string, sequence long, data binary",
    )
    append_shards(rows, root)
    with pytest.raises(Exception, match="needs a shard and a sequence"):
        append_shards(rows.withColumn("sequence", F.lit(None).cast("long")), root)
    unfinished = Path(root, "0-unfinished", "shard=z")
    unfinished.mkdir(parents=True)
    shutil.copy(next(Path(root).glob("*/shard=a*/*.parquet")), unfinished)
    (Path(root) / "note.txt").write_text("not part of the log")
    assert reader.latestOffset() == {"a/b=c d": 2}
    parts = reader.partitions({}, {"a/b=c d": 2})
    got = [row for part in parts for batch in reader.read(part) for row in batch.to_pylist()]
    assert sorted((r["sequence"], r["data"]) for r in got) == [(1, None), (2, b"")]
    assert all(isinstance(part, Segment) for part in parts)
    with pytest.raises(ValueError, match="no longer has"):
        reader.partitions({}, {"a/b=c d": 9})
