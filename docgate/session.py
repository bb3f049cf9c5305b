"""Session helpers: the shared work folder and path tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may go without: then a
    temporary folder is made once and remembered in the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.conf.get("docgate.local.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="docgate-")
        spark.conf.set("docgate.local.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def bytes_setting(spark: SparkSession, name: str) -> int:
    """A setting of the session that is a size, such as ``128MB``, in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on whatever filesystem it names."""
    filesystem, hadoop_path = _filesystem(spark, path)
    return filesystem.exists(hadoop_path)


def matches(spark: SparkSession, pattern: str) -> list[tuple[str, bool]]:
    """(path, is a folder) of all that a glob pattern matches, hidden names included."""
    filesystem, hadoop_path = _filesystem(spark, pattern)
    found = filesystem.globStatus(hadoop_path) or []
    return [(status.getPath().toString(), status.isDirectory()) for status in found]


def hidden_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files below ``pattern`` that scans skip: their name, or a folder's, starts with _ or a dot.

    The filesystem does the matching, level by level; only hidden names come back. Markers and
    folders of unfinished writes are left out.
    """
    filesystem, hadoop_path = _filesystem(spark, pattern)
    path_type = spark._jvm.org.apache.hadoop.fs.Path
    found, level = set(), pattern
    hidden = [m for m in matches(spark, pattern) if m[0].rsplit("/", 1)[-1].startswith(("_", "."))]
    while True:
        for path, folder in hidden:
            name = path.rsplit("/", 1)[-1]
            if name in ("_temporary", "_SUCCESS", "_spark_metadata"):
                continue
            if not folder:
                found.add(path)
                continue
            files = filesystem.listFiles(path_type(path), True)
            while files.hasNext():
                found.add(files.next().getPath().toString())
        below = filesystem.globStatus(path_type(f"{level}/*"))
        if below is None or len(below) == 0:
            return sorted(found)
        hidden = matches(spark, f"{level}/[_.]*")
        level = f"{level}/*"


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file between any filesystems."""
    source_fs, source_path = _filesystem(spark, source)
    target_fs, target_path = _filesystem(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        source_fs, source_path, target_fs, target_path, False, spark._jsc.hadoopConfiguration()
    )


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of one small file; None when it does not exist."""
    filesystem, hadoop_path = _filesystem(spark, path)
    if not filesystem.exists(hadoop_path):
        return None
    stream = filesystem.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write, or replace, one small file."""
    filesystem, hadoop_path = _filesystem(spark, path)
    stream = filesystem.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path`` on the same filesystem."""
    filesystem, target = _filesystem(spark, path)
    filesystem.mkdirs(target.getParent())
    filesystem.delete(target, True)
    if not filesystem.rename(_filesystem(spark, new)[1], target):
        raise OSError(f"{new} could not be moved to {path}")


def child_names(spark: SparkSession, path: str) -> set[str]:
    """Names of the visible files and folders directly in ``path``; none when it does not exist."""
    filesystem, hadoop_path = _filesystem(spark, path)
    if not filesystem.exists(hadoop_path):
        return set()
    names = (status.getPath().getName() for status in filesystem.listStatus(hadoop_path))
    return {name for name in names if not name.startswith(("_", "."))}
