"""Insert-only tables keyed by (pipeline_run_id, record_id).

Parquet tables have one folder per ``pipeline_run_id``, so a write lists and reads only its own run,
however many runs the table holds. One job at a time may write a run. Catalog tables that support
row-level changes can use the same rows in a MERGE.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.operators.ordering import first_per_key
from docgate.schemas import RESULT_SCHEMA, field_types
from docgate.session import path_exists

PARTITION = "pipeline_run_id"


def align(rows: DataFrame, schema: str) -> DataFrame:
    """Cast to ``schema`` by name; columns the rows lack become NULL (additive migration)."""
    known = set(rows.columns)
    return rows.select(
        *[
            (F.col(name) if name in known else F.lit(None)).cast(kind).alias(name)
            for name, kind in field_types(schema)
        ]
    )


def read_table(spark: SparkSession, path: str, schema: str = RESULT_SCHEMA) -> DataFrame:
    """A table as ``schema`` says. Columns that older files lack read as NULL; no table is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[n for n, _ in field_types(schema)])


def run_dir(path: str, run_id: str) -> str:
    """The partition folder of one run."""
    return f"{path}/{PARTITION}={quote(run_id, safe='')}"


def insert_absent(
    rows: DataFrame,
    path: str,
    run_id: str,
    order: Sequence[str],
    schema: str = RESULT_SCHEMA,
    reduced: bool = False,
) -> int:
    """Insert the rows whose record id the run does not have yet; give the number inserted.

    The first of several rows of one record id in ``order`` wins, and rows already there are never
    touched, so writing the same batch again changes nothing. The first write of a run has nothing
    to compare with and skips the anti join; retries read one column of one partition.
    ``reduced`` rows have one row per record id already and are not shuffled.
    """
    spark = rows.sparkSession
    target = run_dir(path, run_id)
    new = rows if reduced else first_per_key(rows, ["record_id"], order)
    before = 0
    if path_exists(spark, target):
        there = spark.read.schema("record_id STRING").parquet(target)
        before = there.count()
        new = new.join(there, "record_id", "left_anti")
    align(new, schema).drop(PARTITION).write.mode("append").parquet(target)
    # Both counts come from file footers.
    return spark.read.schema("record_id STRING").parquet(target).count() - before


def write_bronze(
    results: DataFrame, root: str, run_id: str, order: Sequence[str], reduced: bool = False
) -> int:
    """Every result."""
    return insert_absent(results, f"{root}/bronze", run_id, order, reduced=reduced)


def write_gold(
    results: DataFrame,
    root: str,
    run_id: str,
    order: Sequence[str],
    gate_passed: bool,
    reduced: bool = False,
) -> int:
    """The results of a run whose gate passed."""
    if not gate_passed:
        return 0
    return insert_absent(results, f"{root}/gold", run_id, order, reduced=reduced)
