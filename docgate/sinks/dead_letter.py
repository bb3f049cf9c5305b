"""Dead letters: failed records as replayable NDJSON."""

from __future__ import annotations

import logging
from datetime import UTC, datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.operators.contract import parse_contract
from docgate.schemas import RECORD_FIELDS
from docgate.session import read_small, replace_folder, write_small
from docgate.sources.ndjson import parse_lines, read_ndjson

logger = logging.getLogger(__name__)

PREFIX = "dead-letter"
LETTER_SCHEMA = (
    "record STRING, failure_stage STRING, pipeline_run_id STRING, error_message STRING, "
    "failed_at STRING"
)
RECORD_JSON = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
}


def record_json() -> Column:
    """A canonical record as JSON text that the contract accepts again."""
    return F.to_json(F.struct(*RECORD_FIELDS), RECORD_JSON)


def raw_line_json(value: Column) -> Column:
    """A line that is no JSON, wrapped so that the envelope is."""
    return F.to_json(F.struct(value.alias("_raw_line")))


def with_source(failed: DataFrame, record: Column) -> Column:
    """``record`` (JSON text) with the bucket, key and line number it came from, where known.

    They are the ``_source_`` fields that the contract drops again on replay.
    """
    fields = {
        "_source_bucket": "source_bucket",
        "_source_key": "source_key",
        "_source_line_number": "source_line",
    }
    known = [F.col(c).alias(name) for name, c in fields.items() if c in failed.columns]
    if not known:
        return record
    source = F.to_json(F.struct(*known))
    inside = F.ltrim(F.substring(F.ltrim(record, F.lit(" \t\r\n")), 2, 2**31 - 1), F.lit(" \t\r\n"))
    joined = F.concat(
        F.substring(source, 1, F.length(source) - 1),
        F.when(inside.startswith("}"), F.lit("")).otherwise(F.lit(",")),
        inside,
    )
    is_object = F.ltrim(record, F.lit(" \t\r\n")).startswith("{")
    return F.when(is_object & (source != "{}"), joined).otherwise(record)


def envelopes(
    failed: DataFrame, record: Column, *, stage: str, run_id: str, error: Column, failed_at: datetime
) -> DataFrame:
    """One JSON line (``value``) per failed row; ``record`` is JSON text, embedded with its source."""
    rest = F.to_json(
        F.struct(
            F.lit(stage).alias("failure_stage"),
            F.lit(run_id).alias("pipeline_run_id"),
            error.alias("error_message"),
            F.lit(failed_at.isoformat()).alias("failed_at"),
        )
    )
    closing = F.substring(rest, 2, 2**31 - 1)
    return failed.select(F.concat(F.lit('{"record":'), with_source(failed, record), F.lit(","), closing).alias("value"))


def write_dead_letters(
    failed: DataFrame,
    root: str,
    record: Column,
    *,
    stage: str,
    run_id: str,
    error: Column | str,
    prefix: str = PREFIX,
    now: datetime | None = None,
    rows: int | None = None,
) -> str:
    """Write failed rows below ``root/prefix/stage/YYYY/MM/DD/``; give the folder, or ``""``.

    A stage of a run has one folder, named by its first write and noted in a small file of the run's own
    beside the letters, so no other run or day is ever listed. Writing again replaces the folder, once the
    new letters are complete. Nothing is written for no rows (``rows``, where the caller has counted
    them). A failing write is logged and never stops the job.
    """
    now = now or datetime.now(tz=UTC)
    error = F.lit(error) if isinstance(error, str) else error
    path = ""
    try:
        spark = failed.sparkSession
        name = quote(run_id, safe="")
        noted = f"{root}/{prefix}-runs/{stage}/{name}"
        earlier = read_small(spark, f"{noted}/folder")
        folder = earlier or f"{now:%Y/%m/%d}/{name}_{now:%Y%m%dT%H%M%S}"
        path = f"{root}/{prefix}/{stage}/{folder}"
        none = failed.isEmpty() if rows is None else rows == 0
        if none and not earlier:
            return ""
        lines = envelopes(
            failed, record, stage=stage, run_id=run_id, error=error, failed_at=now
        )
        lines.write.mode("overwrite").text(f"{noted}/letters")
        if not earlier:
            write_small(spark, f"{noted}/folder", folder)
        replace_folder(spark, f"{noted}/letters", path)
        if none:
            return ""
    except Exception:
        logger.exception("dead letters of stage %s, run %s could not be written", stage, run_id)
        return ""
    return path


def read_dead_letters(
    spark: SparkSession, root: str, stage: str = "", prefix: str = PREFIX
) -> DataFrame:
    """(record, failure_stage, pipeline_run_id, error_message, failed_at); ``record`` is JSON text."""
    lines = read_ndjson(spark, root, f"{prefix}/{stage}")
    return lines.select(F.from_json("value", LETTER_SCHEMA).alias("letter")).select("letter.*")


def replay(letters: DataFrame) -> DataFrame:
    """Dead-lettered records back through normalization and contract."""
    return parse_contract(parse_lines(letters, "record").where(~F.col("malformed")))
