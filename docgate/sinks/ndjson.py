"""Dated NDJSON writer."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.sinks.dead_letter import RECORD_JSON


def write_ndjson(records: DataFrame, base: str, now: datetime | None = None) -> str:
    """Write one JSON object per row below ``base/YYYY/MM/DD/``; give the folder written.

    Nulls are kept, and the names start with ``records_<timestamp>``.
    """
    now = now or datetime.now(tz=UTC)
    path = f"{base.rstrip('/')}/{now:%Y/%m/%d}/records_{now:%Y%m%dT%H%M%S}"
    records.select(F.to_json(F.struct("*"), RECORD_JSON).alias("value")).write.mode("append").text(path)
    return path
