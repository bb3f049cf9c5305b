"""Decoding of streamed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from docgate.sources.ndjson import parse_lines


def decode_payloads(records: DataFrame, data: str = "data") -> DataFrame:
    """Turn ``data`` into JSON text and parse it: bytes are taken as they are, text is base64.

    Payloads that are not base64 or not one JSON object come out ``malformed``, with all other
    columns (such as the sequence number) kept to name them. ``value`` is the decoded text, or the
    payload as it came when it cannot be decoded, so that nothing is lost to the dead letter.
    """
    payload = F.col(data)
    if not isinstance(records.schema[data].dataType, BinaryType):
        payload = F.try_to_binary(payload, F.lit("base64"))
    given = F.col(data).cast("string")
    decoded = records.withColumns(
        {"value": F.coalesce(payload.cast("string"), given), "_decoded": payload.isNotNull()}
    )
    parsed = parse_lines(decoded.drop(data))
    return parsed.withColumn("malformed", F.col("malformed") | ~F.col("_decoded")).drop("_decoded")
