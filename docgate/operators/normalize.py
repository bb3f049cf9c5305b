"""Normalization of typed record columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docgate.functions.text import clip, squeeze
from docgate.schemas import TEXT_FIELDS


def normalized(field: str, text: Column) -> Column:
    """The cleaning rule of one field, for a column that holds its text."""
    if field in TEXT_FIELDS:
        text = squeeze(text)
    if field == "agency":
        text = F.upper(text)
    if field in ("case_status", "priority_tier"):
        text = F.lower(text)
    if field == "document_text":
        text = clip(text)
    return text


def normalize(records: DataFrame) -> DataFrame:
    """Clean the text columns of a typed record frame and drop its ``_source_`` columns."""
    kept = [field for field in records.schema if not field.name.startswith("_source_")]
    return records.select(
        *[
            normalized(field.name, F.col(field.name)).alias(field.name)
            if isinstance(field.dataType, StringType)
            else F.col(field.name)
            for field in kept
        ]
    )
