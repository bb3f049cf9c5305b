"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``columns`` (replacing equal names) so that later filters reuse their values.

    A filter on a plain projected column is moved below the projection, with the column's whole
    expression copied into it; through several layers of parsing the copies multiply. Here the
    projection computes the values, and unnesting a one-element list of them keeps the filter above.
    """
    kept = [name for name in rows.columns if name not in columns]
    staged = rows.select(
        *kept, *[column.alias(f"_once_{name}") for name, column in columns.items()]
    )
    values = F.struct(*[F.col(f"_once_{name}").alias(name) for name in columns])
    return staged.select(*kept, F.inline(F.array(values)))
