"""Order-dependent helpers that stay parallel when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in ``order``.

    The rank limit of 1 is applied inside each task before the shuffle, so a key with any number
    of copies sends at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``."""
    return first_per_key(rows, keys, [F.col(name).desc() for name in order])
