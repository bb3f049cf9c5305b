"""Quality gate: column expectations over a whole raw batch, in one aggregate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgate.functions import coerce
from docgate.operators.normalize import normalized
from docgate.schemas import (
    AGENCIES,
    BETWEEN,
    DOCUMENT_TYPES,
    IN_SET,
    LENGTH_BETWEEN,
    MIN_PAGES,
    MIN_TEXT_LENGTH,
    NOT_NULL,
    PRIORITY_TIERS,
    UNEXPECTED_SAMPLE,
)
from docgate.session import scratch_path

#: So many distinct values, counted first, may be sent to every executor.
BROADCAST_VALUES = 1_000_000
SALTS = 16

DETAIL_SCHEMA = "expectation STRING, column_name STRING, unexpected_count BIGINT, failed BOOLEAN"


@dataclass(frozen=True)
class Expectation:
    """A named rule on one column. ``unexpected`` turns the column into "this value breaks it".

    ``allowed`` is for sets too large to list: a frame whose first column holds the values.
    """

    kind: str
    column: str
    unexpected: Callable[[Column], Column]
    allowed: DataFrame | None = None


def not_null(column: str) -> Expectation:
    return Expectation(NOT_NULL, column, lambda c: c.isNull())


def in_set(column: str, allowed: Sequence[str]) -> Expectation:
    return Expectation(IN_SET, column, lambda c: ~c.isin(list(allowed)))


def in_frame(column: str, allowed: DataFrame) -> Expectation:
    """Like :func:`in_set`, with the set in the first column of a frame of any size.

    It shares the gate's one aggregate: :func:`with_marks` marks the rows first.
    """
    return Expectation(IN_SET, column, lambda c: c.isNotNull(), allowed)


def at_least(column: str, minimum: int) -> Expectation:
    return Expectation(BETWEEN, column, lambda c: c < minimum)


def min_length(column: str, minimum: int) -> Expectation:
    return Expectation(LENGTH_BETWEEN, column, lambda c: F.char_length(c) < minimum)


def document_expectations(
    document_types: Sequence[str] | None = None,
    agencies: Sequence[str] | None = None,
    priority_tiers: Sequence[str] | None = None,
) -> list[Expectation]:
    """The seven expectations on raw documents; an empty or absent list means the default set."""
    return [
        not_null("record_id"),
        not_null("submitted_at"),
        in_set("document_type", document_types or DOCUMENT_TYPES),
        in_set("agency", agencies or AGENCIES),
        in_set("priority_tier", priority_tiers or PRIORITY_TIERS),
        at_least("pages", MIN_PAGES),
        min_length("document_text", MIN_TEXT_LENGTH),
    ]


def gate_view(parsed: DataFrame, normalize: bool = False) -> DataFrame:
    """The gate's columns of parsed JSON records, by default before any normalization.

    Next to each column, ``_absent_<column>`` tells that the record has no such key and
    ``_clash_<column>`` that its value cannot be compared (text where a number is due).
    """
    columns = [e.column for e in document_expectations()]
    kinds = {name: coerce.kind(F.col(f"raw.{name}")) for name in columns}
    view = {}
    for name in columns:
        value = F.col(f"raw.{name}")
        shown = F.when(kinds[name] != "VOID", coerce.shown(value))
        if name == "pages":
            numeric = F.coalesce(
                coerce.number(value), F.try_variant_get(value, "$", "boolean").cast("int")
            )
            truth = F.when(kinds[name] == "BOOLEAN", numeric).otherwise(coerce.number(value))
            view["_clash_pages"] = shown.isNotNull() & truth.isNull()
            shown = truth
        view[name] = normalized(name, shown) if normalize and name != "pages" else shown
        view[f"_absent_{name}"] = value.isNull()
    return parsed.select(*[c.alias(n) for n, c in view.items()])


def with_marks(
    batch: DataFrame, expectations: Sequence[Expectation], bound: int = BROADCAST_VALUES
) -> tuple[DataFrame, list[Expectation]]:
    """``batch`` with a mark for every expectation on a frame, and expectations that read the marks.

    Up to ``bound`` distinct allowed values, counted first, are broadcast, and the rows stay where
    they are. Beyond, the column is reduced to its distinct values, and those outside the set, which
    are few in a sound batch, are written once and broadcast under the same bound, or joined with a
    salt where they too are many, so that a hot value is no hot task. Repeated and null values of
    ``allowed`` change nothing; null in the column breaks nothing; an empty set allows no value.
    """
    marked, plain = batch, []
    for i, expectation in enumerate(expectations):
        column = expectation.column
        if expectation.allowed is None or column not in batch.columns:
            plain.append(expectation)
            continue
        value, mark = f"_value_{i}", f"_mark_{i}"
        first = F.col(f"`{expectation.allowed.columns[0]}`").cast(batch.schema[column].dataType)
        wanted = expectation.allowed.select(first.alias(value)).where(F.col(value).isNotNull()).distinct()
        listed = wanted.limit(bound + 1).count() <= bound
        if not listed:
            present = batch.select(F.col(column).alias(value)).where(F.col(value).isNotNull()).distinct()
            outside = present.join(wanted, value, "left_anti")
            path = scratch_path(batch.sparkSession, "outside")
            outside.write.parquet(path)
            wanted = batch.sparkSession.read.schema(outside.schema).parquet(path)
        values = wanted.withColumn(mark, F.lit(True))
        if listed or values.count() <= bound:
            marked = marked.join(F.broadcast(values), F.col(column) == F.col(value), "left")
        else:
            salt = f"_salt_{i}"
            salts = values.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            salted = marked.withColumn("_own_salt", (F.rand() * SALTS).cast("int"))
            met = (F.col(column) == F.col(value)) & (F.col("_own_salt") == F.col(salt))
            marked = salted.join(salts, met, "left").drop("_own_salt", salt)
        found = F.col(mark).isNotNull()
        broken = F.col(column).isNotNull() & (~found if listed else found)
        marked = marked.withColumn(mark, broken).drop(value)
        plain.append(replace(expectation, unexpected=lambda _, m=mark: F.col(m), allowed=None))
    return marked, plain


def gate_details(batch: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: kind, column, unexpected count, failed.

    Nulls break only the not-null rules. A column that the whole batch lacks, or one that holds
    values which cannot be compared, fails its expectation with a count of 0. All expectations
    share one aggregate over one scan.
    """
    batch, expectations = with_marks(batch, expectations)
    columns = set(batch.columns)
    counts, rows = [F.count(F.lit(1)).alias("total")], []
    for i, expectation in enumerate(expectations):
        name = expectation.column
        if name not in columns:
            rows.append((expectation, F.lit(0), F.col("total") > 0))
            continue
        counts.append(F.count_if(expectation.unexpected(F.col(name))).alias(f"bad_{i}"))
        broken = F.lit(False)
        if f"_absent_{name}" in columns:
            counts.append(F.count_if(F.col(f"_absent_{name}")).alias(f"absent_{i}"))
            broken = broken | (F.col(f"absent_{i}") == F.col("total"))
        if f"_clash_{name}" in columns:
            counts.append(F.count_if(F.col(f"_clash_{name}")).alias(f"clash_{i}"))
            broken = broken | (F.col(f"clash_{i}") > 0)
        broken = broken & (F.col("total") > 0)
        bad = F.when(broken, F.lit(0)).otherwise(F.col(f"bad_{i}"))
        rows.append((expectation, bad, broken | (bad > 0)))
    entries = [
        F.struct(
            F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column_name"),
            bad.cast("bigint").alias("unexpected_count"),
            failed.alias("failed"),
        )
        for e, bad, failed in rows
    ]
    return batch.agg(*counts).select("total", F.inline(F.array(*entries)))


def gate_verdict(details: DataFrame) -> DataFrame:
    """One row: passed, total, failed, failing_expectations.

    ``failed`` adds up the counts of the failing expectations, so a row may count several times.
    """
    return details.agg(
        (~F.bool_or("failed")).alias("passed"),
        F.max("total").alias("total"),
        F.sum("unexpected_count").alias("failed"),
        F.count_if("failed").cast("int").alias("failing_expectations"),
    )


def gate_samples(
    batch: DataFrame, expectations: Sequence[Expectation], order: Sequence[str] = ("record_id",)
) -> DataFrame:
    """Sample values of every expectation: the first unexpected ones in ``order``.

    One pass marks the broken (column, value) cells and explodes only those; the rank limit is
    applied inside each task before the shuffle, so a column broken in every row stays cheap.
    """
    batch, expectations = with_marks(batch, expectations)
    known = [e for e in expectations if e.column in batch.columns]
    cells = F.filter(
        F.array(
            *[
                F.when(
                    e.unexpected(F.col(e.column)),
                    F.struct(
                        F.lit(e.kind).alias("expectation"),
                        F.lit(e.column).alias("column_name"),
                        F.col(e.column).cast("string").alias("value"),
                    ),
                )
                for e in known
            ]
        ),
        lambda cell: cell.isNotNull(),
    )
    exploded = batch.select(
        *[F.col(name).alias(f"_order_{i}") for i, name in enumerate(order)],
        F.inline(cells),
    )
    ranked = Window.partitionBy("expectation", "column_name").orderBy(
        *[f"_order_{i}" for i in range(len(order))]
    )
    return (
        exploded.withColumn("sample_rank", F.row_number().over(ranked))
        .where(F.col("sample_rank") <= UNEXPECTED_SAMPLE)
        .select("expectation", "column_name", "sample_rank", "value")
    )


def unexpected_outside(batch: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Count of values outside an allowed set too large to list: (column_name, unexpected_count).

    The batch is reduced to its distinct values first, so a hot value is one row in the join.
    """
    values = batch.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    wanted = allowed.select(F.col(allowed.columns[0]).alias(column))
    return values.join(wanted, column, "left_anti").agg(
        F.lit(column).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("unexpected_count"),
    )


def route(batch: DataFrame, verdict: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, rejected) branches of a batch: all of its rows in one, none in the other.

    The verdict is read as a scalar subquery, so both branches stay lazy.
    """
    passed = verdict.select("passed").scalar()
    return batch.where(passed), batch.where(~passed)
