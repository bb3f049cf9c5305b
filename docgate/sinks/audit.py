"""Audit rows: one per classified record, with cost, provenance and fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.functions.text import fingerprint, python_json
from docgate.operators.cost import UNKNOWN_SOURCE, source_counts, with_row_cost
from docgate.operators.ordering import first_per_key, last_per_key
from docgate.schemas import AUDIT_NULLABLE, AUDIT_SCHEMA, RECORD_FIELDS, field_types
from docgate.sinks.tables import insert_absent


def input_fingerprint() -> Column:
    """SHA-256 of the canonical JSON of a normalized record."""
    return fingerprint(RECORD_FIELDS)


def python_fingerprint(records: DataFrame) -> Column:
    """SHA-256 of a record's JSON as Python prints it, for tables whose hashes Python programs made."""
    return F.sha2(python_json(records, RECORD_FIELDS), 256)


def attach_inputs(results: DataFrame, inputs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``submitted_at`` and ``input_record_hash`` of each result's input record.

    Of several inputs with one record id the last in ``order`` counts. Reading a result without
    input is an error that names it.
    """
    wanted = inputs.select(
        "record_id", *order, "submitted_at", input_fingerprint().alias("input_record_hash")
    )
    latest = last_per_key(wanted, ["record_id"], order).drop(*order)
    message = F.concat(F.lit("no input with a submission time for record "), F.col("record_id"))
    joined = results.drop("submitted_at", "input_record_hash").join(latest, "record_id", "left")
    return joined.withColumn(
        "submitted_at",
        F.when(
            F.col("submitted_at").isNull(), F.raise_error(message).cast("timestamp")
        ).otherwise(F.col("submitted_at")),
    )


def results_without_input(results: DataFrame, inputs: DataFrame) -> DataFrame:
    """Results that have no input record with a submission time."""
    known = inputs.where(F.col("submitted_at").isNotNull()).select("record_id").distinct()
    return results.join(known, "record_id", "left_anti")


def with_fallback_fingerprint(results: DataFrame) -> DataFrame:
    """Fill missing input hashes with the hash of the record id alone."""
    own = F.sha2(F.to_json(F.struct("record_id")), 256)
    return results.withColumn("input_record_hash", F.coalesce("input_record_hash", own))


def audit_rows(
    results: DataFrame,
    *,
    run_id: str,
    gate_passed: bool,
    prompt_hash: str = "unknown",
    source_bucket: str | None = None,
    source_key: str | None = None,
    prices=None,
) -> DataFrame:
    """Audit columns for results that carry ``submitted_at`` and ``input_record_hash``.

    Without ``source_key`` each row keeps the key it came from; ``run_sources`` lists those of a run.
    """
    stamped = with_row_cost(with_fallback_fingerprint(results), prices).withColumns(
        {
            "pipeline_run_id": F.lit(run_id),
            "quality_gate_passed": F.lit(gate_passed),
            "prompt_hash": F.lit(prompt_hash),
            "created_at": F.current_timestamp(),
        }
    )
    if source_bucket is not None or "source_bucket" not in results.columns:
        stamped = stamped.withColumn("source_bucket", F.lit(source_bucket))
    own = F.col("source_key") if "source_key" in results.columns else F.lit(None).cast("string")
    given = own if source_key is None else F.lit(source_key)
    return stamped.withColumn("source_key", F.coalesce(given, F.lit(UNKNOWN_SOURCE)))


def _asserted(rows: DataFrame) -> DataFrame:
    """Make a NULL in a column that must have a value an error that names the column."""
    optional = {*AUDIT_NULLABLE, "audit_id"}
    columns = []
    for name, kind in field_types(AUDIT_SCHEMA):
        if name in optional or name not in rows.columns:
            continue
        message = F.lit(f"audit column {name} must not be null")
        columns.append(
            F.when(F.col(name).isNull(), F.raise_error(message).cast(kind))
            .otherwise(F.col(name))
            .alias(name)
        )
    known = {name for name, _ in field_types(AUDIT_SCHEMA)} - optional
    return rows.select(*[F.col(n) for n in rows.columns if n not in known], *columns)


def audit_id(run_id: str) -> Column:
    """A number for each (run, record): the same whenever and by whomever the row is written.

    It needs no look at other runs, so any number of writers may write at the same time. 63 bits of
    hash: in a table of a billion rows two share a number with a chance of about one in twenty; the
    key of the table is the pair itself.
    """
    hashed = F.xxhash64(F.lit(run_id), F.col("record_id"))
    return hashed.bitwiseAND(F.lit(2**63 - 1))


def write_audit(
    rows: DataFrame, path: str, run_id: str, order: Sequence[str], reduced: bool = False
) -> int:
    """Insert audit rows with one commit; pairs (run, record) already there stay as they are.

    ``reduced`` rows have one row per record id already.
    """
    numbered = _asserted(rows).withColumn("audit_id", audit_id(run_id))
    return insert_absent(numbered, path, run_id, order, AUDIT_SCHEMA, reduced=reduced)


def run_sources(records: DataFrame, run_id: str) -> DataFrame:
    """(pipeline_run_id, source_key, records): every source of a run, however many."""
    return source_counts(records).withColumn("pipeline_run_id", F.lit(run_id))


def staged_for_audit(staged: DataFrame, order: Sequence[str]) -> DataFrame:
    """One audit-ready row per record id of staged rows.

    The first classified row of a record id counts, with the submission time of its last input row.
    Both sides are reduced to one row per record id before they meet, inside each task before the
    shuffle, so a record id with many copies is no hot spot; the join reuses their partitioning.
    """
    first = first_per_key(staged.where(F.col("error_code").isNull()), ["record_id"], order)
    last = last_per_key(staged.select("record_id", *order, "submitted_at"), ["record_id"], order)
    return first.drop("submitted_at").join(last.drop(*order), "record_id")
