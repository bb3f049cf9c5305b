"""The batch job: scan, gate, contract, score, then bronze, gold, audit and dead letters."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.errors import GateRejected
from docgate.operators.cost import run_cost
from docgate.operators.gate import (
    Expectation,
    document_expectations,
    gate_details,
    gate_samples,
    gate_view,
    with_marks,
)
from docgate.plans.staging import Scoring, dead_letter_failures, stage
from docgate.sinks.audit import (
    audit_rows,
    run_sources,
    staged_for_audit,
    write_audit,
)
from docgate.sinks.dead_letter import raw_line_json, write_dead_letters
from docgate.sinks.tables import run_dir, write_bronze, write_gold
from docgate.sources.ndjson import (
    SOURCE_ORDER,
    malformed_lines,
    parse_lines,
    read_ndjson,
    store_lines,
    well_formed,
    with_line_ordinal,
)

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class GateResult:
    """What the driver needs of a verdict: a few numbers and short samples."""

    passed: bool
    total: int
    failed: int
    failure_details: list[dict]


@dataclass(frozen=True)
class BatchReport:
    run_id: str
    gate: GateResult
    bronze_rows: int
    gold_rows: int
    audit_rows: int
    dead_letters: dict[str, str]
    cost: dict


def new_run_id() -> str:
    """A run id for callers that have none."""
    return str(uuid.uuid4())


def run_gate(
    batch: DataFrame, expectations: Sequence[Expectation], order: Sequence[str] = ("record_id",)
) -> GateResult:
    """Evaluate the gate; one aggregate, and one more pass for samples only when it fails."""
    batch, expectations = with_marks(batch, expectations)
    rows = gate_details(batch, expectations).collect()
    failing = [row for row in rows if row["failed"]]
    samples = {}
    if failing:
        for row in gate_samples(batch, expectations, order).orderBy("sample_rank").collect():
            samples.setdefault((row["expectation"], row["column_name"]), []).append(row["value"])
    return GateResult(
        passed=not failing,
        total=rows[0]["total"] if rows else 0,
        failed=sum(row["unexpected_count"] for row in failing),
        failure_details=[
            {
                "expectation": row["expectation"],
                "column": row["column_name"],
                "unexpected_count": row["unexpected_count"],
                "unexpected_values": samples.get((row["expectation"], row["column_name"]), [])
                if row["unexpected_count"]
                else [],
            }
            for row in failing
        ],
    )


def run_batch(
    spark: SparkSession,
    root: str,
    prefix: str,
    out: str,
    scoring: Scoring,
    *,
    run_id: str | None = None,
    prompt_hash: str | None = None,
    expectations: Sequence[Expectation] | None = None,
    gate_after_normalize: bool = False,
    stop_on_reject: bool = True,
    bronze_on_reject: bool = False,
) -> BatchReport:
    """Screen every NDJSON record below ``root/prefix`` and write the tables below ``out``.

    A batch that fails the gate goes to the dead letter as a whole and raises
    :class:`GateRejected`; with ``stop_on_reject=False`` it goes on, without gold (and without
    bronze unless ``bronze_on_reject``). Running again with the same ``run_id`` pays for no second
    call and inserts nothing twice. The source is read once: its lines are kept below ``out/lines``
    until the run is repeated, and everything else reads them there.
    """
    run_id = run_id or new_run_id()
    out = out.rstrip("/")
    lines = store_lines(
        read_ndjson(spark, root, prefix), run_dir(f"{out}/lines", run_id), scoring.waves
    )
    view = batch_view(lines, gate_after_normalize, scoring.strict)
    gate = run_gate(view, expectations or document_expectations())
    numbered = with_line_ordinal(lines, stored=True)
    if not gate.passed and stop_on_reject:
        _reject(parse_lines(numbered), out, run_id, gate)

    staged = stage(numbered, f"{out}/staging", run_id, scoring)
    good = reduce_run(staged, f"{out}/reduced", run_id)
    keep_bronze = gate.passed or bronze_on_reject
    bronze = write_bronze(good, out, run_id, SOURCE_ORDER, reduced=True) if keep_bronze else 0
    gold = write_gold(good, out, run_id, SOURCE_ORDER, gate.passed, reduced=True)
    sources = run_sources(staged, run_id).drop("pipeline_run_id")
    sources.write.mode("overwrite").parquet(run_dir(f"{out}/run_sources", run_id))
    audited = audit_reduced(good, out, run_id, scoring, gate.passed, prompt_hash)
    billed = staged.where(F.col("billed"))
    spent = run_cost(billed, scoring.model_id, scoring.prices).head().asDict()
    logger.info("run %s cost %s", run_id, spent)
    return BatchReport(
        run_id=run_id,
        gate=gate,
        bronze_rows=bronze,
        gold_rows=gold,
        audit_rows=audited,
        dead_letters=dead_letter_failures(staged, out, run_id),
        cost=spent,
    )


def batch_view(lines: DataFrame, normalize: bool = False, strict: bool = False) -> DataFrame:
    """What the gate sees of a batch: it needs no line numbers."""
    return gate_view(well_formed(parse_lines(lines), strict=strict), normalize=normalize)


def reduce_run(staged: DataFrame, path: str, run_id: str) -> DataFrame:
    """One classified row per record id of a staged run, written once for all tables of the run.

    This is the run's only shuffle of results; bronze, gold and audit are written from it as it is.
    """
    valid = staged.where(F.col("record_id").isNotNull() & F.col("input_record_hash").isNotNull())
    reduced = staged_for_audit(valid, SOURCE_ORDER)
    folder = run_dir(path, run_id)
    reduced.drop("pipeline_run_id").write.mode("overwrite").parquet(folder)
    rows = staged.sparkSession.read.schema(reduced.drop("pipeline_run_id").schema).parquet(folder)
    return rows.withColumn("pipeline_run_id", F.lit(run_id))


def audit_reduced(
    reduced: DataFrame,
    out: str,
    run_id: str,
    scoring: Scoring,
    gate_passed: bool,
    prompt_hash: str | None = None,
    source_bucket: str | None = None,
) -> int:
    """Write the audit rows of a run that :func:`reduce_run` has reduced."""
    rows = audit_rows(
        reduced,
        run_id=run_id,
        gate_passed=gate_passed,
        prompt_hash=prompt_hash or scoring.prompt_hash,
        source_bucket=source_bucket,
        prices=scoring.prices,
    )
    return write_audit(rows, f"{out}/audit", run_id, SOURCE_ORDER, reduced=True)


def _reject(parsed: DataFrame, out: str, run_id: str, gate: GateResult) -> None:
    rules = ", ".join(f"{d['expectation']} on {d['column']}" for d in gate.failure_details)
    message = f"gate closed: {gate.failed} defects in {gate.total} records ({rules})"
    parsed = parsed.withColumnRenamed("line_ordinal", "source_line")
    write_dead_letters(
        well_formed(parsed),
        out,
        F.col("value"),
        stage="quality_gate",
        run_id=run_id,
        error=message,
    )
    write_dead_letters(
        malformed_lines(parsed),
        out,
        raw_line_json(F.col("value")),
        stage="ingestion",
        run_id=run_id,
        error=F.concat(F.lit("not a JSON object: line in "), F.col("source_key")),
    )
    raise GateRejected(message)
