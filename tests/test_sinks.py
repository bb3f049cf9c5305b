from __future__ import annotations

import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docgate.operators.contract import parse_contract
from docgate.schemas import AUDIT_SCHEMA, DEFAULT_MODEL, RESULT_SCHEMA
from docgate.sinks import audit
from docgate.sinks.dead_letter import (
    raw_line_json,
    read_dead_letters,
    record_json,
    replay,
    write_dead_letters,
)
from docgate.sinks.tables import align, insert_absent, read_table, write_bronze, write_gold
from docgate.sources.ndjson import parse_lines
from tests.helpers import lines, record

NOW = datetime(2024, 2, 1, 3, 4, 5, tzinfo=timezone.utc)


def results(spark, ids, reasoning="r"):
    rows = [(i, key, reasoning) for i, key in enumerate(ids)]
    return spark.createDataFrame(rows, "pos INT, record_id STRING, reasoning STRING").selectExpr(
        "*",
        "0.8765D AS compliance_score",
        "'low' AS risk_tier",
        "'aligned' AS policy_alignment",
        "1500 AS input_tokens",
        "300 AS output_tokens",
        "1800 AS tokens_used",
        f"'{DEFAULT_MODEL}' AS model_id",
        "timestamp'2024-01-02 00:00:00' AS classified_at",
    )


def test_insert_is_idempotent_and_first_wins(spark, tmp_path):
    root = str(tmp_path)
    assert write_bronze(results(spark, ["a", "b", "a"]), root, "run:1/x", ["pos"]) == 2
    assert write_bronze(results(spark, ["a", "b", "a"]), root, "run:1/x", ["pos"]) == 0
    assert write_bronze(results(spark, ["b", "c"], "new"), root, "run:1/x", ["pos"]) == 1
    assert write_bronze(results(spark, ["a"]), root, "run-2", ["pos"]) == 1
    rows = read_table(spark, f"{root}/bronze").collect()
    got = {(r["pipeline_run_id"], r["record_id"]): r["reasoning"] for r in rows}
    assert got == {
        ("run:1/x", "a"): "r",
        ("run:1/x", "b"): "r",
        ("run:1/x", "c"): "new",
        ("run-2", "a"): "r",
    }
    assert rows[0].asDict().keys() == {part.split()[0] for part in RESULT_SCHEMA.split(", ")}


def test_empty_batches_and_missing_tables(spark, tmp_path):
    assert read_table(spark, f"{tmp_path}/none").count() == 0
    assert write_bronze(results(spark, ["a"]).limit(0), str(tmp_path), "r", ["pos"]) == 0
    assert read_table(spark, f"{tmp_path}/bronze").count() == 0


def test_gold_needs_a_passed_gate(spark, tmp_path):
    assert write_gold(results(spark, ["a"]), str(tmp_path), "r", ["pos"], gate_passed=False) == 0
    assert write_gold(results(spark, ["a"]), str(tmp_path), "r", ["pos"], gate_passed=True) == 1


def test_old_files_read_with_the_new_columns(spark, tmp_path):
    old = results(spark, ["a"]).drop("pos", "input_tokens", "output_tokens")
    old.write.parquet(f"{tmp_path}/t/pipeline_run_id=old")
    insert_absent(results(spark, ["b"]), f"{tmp_path}/t", "new", ["pos"])
    rows = {r["record_id"]: r for r in read_table(spark, f"{tmp_path}/t").collect()}
    assert (rows["a"]["input_tokens"], rows["b"]["input_tokens"]) == (None, 1500)
    assert align(old, RESULT_SCHEMA).columns == read_table(spark, f"{tmp_path}/t").columns


def inputs(spark, *records):
    return parse_contract(parse_lines(lines(spark, records)))


def audited(spark, given, **options):
    frame = inputs(spark, *given)
    good = results(spark, [r["record_id"] for r in given])
    attached = audit.attach_inputs(good, frame, ["source_seq"])
    return audit.audit_rows(attached, run_id="run", gate_passed=True, **options)


def test_audit_row(spark, tmp_path):
    given = record()
    rows = audited(spark, [given], prompt_hash="p", source_bucket="raw", source_key="a, b")
    assert audit.write_audit(rows, f"{tmp_path}/audit", "run", ["pos"]) == 1
    row = read_table(spark, f"{tmp_path}/audit", AUDIT_SCHEMA).head()
    assert row["compliance_score"] == Decimal("0.877")
    assert (row["cost_input_usd"], row["cost_output_usd"], row["cost_usd"]) == (
        Decimal("0.004500"),
        Decimal("0.004500"),
        Decimal("0.009000"),
    )
    assert row["submitted_at"] == datetime(2024, 3, 9, 8, 45)
    assert (row["audit_id"] > 0, row["source_key"], row["prompt_hash"]) == (True, "a, b", "p")
    assert row["created_at"] is not None
    assert len(row["input_record_hash"]) == 64


def test_audit_retry_keeps_rows_and_ids(spark, tmp_path):
    path = f"{tmp_path}/audit"
    given = [record() for _ in range(6)]
    rows = audited(spark, given)
    assert audit.write_audit(rows.where("pos < 3"), path, "run", ["pos"]) == 3
    first = {r["record_id"]: r["audit_id"] for r in read_table(spark, path, AUDIT_SCHEMA).collect()}
    assert audit.write_audit(rows, path, "run", ["pos"]) == 3
    assert audit.write_audit(rows, path, "run", ["pos"]) == 0
    other = rows.withColumn("pipeline_run_id", F.lit("run-2"))
    assert audit.write_audit(other, path, "run-2", ["pos"]) == 6
    table = read_table(spark, path, AUDIT_SCHEMA).collect()
    assert len({r["audit_id"] for r in table}) == len(table) == 12
    again = {r["record_id"]: r["audit_id"] for r in table if r["pipeline_run_id"] == "run"}
    assert all(again[key] == value for key, value in first.items())


def test_result_without_input_is_an_error(spark):
    frame = inputs(spark, record())
    good = results(spark, ["lonely"])
    with pytest.raises(PySparkException, match="no input with a submission time for record lonely"):
        audit.attach_inputs(good, frame, ["source_seq"]).collect()
    assert audit.results_without_input(good, frame).count() == 1


def test_last_input_of_an_id_counts(spark):
    one = record()
    two = {**one, "submitted_at": "2026-01-01T00:00:00Z"}
    row = audit.attach_inputs(
        results(spark, [one["record_id"]]), inputs(spark, one, two), ["source_seq"]
    ).collect()
    assert [r["submitted_at"].year for r in row] == [2026]


def test_nulls_where_a_value_is_due(spark, tmp_path):
    rows = audited(spark, [record()]).withColumn("risk_tier", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="risk_tier must not be null"):
        audit.write_audit(rows, f"{tmp_path}/audit", "run", ["pos"])


def test_fingerprint_follows_the_normalized_record(spark):
    one = record(document_text="some  text that counts", agency="uscis")
    same = {**one, "document_text": " some text that counts", "agency": "USCIS", "pages": "12"}
    other = {**one, "officer_notes": None}
    hashes = [
        r["h"]
        for r in inputs(spark, one, same, other)
        .orderBy("source_seq")
        .select(audit.input_fingerprint().alias("h"))
        .collect()
    ]
    assert hashes[0] == hashes[1] != hashes[2]
    fallback = audit.with_fallback_fingerprint(
        results(spark, ["a"]).withColumn("input_record_hash", F.lit(None).cast("string"))
    )
    assert len(fallback.head()["input_record_hash"]) == 64


def test_source_labels(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("a",)], "source_key STRING")
    assert audit.run_sources(rows, "r").count() == 2
    kept = audit.audit_rows(
        results(spark, ["x"]).selectExpr("*", "'own' AS source_key", "'h' AS input_record_hash"),
        run_id="r",
        gate_passed=False,
    )
    assert kept.head()["source_key"] == "own"


def test_dead_letters_round_trip(spark, tmp_path):
    bad = record(agency="NASA", document_text='quo"te\n and é')
    frame = inputs(spark, bad)
    path = write_dead_letters(
        frame, str(tmp_path), F.col("value"), stage="classification", run_id="run", error="why", now=NOW
    )
    assert path == f"{tmp_path}/dead-letter/classification/2024/02/01/run_20240201T030405"
    letter = read_dead_letters(spark, str(tmp_path)).head()
    source = {"_source_bucket": "raw", "_source_key": "a.ndjson"}
    assert json.loads(letter["record"]) == {**source, **bad}
    assert letter.asDict() == {
        "record": letter["record"],
        "failure_stage": "classification",
        "pipeline_run_id": "run",
        "error_message": "why",
        "failed_at": NOW.isoformat(),
    }
    again = replay(read_dead_letters(spark, str(tmp_path), "classification")).head()
    assert (again["violations"], again["record_ref"]) == (["agency:not_allowed"], bad["record_id"])


def test_canonical_records_replay_as_valid(spark, tmp_path):
    frame = inputs(spark, record(submitted_at="2024-03-09T08:45:00.25+02:00", form_number=None))
    write_dead_letters(frame, str(tmp_path), record_json(), stage="s", run_id="r", error="e", now=NOW)
    again = replay(read_dead_letters(spark, str(tmp_path))).head()
    assert again["violations"] == []
    assert again["submitted_at"] == datetime(2024, 3, 9, 6, 45, 0, 250_000)


def test_lines_that_are_no_json_are_wrapped(spark, tmp_path):
    frame = lines(spark, ['{"a":'])
    write_dead_letters(
        frame, str(tmp_path), raw_line_json(F.col("value")), stage="ingestion", run_id="r", error="e"
    )
    letter = read_dead_letters(spark, str(tmp_path)).head()
    assert json.loads(letter["record"])["_raw_line"] == '{"a":'


def test_no_dead_letters_no_folder(spark, tmp_path):
    empty = lines(spark, ["x"]).limit(0)
    assert write_dead_letters(empty, str(tmp_path), F.col("value"), stage="s", run_id="r", error="e") == ""
    assert not (tmp_path / "dead-letter").exists()


def test_dead_letters_never_raise(spark, tmp_path):
    blocker = tmp_path / "file"
    blocker.write_text("x")
    rows = lines(spark, ["{}"])
    assert write_dead_letters(rows, str(blocker), F.col("value"), stage="s", run_id="r", error="e") == ""


def test_letters_of_a_run_are_replaced(spark, tmp_path):
    frame = inputs(spark, record(), record())
    made = [
        write_dead_letters(
            rows, str(tmp_path), F.col("value"), stage="s", run_id=run, error="e", now=now
        )
        for rows, run, now in (
            (frame, "r 1", NOW), (frame.limit(1), "r 1", None), (frame, "r 1_2", NOW), (frame, "r", NOW),
        )
    ]
    assert made[0] == made[1] and len(set(made)) == 3
    assert read_dead_letters(spark, str(tmp_path)).count() == 5
    none = frame.limit(0)
    assert write_dead_letters(none, str(tmp_path), F.col("value"), stage="s", run_id="r", error="e") == ""
    assert read_dead_letters(spark, str(tmp_path)).count() == 3
