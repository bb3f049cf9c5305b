from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docgate.operators.contract import check_contract, parse_contract, split_contract
from docgate.operators.normalize import normalize
from docgate.sources.ndjson import parse_lines
from tests.helpers import lines, record


def checked(spark, *records):
    rows = parse_contract(parse_lines(lines(spark, records))).orderBy("source_seq").collect()
    return rows if len(rows) > 1 else rows[0]


def violations(spark, **changes):
    return checked(spark, record(**changes))["violations"]


def test_valid_record_keeps_its_values(spark):
    row = checked(spark, record(document_type="I-130 Petition"))
    assert row["violations"] == []
    assert (row["agency"], row["pages"], row["flags"]) == ("USCIS", 12, ["expedited_review"])


def test_minimal_record(spark):
    row = checked(spark, record(form_number=..., flags=..., officer_notes=...))
    assert row["violations"] == []
    assert (row["form_number"], row["flags"], row["officer_notes"]) == (None, [], None)


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({"surprise_field": 1}, "surprise_field:unknown"),
        ({"document_text": "short"}, "document_text:too_short"),
        ({"document_text": "  a   b   c     d   "}, "document_text:too_short"),
        ({"priority_tier": "critical"}, "priority_tier:not_allowed"),
        ({"priority_tier": " standard"}, "priority_tier:not_allowed"),
        ({"agency": "NASA"}, "agency:not_allowed"),
        ({"agency": "USCIS "}, "agency:not_allowed"),
        ({"pages": 0}, "pages:too_small"),
        ({"pages": 3.5}, "pages:invalid"),
        ({"pages": None}, "pages:invalid"),
        ({"flags": None}, "flags:invalid"),
        ({"flags": "a"}, "flags:invalid"),
        ({"record_id": "x"}, "record_id:invalid"),
        ({"record_id": ...}, "record_id:missing"),
        ({"submitted_at": "yesterday"}, "submitted_at:invalid"),
        ({"officer_notes": 7}, "officer_notes:invalid"),
        ({"applicant_id": 7}, "applicant_id:invalid"),
        ({"case_status": None}, "case_status:invalid"),
    ],
)
def test_each_rule(spark, changes, expected):
    assert violations(spark, **changes) == [expected]


def test_source_fields_are_dropped_not_refused(spark):
    assert violations(spark, _source_key="k", _source_line_number=1) == []


def test_normalization_before_checks(spark):
    row = checked(
        spark,
        record(
            agency="uscis",
            case_status=" PENDING ",
            priority_tier="EXPEDITE",
            document_text="  lots   of    spaces   here  ",
            form_number="",
        ),
    )
    assert row["violations"] == []
    assert row["document_text"] == "lots of spaces here"
    assert (row["agency"], row["case_status"], row["priority_tier"]) == (
        "USCIS",
        "pending",
        "expedite",
    )
    assert row["form_number"] == ""


def test_long_text_is_cut(spark):
    row = checked(spark, record(document_text="A" * 15_000))
    assert row["document_text"] == "A" * 10_000


def test_last_of_equal_keys_wins(spark):
    import json

    text = json.dumps(record())
    row = checked(spark, '{"agency":"NASA",' + text[1:])
    assert (row["violations"], row["agency"]) == ([], "USCIS")


def test_reference_for_messages(spark):
    rows = checked(spark, record(record_id=...), record(record_id="x"), record(record_id=5))
    assert [row["record_ref"] for row in rows] == ["<unknown>", "x", "5"]


def test_strict_names_the_record(spark):
    frame = parse_contract(parse_lines(lines(spark, [record(agency=..., record_id="r-1")])))
    with pytest.raises(PySparkException, match="contract broken by record r-1"):
        split_contract(frame, strict=True)[0].collect()


def test_typed_frames(spark):
    rows = spark.createDataFrame(
        [("12345678-1234-5678-1234-567812345678", "uscis", "  long enough   text ", 0)],
        "record_id STRING, agency STRING, document_text STRING, pages INT",
    ).withColumn("_source_key", F.lit("k"))
    row = check_contract(normalize(rows)).head()
    assert row["document_text"] == "long enough text"
    assert row["violations"] == [
        "submitted_at:missing",
        "document_type:missing",
        "applicant_id:missing",
        "case_status:missing",
        "priority_tier:missing",
        "pages:too_small",
    ]


def test_filter_on_violations_does_not_copy_the_parsing(spark):
    valid, _ = split_contract(parse_contract(parse_lines(lines(spark, [record()]))))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize(
    "changes",
    [
        {"pages": "1_" * 100_000},
        {"pages": " " * 100_000},
        {"submitted_at": "2024-03-09T08:45:00." + "1" * 100_000 + "x"},
        {"submitted_at": "1" * 100_000},
        {"record_id": "a-" * 100_000},
    ],
)
def test_hostile_text_is_invalid_and_nothing_more(spark, changes):
    assert violations(spark, **changes) == [f"{next(iter(changes))}:invalid"]
