from __future__ import annotations

import pytest

from docgate.operators.gate import (
    document_expectations,
    gate_details,
    gate_samples,
    gate_verdict,
    gate_view,
    route,
    unexpected_outside,
)
from docgate.plans.batch import run_gate
from docgate.schemas import BETWEEN, IN_SET, NOT_NULL
from docgate.sources.ndjson import parse_lines, well_formed
from tests.helpers import lines, record


def view(spark, *records, **options):
    return gate_view(well_formed(parse_lines(lines(spark, records))), **options)


def verdict(spark, *records, **sets):
    return run_gate(view(spark, *records), document_expectations(**sets))


def test_empty_batch_passes(spark):
    result = run_gate(view(spark, record()).limit(0), document_expectations())
    assert (result.passed, result.total, result.failed, result.failure_details) == (True, 0, 0, [])


def test_valid_batch_passes(spark):
    result = verdict(spark, record(), record(), record())
    assert (result.passed, result.total, result.failed) == (True, 3, 0)


def test_one_bad_agency(spark):
    result = verdict(spark, record(), record(agency="NASA"), record())
    assert (result.passed, result.total, result.failed) == (False, 3, 1)
    assert result.failure_details == [
        {
            "expectation": IN_SET,
            "column": "agency",
            "unexpected_count": 1,
            "unexpected_values": ["NASA"],
        }
    ]


def test_null_id(spark):
    result = verdict(spark, record(record_id=None), record())
    assert [d["expectation"] for d in result.failure_details] == [NOT_NULL]


def test_a_row_counts_once_per_broken_rule(spark):
    result = verdict(spark, record(agency="NASA", pages=0, document_text="short"))
    assert (result.failed, len(result.failure_details)) == (3, 3)


def test_nulls_break_only_not_null(spark):
    result = verdict(spark, record(agency=None, pages=None, document_text=None), record())
    assert result.passed


def test_gate_sees_raw_values(spark):
    assert not verdict(spark, record(agency="uscis")).passed
    after = view(spark, record(agency="uscis", document_text=" a      b "), normalize=True)
    details = {r["column_name"]: r["unexpected_count"] for r in gate_details(after, document_expectations()).collect()}
    assert (details["agency"], details["document_text"]) == (0, 1)


def test_custom_sets(spark):
    assert verdict(spark, record(agency="NASA"), agencies=["NASA"]).passed
    assert verdict(spark, record(), agencies=[], document_types=None).passed


@pytest.mark.parametrize("pages", ["3", "x", [1]])
def test_values_that_do_not_compare_fail_with_no_count(spark, pages):
    result = verdict(spark, record(pages=pages), record())
    assert result.failure_details == [
        {"expectation": BETWEEN, "column": "pages", "unexpected_count": 0, "unexpected_values": []}
    ]


def test_booleans_and_fractions_compare(spark):
    assert verdict(spark, record(pages=True), record(pages=1.5)).passed
    assert verdict(spark, record(pages=False)).failed == 1


def test_column_no_record_has(spark):
    result = verdict(spark, record(agency=...), record(agency=...))
    assert [(d["column"], d["unexpected_count"]) for d in result.failure_details] == [("agency", 0)]
    assert verdict(spark, record(agency=...), record()).passed
    frame = spark.createDataFrame([("a",)], "record_id STRING")
    failing = gate_details(frame, document_expectations()).where("failed")
    assert failing.count() == 6
    assert gate_verdict(gate_details(frame, document_expectations())).head()["failed"] == 0


def test_samples_are_limited_per_column(spark):
    frame = spark.range(100).selectExpr(
        "lpad(cast(id AS string), 3, '0') AS record_id", "'NASA' AS agency", "0 AS pages"
    )
    rows = gate_samples(frame, document_expectations()).collect()
    assert {(r["column_name"]): 0 for r in rows} == {"agency": 0, "pages": 0}
    assert len(rows) == 40
    plan = gate_samples(frame, document_expectations())._jdf.queryExecution().executedPlan()
    assert plan.toString().count("WindowGroupLimit") == 2


def test_large_sets(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x STRING")
    allowed = spark.createDataFrame([("b",)], "value STRING")
    assert unexpected_outside(frame, "x", allowed).head()["unexpected_count"] == 2


def test_routes_are_whole(spark):
    good, bad = view(spark, record(), record()), view(spark, record(), record(agency="NASA"))
    for batch, sizes in ((good, (2, 0)), (bad, (0, 2))):
        passed, rejected = route(batch, gate_verdict(gate_details(batch, document_expectations())))
        assert (passed.count(), rejected.count()) == sizes
