"""Physical plans of the queries: what must and must not be in them."""

from __future__ import annotations

import re

import pytest

from checks.queries import QUERIES
from tests.test_oracles import SF_DIR, pytestmark  # noqa: F401

# Queries whose result is a stored table carry no plan worth a look.
STORED = {
    "ndjson_scan_day",
    "stream_ingest",
    "stream_resume",
    "stream_pipeline",
    "batch_run",
    "batch_reject",
    "bronze_merge",
    "gold_merge",
    "merge_retry",
    "merge_dedupe",
    "schema_migration",
    "audit_rows",
    "audit_retry",
    "dead_letter_write",
    "dead_letter_replay",
    "dead_letter_rerun",
    "audit_many_sources",
    "audit_two_runs",
    "score_retry",
    "scoring_limits",
    "stream_gated",
    "shard_ingest",
    "shard_resume",
    "stream_unique",
    "stream_totals",
    "cost_observed",
}
IN_PYTHON = {"score_deterministic", "score_chunked", "score_isolated"}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_cross_join_and_no_needless_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    in_python = "Python" in plan or "Pandas" in plan
    assert in_python == (name in IN_PYTHON)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("source_keys", "struct<doc_id:bigint,source:string>"),
        ("cost_per_row", "struct<doc_id:bigint,n_chars:bigint>"),
        ("synth_records", "struct<doc_id:bigint>"),
        ("admission_infeasible", "struct<doc_id:bigint,source:string,n_chars:bigint>"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert set(re.findall(r"ReadSchema: (struct<.*>)", plan)) == {columns}


def test_aggregates_share_one_scan(spark):
    plan = plan_of(QUERIES["gate_counts"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
