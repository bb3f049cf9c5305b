"""Schemas and fixed values of the document-screening data model."""

from __future__ import annotations

from decimal import Decimal

# --------------------------------------------------------------------------
# Fixed values. These decide results, so they are stated here as they must be.
# --------------------------------------------------------------------------

AGENCIES = ["USCIS", "CBP", "ICE", "TSA", "FEMA"]
PRIORITY_TIERS = ["standard", "expedite", "emergency"]
DOCUMENT_TYPES = [
    "I-130 Petition",
    "I-485 Adjustment",
    "I-765 EAD",
    "I-140 Immigrant Petition",
    "I-20 Student Status",
    "I-539 Extension",
    "N-400 Naturalization",
    "I-90 Green Card Renewal",
    "I-129 Worker Petition",
    "I-751 Remove Conditions",
]
RISK_TIERS = ["low", "medium", "high"]
ALIGNMENTS = ["aligned", "partial", "non_compliant"]
REPLY_KEYS = ["compliance_score", "risk_tier", "policy_alignment", "reasoning"]

MIN_TEXT_LENGTH = 10
MAX_TEXT_LENGTH = 10_000
MIN_PAGES = 1
UNKNOWN_ID = "<unknown>"

DEFAULT_MODEL = "us.anthropic.claude-sonnet-4-6"
REQUEST_VERSION = "bedrock-2023-05-31"
MAX_REPLY_TOKENS = 512
TEMPERATURE = 0.0
CHUNK_ROWS = 25

# USD per 1,000 tokens: model -> (input, output)
DEFAULT_PRICES = {DEFAULT_MODEL: (Decimal("0.003"), Decimal("0.015"))}

DEFAULT_PROMPT = "compliance_v1"
PROMPTS = {
    "compliance_v1": """\
You are a federal compliance analyst. Evaluate the supplied document record and respond with a single JSON object and nothing else — no prose, no markdown fences, no preamble. The JSON object MUST contain exactly these keys:
  "compliance_score" (float between 0.0 and 1.0),
  "risk_tier" (one of "low", "medium", "high"),
  "policy_alignment" (one of "aligned", "partial", "non_compliant"),
  "reasoning" (string, 1-3 sentences).
Do not include any other keys. Do not wrap the JSON in code fences.""",
}

# Names the expectation library gives to the four kinds of column check.
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
LENGTH_BETWEEN = "expect_column_value_lengths_to_be_between"
UNEXPECTED_SAMPLE = 20

# Synthetic records: value -> share, and value pools.
AGENCY_SHARES = {"USCIS": 0.60, "CBP": 0.15, "ICE": 0.10, "TSA": 0.10, "FEMA": 0.05}
TIER_SHARES = {"standard": 0.70, "expedite": 0.20, "emergency": 0.10}
FLAG_COUNT_SHARES = {"0": 0.80, "1": 0.15, "2": 0.05}
NOTE_SHARE = 0.30
FLAG_POOL = [
    "expedited_review",
    "high_value",
    "fraud_alert",
    "manual_override",
    "audit_required",
    "incomplete_docs",
    "priority_hold",
    "legal_review",
]
CASE_STATUSES = ["pending", "under_review", "approved", "denied", "rfe_issued", "escalated"]
FORM_NUMBERS = [
    "I-130",
    "I-485",
    "I-765",
    "I-140",
    "I-20",
    "I-539",
    "N-400",
    "I-90",
    "I-129",
    "I-751",
    None,
    None,
]

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

#: Canonical record after normalization and contract checks.
RECORD_SCHEMA = (
    "record_id STRING, submitted_at TIMESTAMP, document_type STRING, agency STRING, "
    "applicant_id STRING, case_status STRING, priority_tier STRING, document_text STRING, "
    "form_number STRING, pages BIGINT, flags ARRAY<STRING>, officer_notes STRING"
)
RECORD_FIELDS = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
TEXT_FIELDS = [
    "document_type",
    "applicant_id",
    "case_status",
    "document_text",
    "form_number",
    "officer_notes",
]
NULLABLE_FIELDS = ["form_number", "officer_notes"]
OPTIONAL_FIELDS = ["form_number", "flags", "officer_notes"]

#: Bronze and gold tables; ``pipeline_run_id`` is the partition column.
RESULT_SCHEMA = (
    "record_id STRING, compliance_score DOUBLE, risk_tier STRING, policy_alignment STRING, "
    "reasoning STRING, input_tokens INT, output_tokens INT, tokens_used INT, model_id STRING, "
    "classified_at TIMESTAMP, pipeline_run_id STRING"
)

#: Audit table; ``pipeline_run_id`` is the partition column.
AUDIT_SCHEMA = (
    "audit_id BIGINT, record_id STRING, submitted_at TIMESTAMP, classified_at TIMESTAMP, "
    "compliance_score DECIMAL(4,3), risk_tier STRING, policy_alignment STRING, "
    "input_tokens INT, output_tokens INT, tokens_used INT, cost_input_usd DECIMAL(12,6), "
    "cost_output_usd DECIMAL(12,6), cost_usd DECIMAL(12,6), quality_gate_passed BOOLEAN, "
    "source_bucket STRING, source_key STRING, input_record_hash STRING, prompt_hash STRING, "
    "created_at TIMESTAMP, pipeline_run_id STRING"
)
AUDIT_NULLABLE = ["source_bucket", "source_key"]


def field_types(ddl: str) -> list[tuple[str, str]]:
    """Split a flat DDL string of this module into (name, type) pairs."""
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(", ")]
