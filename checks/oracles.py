"""The queries of :mod:`checks.queries` as SQL over the given tables."""

from __future__ import annotations

from checks.queries import CALLERS, PROMPT, RPM, TPM
from checks.views import REC, RESP
from docgate.schemas import (
    AGENCIES,
    BETWEEN,
    CASE_STATUSES,
    DOCUMENT_TYPES,
    FLAG_POOL,
    FORM_NUMBERS,
    IN_SET,
    LENGTH_BETWEEN,
    NOT_NULL,
    PRIORITY_TIERS,
)


def _in(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def _list(values) -> str:
    return "[" + ", ".join("NULL" if x is None else f"'{x}'" for x in values) + "]"


_WS = (
    r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def _squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_WS}+', ' ', 'g'))"


_REC = "rec AS (" + REC.format(documents="documents") + ")"
_RESP = "resp AS (" + RESP.format(documents="documents") + ")"
_NORM = f"""norm AS (SELECT *,
    substr({_squeeze("document_text")}, 1, 10000) AS dt, upper(agency) AS ag,
    {_squeeze("applicant_id")} AS ap, lower({_squeeze("case_status")}) AS cs,
    lower(priority_tier) AS pt, doc_id % 23 AS c FROM rec)"""
_KEEPS = f"length(dt) >= 10 AND pages >= 1 AND ag IN {_in(AGENCIES)} AND pt IN {_in(PRIORITY_TIERS)}"
_CANON = f"canon AS (SELECT * FROM norm WHERE {_KEEPS})"
_RULES = f"WITH {_REC}, {_NORM}, {_CANON}"
_TEXT_MD5 = "md5(text) AS text_md5"
_ID = "concat('00000000-0000-4000-8000-', lpad(cast(doc_id AS varchar), 12, '0'))"
_STAMP = "strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at"

_MESSAGE = """concat('Evaluate this federal document record for compliance.', chr(10),
    'record_id: ', record_id, chr(10), 'agency: ', ag, chr(10), 'document_type: ', document_type, chr(10),
    'case_status: ', cs, chr(10), 'priority_tier: ', pt, chr(10), 'pages: ', cast(pages AS varchar), chr(10),
    'flags: ', CASE WHEN flags_csv = '' THEN 'none' ELSE replace(flags_csv, ',', ', ') END, chr(10),
    'document_text:', chr(10), dt)"""

_VIOLATIONS = f"""concat_ws(',',
    CASE WHEN c = 6 THEN 'record_id:invalid' WHEN c = 11 THEN 'record_id:missing' END,
    CASE WHEN c = 7 THEN 'submitted_at:invalid' END,
    CASE WHEN c = 8 THEN 'document_type:invalid' END,
    CASE WHEN c = 1 THEN 'agency:missing' WHEN ag NOT IN {_in(AGENCIES)} THEN 'agency:not_allowed' END,
    CASE WHEN length(dt) < 10 THEN 'document_text:too_short' END,
    CASE WHEN c IN (4, 5) THEN 'pages:invalid' WHEN pages < 1 THEN 'pages:too_small' END,
    CASE WHEN c IN (2, 3) THEN 'flags:invalid' END,
    CASE WHEN c = 0 THEN 'surprise_field:unknown' END)"""
_SEEDED = f"WITH {_REC}, {_NORM}, seeded AS (SELECT *, {_VIOLATIONS} AS violations FROM norm)"

_MALFORMED = "doc_id % 17 IN (1, 3, 5, 7, 9, 11, 13)"


def _reply_error(text: str) -> str:
    field = f"json_extract_string({text}, '$.%s')"
    has = " AND ".join(
        f"json_exists({text}, '$.{key}')"
        for key in ("compliance_score", "risk_tier", "policy_alignment", "reasoning")
    )
    return f"""CASE WHEN {text} IS NULL OR NOT json_valid({text}) THEN 'non_json'
      WHEN json_type({text}) <> 'OBJECT' THEN 'not_object'
      WHEN NOT ({has}) THEN 'missing'
      WHEN {field % "risk_tier"} NOT IN ('low', 'medium', 'high') THEN 'bad_tier'
      WHEN {field % "policy_alignment"} NOT IN ('aligned', 'partial', 'non_compliant') THEN 'bad_alignment'
      WHEN try_cast({field % "compliance_score"} AS double) IS NULL THEN 'bad_score'
      WHEN NOT try_cast({field % "compliance_score"} AS double) BETWEEN 0 AND 1 THEN 'score_range' END"""


_ENV = f"""{_RESP}, env AS (SELECT doc_id, CASE WHEN doc_id % 47 = 0 THEN '{{"content":[]}}' ELSE cast(to_json({{
    'content': [{{'type': 'text', 'text': response_text}}],
    'usage': {{'input_tokens': input_tokens, 'output_tokens': output_tokens}}}}) AS varchar) END AS body FROM resp),
  opened AS (SELECT doc_id, {_ID} AS record_id, json_extract_string(body, '$.content[0].text') AS reply,
    cast(coalesce(json_extract_string(body, '$.usage.input_tokens'), '0') AS int) AS input_tokens,
    cast(coalesce(json_extract_string(body, '$.usage.output_tokens'), '0') AS int) AS output_tokens FROM env),
  judged AS (SELECT *, CASE WHEN reply IS NULL THEN 'content' ELSE {_reply_error("reply")} END AS error_code FROM opened),
  classified AS (SELECT *, input_tokens + output_tokens AS tokens_used,
    cast(json_extract_string(CASE WHEN error_code IS NULL THEN reply END, '$.compliance_score') AS decimal(4,3)) AS score,
    json_extract_string(CASE WHEN error_code IS NULL THEN reply END, '$.risk_tier') AS risk_tier,
    json_extract_string(CASE WHEN error_code IS NULL THEN reply END, '$.policy_alignment') AS policy_alignment,
    json_extract_string(CASE WHEN error_code IS NULL THEN reply END, '$.reasoning') AS reasoning
    FROM judged),
  good AS (SELECT * FROM classified WHERE error_code IS NULL)"""
_TABLE = "score, risk_tier, policy_alignment, reasoning, input_tokens, output_tokens, tokens_used"
_HASH = """sha256(cast(to_json({'agency': ag, 'applicant_id': ap, 'case_status': cs, 'document_text': dt,
    'document_type': document_type, 'flags': CASE WHEN flags_csv = '' THEN []::varchar[] ELSE string_split(flags_csv, ',') END,
    'form_number': NULL, 'officer_notes': NULL, 'pages': pages, 'priority_tier': pt, 'record_id': record_id,
    'submitted_at': strftime(submitted_at, '%Y-%m-%dT%H:%M:%S.%fZ')}) AS varchar))"""
_COSTS = """cast(input_tokens * 0.000003 AS decimal(12,6)) AS cost_input_usd,
    cast(output_tokens * 0.000015 AS decimal(12,6)) AS cost_output_usd,
    cast(cast(input_tokens * 0.000003 AS decimal(12,6)) + cast(output_tokens * 0.000015 AS decimal(12,6)) AS decimal(12,6)) AS cost_usd"""


def _ruled(source: str) -> str:
    """Verdicts of the rule client over canonical rows."""
    return f"""ruled AS (SELECT *, cast((pages % 100) / 100.0 AS decimal(4,3)) AS score,
      ['low', 'medium', 'high'][pages % 3 + 1] AS risk_tier,
      ['aligned', 'partial', 'non_compliant'][pages % 3 + 1] AS policy_alignment,
      concat(cast(pages AS varchar), ' pages') AS reasoning,
      cast(length({_MESSAGE}) // 4 AS int) AS input_tokens, cast(40 + pages % 100 AS int) AS output_tokens
      FROM {source})"""


def _audit(source_key: str) -> str:
    hashed = _HASH.replace("'record_id': record_id", "'record_id': canon.record_id")
    return f"""{_RULES}, {_ENV}
        SELECT canon.record_id, 'run-1' AS pipeline_run_id, score AS compliance_score, risk_tier, policy_alignment, input_tokens, output_tokens,
        tokens_used, {_COSTS}, true AS quality_gate_passed, 'raw' AS source_bucket, {source_key} AS source_key,
        {hashed} AS input_record_hash, 'p1' AS prompt_hash, {_STAMP}, '2024-02-01 00:00:00' AS classified_at
        FROM canon JOIN good USING (doc_id)"""


def _stream(passed: str) -> str:
    return f"""{_RULES}, {_ruled("canon")}, costed AS (SELECT *, {_COSTS} FROM ruled)
        SELECT 'audited' AS outcome, risk_tier, {passed} AS quality_gate_passed, count(*) AS records, cast(sum(cost_usd) AS decimal(18,6)) AS cost_usd
        FROM costed GROUP BY risk_tier UNION ALL
        SELECT 'normalization', '', false, count(*), cast(0 AS decimal(18,6)) FROM norm WHERE NOT ({_KEEPS})"""


_USAGE = f"""{_RESP}, usage AS (SELECT doc_id, concat('model-', ['a', 'b', 'c'][doc_id % 3 + 1]) AS model_id,
    input_tokens, output_tokens FROM resp)"""
_ALL_PRICES = """prices AS (SELECT 'model-a' AS model_id, 0.003::decimal(12,6) AS pin, 0.015::decimal(12,6) AS pout
    UNION ALL SELECT 'model-b', 0.0008::decimal(12,6), 0.004::decimal(12,6)
    UNION ALL SELECT 'model-c', 0.00025::decimal(12,6), 0.00125::decimal(12,6))"""
_PRICES = """prices AS (SELECT 'model-a' AS model_id, 0.003::decimal(12,6) AS pin, 0.015::decimal(12,6) AS pout
    UNION ALL SELECT 'model-b', 0.0008::decimal(12,6), 0.004::decimal(12,6))"""


def _gate_rows(view: str, counts: dict[str, str], broken=()) -> str:
    kinds = {
        "record_id": NOT_NULL,
        "submitted_at": NOT_NULL,
        "document_type": IN_SET,
        "agency": IN_SET,
        "priority_tier": IN_SET,
        "pages": BETWEEN,
        "document_text": LENGTH_BETWEEN,
    }
    rows = []
    for column, kind in kinds.items():
        count = "0" if column in broken else f"count(*) FILTER (WHERE {counts[column]})"
        failed = "true" if column in broken else f"{count} > 0"
        rows.append(
            f"SELECT count(*) AS total, '{kind}' AS expectation, '{column}' AS column_name, "
            f"cast({count} AS bigint) AS unexpected_count, {failed} AS failed FROM {view}"
        )
    return " UNION ALL ".join(rows)


_BAD = {
    "record_id": "record_id IS NULL",
    "submitted_at": "submitted_at IS NULL",
    "document_type": f"document_type NOT IN {_in(DOCUMENT_TYPES)}",
    "agency": f"agency NOT IN {_in(AGENCIES)}",
    "priority_tier": f"priority_tier NOT IN {_in(PRIORITY_TIERS)}",
    "pages": "pages < 1",
    "document_text": "length(document_text) < 10",
}
_RAW_BAD = {
    **_BAD,
    "record_id": "c = 11",
    "document_type": f"c = 8 OR document_type NOT IN {_in(DOCUMENT_TYPES)}",
    "agency": f"c <> 1 AND agency NOT IN {_in(AGENCIES)}",
}
_CUSTOM_BAD = {
    **_BAD,
    "agency": "agency NOT IN ('USCIS', 'NASA', 'uscis')",
    "priority_tier": "priority_tier <> 'standard'",
}


def _samples() -> str:
    parts = []
    for column, kind in (
        ("document_type", IN_SET),
        ("agency", IN_SET),
        ("priority_tier", IN_SET),
        ("pages", BETWEEN),
        ("document_text", LENGTH_BETWEEN),
    ):
        parts.append(
            f"SELECT '{kind}' AS expectation, '{column}' AS column_name, "
            f"cast(row_number() OVER (ORDER BY record_id) AS int) AS sample_rank, "
            f"cast({column} AS varchar) AS value, count(*) OVER () AS unexpected_count "
            f"FROM rec WHERE {_BAD[column]}"
        )
    return f"WITH {_REC} SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE sample_rank <= 20"


_DEMAND = """demand AS (SELECT source AS run, doc_id AS seq,
    cast(greatest(floor(n_chars / 4.0), 1) AS bigint) AS tokens FROM documents)"""

_DRAWN = f"""drawn AS (SELECT doc_id, sha256(concat('42:', cast(doc_id AS varchar))) AS h,
    md5(concat('id:42:', cast(doc_id AS varchar))) AS u FROM documents)"""


def _draw(field: int) -> str:
    return f"cast(concat('0x', substr(h, {4 * field + 1}, 4)) AS int)"


def _index(field: int, size: int) -> str:
    return f"cast({_draw(field)} * {size} // 65536 AS int)"


def _weighted(field: int, shares: dict[str, int]) -> str:
    whens = " ".join(f"WHEN {_draw(field)} < {upto} THEN '{x}'" for x, upto in shares.items())
    return f"CASE {whens} END"


_FLAG_AT = _index(6, len(FLAG_POOL))
_OTHER_AT = f"({_FLAG_AT} + 1 + {_index(7, len(FLAG_POOL) - 1)}) % {len(FLAG_POOL)}"

_SYNTH = f"""WITH {_DRAWN} SELECT doc_id,
    concat_ws('-', substr(u, 1, 8), substr(u, 9, 4), substr(u, 13, 4), substr(u, 17, 4), substr(u, 21, 12)) AS record_id,
    strftime(TIMESTAMP '2024-06-01 00:00:00' - to_seconds(cast(concat('0x', substr(h, 1, 8)) AS bigint) % 7776000), '%Y-%m-%d %H:%M:%S') AS submitted_at,
    {_list(DOCUMENT_TYPES)}[{_index(2, len(DOCUMENT_TYPES))} + 1] AS document_type,
    {_weighted(3, {"USCIS": 39322, "CBP": 49152, "ICE": 55706, "TSA": 62259, "FEMA": 65536})} AS agency,
    concat('APP-', cast(100000 + cast(concat('0x', substr(u, 1, 8)) AS bigint) % 900000 AS varchar)) AS applicant_id,
    {_list(CASE_STATUSES)}[{_index(4, len(CASE_STATUSES))} + 1] AS case_status,
    {_weighted(8, {"standard": 45875, "expedite": 58982, "emergency": 65536})} AS priority_tier,
    {_list(FORM_NUMBERS)}[{_index(10, len(FORM_NUMBERS))} + 1] AS form_number,
    cast(1 + {_index(11, 50)} AS int) AS pages,
    CASE WHEN {_draw(5)} < 52429 THEN '' WHEN {_draw(5)} < 62259 THEN {_list(FLAG_POOL)}[{_FLAG_AT} + 1]
      ELSE concat({_list(FLAG_POOL)}[{_FLAG_AT} + 1], ',', {_list(FLAG_POOL)}[{_OTHER_AT} + 1]) END AS flags,
    cast(3 + {_index(9, 10)} AS int) AS sentences, {_draw(12)} < 19660 AS has_notes FROM drawn"""

def _python_text(text: str) -> str:
    """A JSON string with every character but plain ASCII escaped, surrogate pairs included."""
    c = "unicode(x)"
    return f"""concat('"', array_to_string(list_transform(string_split({text}, ''), lambda x: CASE
      WHEN x = '"' THEN '\\"' WHEN x = '\\' THEN '\\\\' WHEN x = chr(10) THEN '\\n' WHEN x = chr(13) THEN '\\r'
      WHEN x = chr(9) THEN '\\t' WHEN x = chr(8) THEN '\\b' WHEN x = chr(12) THEN '\\f'
      WHEN {c} > 65535 THEN printf('\\u%04x\\u%04x', 55296 + ({c} - 65536) // 1024, 56320 + ({c} - 65536) % 1024)
      WHEN {c} < 32 OR {c} > 126 THEN printf('\\u%04x', {c}) ELSE x END), ''), '"')"""


_PYTHON_HASH = f"""sha256(concat('{{"agency": "', ag, '", "applicant_id": ', {_python_text("ap")},
    ', "case_status": "', cs, '", "document_text": ', {_python_text("dt")}, ', "document_type": "', document_type,
    '", "flags": ', CASE WHEN flags_csv = '' THEN '[]' ELSE concat('["', replace(flags_csv, ',', '", "'), '"]') END,
    ', "form_number": null, "officer_notes": null, "pages": ', cast(pages AS varchar), ', "priority_tier": "', pt,
    '", "record_id": "', record_id, '", "submitted_at": "', strftime(submitted_at, '%Y-%m-%d %H:%M:%S'), '+00:00"}}'))"""

_SCREENED = f"""WITH {_REC}, fixed AS (SELECT doc_id, record_id, submitted_at,
    CASE WHEN document_type = 'Unknown Form' THEN 'I-751 Remove Conditions' ELSE document_type END AS document_type,
    CASE WHEN agency = 'NASA' THEN 'FEMA' ELSE upper(agency) END AS ag, lower({_squeeze("case_status")}) AS cs,
    lower(priority_tier) AS pt, flags_csv, greatest(pages, 1) AS pages,
    substr({_squeeze("concat('Document text: ', document_text)")}, 1, 10000) AS dt FROM rec), {_ruled("fixed")},
    costed AS (SELECT *, {_COSTS} FROM ruled)"""

_ORACLES = {
    "ndjson_scan": f"SELECT {_ID} AS record_id, {_TEXT_MD5} FROM documents",
    "ndjson_scan_day": f"""SELECT {_ID} AS record_id, {_TEXT_MD5},
        concat('2024-01-0', cast(doc_id % 3 + 1 AS varchar)) AS day FROM documents""",
    "ndjson_provenance": f"""SELECT {_ID} AS record_id, cast(doc_id // 200 AS bigint) AS bucket, true AS bucket_ok,
        row_number() OVER (PARTITION BY doc_id // 200 ORDER BY doc_id) AS line_ordinal FROM documents""",
    "ndjson_resplit": f"""SELECT {_ID} AS record_id, cast(doc_id // 200 AS bigint) AS bucket, true AS bucket_ok,
        row_number() OVER (PARTITION BY doc_id // 200 ORDER BY doc_id) AS line_ordinal FROM documents""",
    "malformed_lines": f"SELECT {_ID} AS record_id, {_MALFORMED} AS malformed FROM documents",
    "payload_decode": f"""SELECT doc_id AS sequence, {_MALFORMED} OR doc_id % 19 = 0 AS malformed,
        CASE WHEN NOT ({_MALFORMED} OR doc_id % 19 = 0) THEN md5(text) END AS text_md5 FROM documents""",
    "stream_ingest": f"SELECT {_ID} AS record_id, {_TEXT_MD5} FROM documents",
    "stream_resume": f"SELECT {_ID} AS record_id, cast(1 AS bigint) AS times, {_TEXT_MD5} FROM documents",
    "shard_ingest": f"SELECT source AS shard, doc_id AS sequence, {_ID} AS record_id, {_TEXT_MD5} FROM documents",
    "shard_resume": """SELECT source AS shard, count(*) AS records, count(DISTINCT doc_id) AS distinct_records,
        max(doc_id) AS position FROM documents GROUP BY source""",
    "stream_unique": f"SELECT {_ID} AS record_id, cast(1 AS bigint) AS times, {_TEXT_MD5} FROM documents",
    "cost_observed": f"""{_RULES}, {_ruled("canon")}, t AS (SELECT cast(sum(input_tokens) AS bigint) AS i,
        cast(sum(output_tokens) AS bigint) AS o, count(*) AS requests FROM ruled)
        SELECT i AS input_tokens, o AS output_tokens, cast(i * 0.000003 AS decimal(18,6)) AS input_cost_usd,
        cast(o * 0.000015 AS decimal(18,6)) AS output_cost_usd,
        cast(i * 0.000003 + o * 0.000015 AS decimal(18,6)) AS total_cost_usd, requests FROM t""",
    "gate_frame_set": f"""WITH {_REC}, cells AS (
        SELECT 'doc_id' AS column_name, record_id, cast(doc_id AS varchar) AS value FROM rec WHERE doc_id % 4 = 3
        UNION ALL SELECT 'agency', record_id, agency FROM rec WHERE agency NOT IN ('USCIS', 'CBP')),
        ranked AS (SELECT *, cast(row_number() OVER (PARTITION BY column_name ORDER BY record_id) AS int) AS sample_rank FROM cells),
        counts AS (SELECT c AS column_name, (SELECT count(*) FROM cells WHERE column_name = c) AS unexpected_count
          FROM (SELECT unnest(['record_id', 'doc_id', 'agency']) AS c))
        SELECT (SELECT count(*) FROM rec) AS total, column_name, unexpected_count, unexpected_count > 0 AS failed, sample_rank, value
        FROM counts LEFT JOIN (SELECT * FROM ranked WHERE sample_rank <= 20) USING (column_name)""",
    "input_fingerprint_python": f"{_RULES} SELECT record_id, {_PYTHON_HASH} AS input_record_hash FROM canon",
    "synth_records": _SYNTH,
    "prompt_registry": f"""SELECT concat('v', cast(doc_id AS varchar)) AS version, sha256(t) AS sha256,
        cast(length(t) AS int) AS n_chars FROM (SELECT doc_id,
        regexp_replace(regexp_replace(text, '^{_WS}+', ''), '{_WS}+$', '') AS t FROM documents)""",
    "normalize_text": f"""SELECT doc_id, md5(t) AS text_md5, cast(length(t) AS int) AS n FROM (SELECT doc_id,
        substr({_squeeze("concat(chr(12288), ' ', replace(text, 'e ', concat('e', chr(8195), ' ', chr(160), chr(9))), chr(28), chr(10))")}, 1, 10000) AS t
        FROM documents)""",
    "normalize_record": f"""WITH {_REC}, {_NORM} SELECT record_id, document_type, ag AS agency, ap AS applicant_id,
        cs AS case_status, pt AS priority_tier, md5(dt) AS text_md5, cast(pages AS bigint) AS pages FROM norm""",
    "contract_violations": f"""{_SEEDED} SELECT doc_id, CASE WHEN c = 6 THEN 'rec-1' WHEN c = 11 THEN '<unknown>' ELSE record_id END AS record_ref,
        violations FROM seeded""",
    "contract_valid": f"""{_SEEDED} SELECT record_id, {_STAMP}, document_type, ag AS agency, ap AS applicant_id, cs AS case_status,
        pt AS priority_tier, md5(dt) AS text_md5, cast(NULL AS varchar) AS form_number, cast(pages AS bigint) AS pages, flags_csv AS flags,
        cast(NULL AS varchar) AS officer_notes FROM seeded WHERE violations = ''""",
    "contract_coercions": f"""WITH {_REC} SELECT doc_id, record_id, concat(strftime(CASE doc_id % 7
        WHEN 1 THEN submitted_at - INTERVAL '330' MINUTE WHEN 2 THEN date_trunc('day', submitted_at) ELSE submitted_at END,
        '%Y-%m-%d %H:%M:%S'), CASE WHEN doc_id % 7 = 5 THEN '.250' ELSE '.000' END) AS submitted_at,
        cast(CASE WHEN doc_id % 7 = 6 THEN 1 ELSE greatest(pages, 1) END AS bigint) AS pages FROM rec""",
    "gate_counts": f"WITH {_REC} {_gate_rows('rec', _BAD)}",
    "gate_verdict": f"""WITH {_REC}, g AS ({_gate_rows("rec", _BAD)}) SELECT NOT bool_or(failed) AS passed, max(total) AS total,
        cast(sum(unexpected_count) AS bigint) AS failed, cast(count(*) FILTER (WHERE failed) AS int) AS failing_expectations FROM g""",
    "gate_raw_verdict": f"WITH {_REC}, {_NORM} {_gate_rows('norm', _RAW_BAD, broken=('pages',))}",
    "gate_details": _samples(),
    "gate_custom_sets": f"WITH {_REC} {_gate_rows('rec', _CUSTOM_BAD)}",
    "gate_large_set": """SELECT 'source_key' AS column_name, count(*) AS unexpected_count FROM documents
        WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'en')""",
    "gate_route_pass": f"SELECT {_ID} AS record_id, 'passed' AS branch FROM documents",
    "gate_route_reject": f"SELECT {_ID} AS record_id, 'rejected' AS branch FROM documents",
    "gate_empty": """SELECT count(*) = 0 AS passed, count(*) AS total, cast(0 AS bigint) AS failed,
        cast(0 AS int) AS failing_expectations FROM documents WHERE length(text) < 0""",
    "gate_missing_column": f"WITH {_REC} {_gate_rows('rec', _BAD, broken=('agency', 'pages'))}",
    "prompt_message": f"{_RULES} SELECT record_id, md5({_MESSAGE}) AS message_md5 FROM canon",
    "request_body": f"""{_RULES} SELECT record_id, md5(cast(to_json({{'anthropic_version': 'bedrock-2023-05-31', 'max_tokens': 512,
        'temperature': 0.0::double, 'system': '{PROMPT}', 'messages': [{{'role': 'user', 'content': [{{'type': 'text',
        'text': {_MESSAGE}}}]}}]}}) AS varchar)) AS body_md5 FROM canon""",
    "token_estimate": f"""{_RULES} SELECT record_id, cast(greatest(length({_MESSAGE}) // 4, 1) + 512 AS bigint) AS estimated_tokens FROM canon""",
    "score_deterministic": f"""{_RULES}, {_ruled("canon")} SELECT record_id, score, risk_tier, policy_alignment, reasoning,
        input_tokens, output_tokens, true AS stamped FROM ruled""",
    "score_chunked": f"""{_RULES}, {_ruled("canon")} SELECT risk_tier, count(*) AS records,
        cast(sum(input_tokens + output_tokens) AS bigint) AS tokens_used FROM ruled GROUP BY risk_tier""",
    "score_table": f"""{_RULES}, {_ENV} SELECT canon.record_id, error_code, risk_tier FROM canon JOIN classified USING (doc_id)""",
    "envelope_parse": f"""WITH {_ENV} SELECT doc_id, md5(reply) AS reply_md5, CASE WHEN reply IS NOT NULL THEN input_tokens ELSE -1 END AS input_tokens,
        CASE WHEN reply IS NOT NULL THEN output_tokens ELSE -1 END AS output_tokens, CASE WHEN reply IS NULL THEN 'content' END AS envelope_error FROM opened""",
    "reply_parse": f"""WITH {_RESP}, j AS (SELECT doc_id, response_text AS t, {_reply_error("response_text")} AS reply_error FROM resp)
        SELECT doc_id, cast(json_extract_string(CASE WHEN reply_error IS NULL THEN t END, '$.compliance_score') AS decimal(4,3)) AS score,
        json_extract_string(CASE WHEN reply_error IS NULL THEN t END, '$.risk_tier') AS risk_tier,
        json_extract_string(CASE WHEN reply_error IS NULL THEN t END, '$.policy_alignment') AS policy_alignment,
        json_extract_string(CASE WHEN reply_error IS NULL THEN t END, '$.reasoning') AS reasoning, reply_error FROM j""",
    "reply_errors": f"""WITH {_RESP} SELECT coalesce({_reply_error("response_text")}, 'ok') AS error, count(*) AS replies
        FROM resp GROUP BY 1""",
    "classify_results": f"""WITH {_ENV} SELECT doc_id, error_code, reply IS NOT NULL AS billed, score, risk_tier,
        CASE WHEN reply IS NOT NULL THEN tokens_used ELSE -1 END AS tokens_used, 'us.anthropic.claude-sonnet-4-6' AS model_id FROM classified""",
    "cost_totals": f"""WITH {_USAGE} SELECT model_id, cast(sum(input_tokens) AS bigint) AS input_tokens,
        cast(sum(output_tokens) AS bigint) AS output_tokens, count(*) AS requests FROM usage GROUP BY model_id""",
    "cost_summary": f"""WITH {_USAGE}, {_ALL_PRICES}, t AS (SELECT model_id, cast(sum(input_tokens) AS bigint) AS i,
        cast(sum(output_tokens) AS bigint) AS o, count(*) AS requests FROM usage GROUP BY model_id)
        SELECT model_id, i AS input_tokens, o AS output_tokens, cast(i * pin * 0.001 AS decimal(18,6)) AS input_cost_usd,
        cast(o * pout * 0.001 AS decimal(18,6)) AS output_cost_usd,
        cast(i * pin * 0.001 + o * pout * 0.001 AS decimal(18,6)) AS total_cost_usd, requests FROM t JOIN prices USING (model_id)""",
    "stream_totals": f"""WITH {_USAGE}, {_ALL_PRICES}, t AS (SELECT model_id, cast(sum(input_tokens) AS bigint) AS i,
        cast(sum(output_tokens) AS bigint) AS o, count(*) AS requests FROM usage GROUP BY model_id)
        SELECT model_id, i AS input_tokens, o AS output_tokens, cast(i * pin * 0.001 AS decimal(18,6)) AS input_cost_usd,
        cast(o * pout * 0.001 AS decimal(18,6)) AS output_cost_usd,
        cast(i * pin * 0.001 + o * pout * 0.001 AS decimal(18,6)) AS total_cost_usd, requests FROM t JOIN prices USING (model_id)""",
    "cost_unknown_model": f"""WITH {_USAGE}, {_PRICES} SELECT DISTINCT model_id FROM usage
        WHERE model_id NOT IN (SELECT model_id FROM prices)""",
    "cost_per_row": f"""WITH {_USAGE}, {_PRICES}, p AS (SELECT doc_id, model_id, input_tokens, output_tokens,
        cast(coalesce(input_tokens * pin * 0.001, 0) AS decimal(12,6)) AS cost_input_usd,
        cast(coalesce(output_tokens * pout * 0.001, 0) AS decimal(12,6)) AS cost_output_usd FROM usage LEFT JOIN prices USING (model_id))
        SELECT *, cast(cost_input_usd + cost_output_usd AS decimal(12,6)) AS cost_usd FROM p""",
    "cost_custom_prices": f"""WITH {_RESP}, t AS (SELECT cast(sum(input_tokens) AS bigint) AS i, cast(sum(output_tokens) AS bigint) AS o,
        count(*) AS requests FROM resp) SELECT 'model-a' AS model_id, i AS input_tokens, o AS output_tokens,
        cast(i * 0.00001 AS decimal(18,6)) AS input_cost_usd, cast(o * 0.00005 AS decimal(18,6)) AS output_cost_usd,
        cast(i * 0.00001 + o * 0.00005 AS decimal(18,6)) AS total_cost_usd, requests FROM t""",
    "source_keys": """SELECT CASE WHEN doc_id % 11 > 0 THEN source ELSE 'unknown' END AS source_key, count(*) AS records
        FROM documents GROUP BY 1""",
    "admission_infeasible": f"""WITH {_DEMAND}, s AS (SELECT run, seq, CASE WHEN seq % 13 = 0 THEN -tokens ELSE tokens END AS tokens FROM demand)
        SELECT *, CASE WHEN tokens < 0 THEN 'negative token estimate'
          ELSE 'token estimate above the limit per minute' END AS reason FROM s WHERE tokens < 0 OR tokens > 1000""",
    "budget_split": f"""WITH {_DEMAND} SELECT seq % {CALLERS} AS caller, count(*) AS requests, cast(sum(tokens) AS bigint) AS tokens,
        cast({RPM / CALLERS} AS double) AS rpm_share, cast({TPM / CALLERS} AS double) AS tpm_share,
        round(greatest(count(*) / cast({RPM / CALLERS} AS double), cast(sum(tokens) AS double) / {TPM / CALLERS}), 6) AS minutes
        FROM demand GROUP BY 1""",
    "bronze_merge": f"WITH {_ENV} SELECT record_id, 'run-1' AS pipeline_run_id, {_TABLE} FROM good",
    "gold_merge": f"WITH {_ENV} SELECT record_id, 'run-1' AS pipeline_run_id, {_TABLE} FROM good",
    "merge_retry": f"""WITH {_ENV} SELECT record_id, 'run-1' AS pipeline_run_id, score, risk_tier, policy_alignment,
        CASE WHEN risk_tier = 'high' THEN concat('again ', reasoning) ELSE reasoning END AS reasoning,
        input_tokens, output_tokens, tokens_used FROM good""",
    "merge_dedupe": f"""WITH {_ENV}, keyed AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE record_id END AS k FROM good)
        SELECT k AS record_id, 'run-1' AS pipeline_run_id, {_TABLE} FROM keyed
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1""",
    "schema_migration": f"""WITH {_ENV} SELECT record_id, CASE WHEN risk_tier <> 'low' THEN 'run-1' END AS pipeline_run_id, score, risk_tier,
        policy_alignment, reasoning, CASE WHEN risk_tier <> 'low' THEN input_tokens ELSE -1 END AS input_tokens,
        CASE WHEN risk_tier <> 'low' THEN output_tokens ELSE -1 END AS output_tokens, tokens_used FROM good""",
    "audit_rows": _audit("source_key"),
    "audit_many_sources": _audit("concat('key-', cast(doc_id AS varchar))"),
    "audit_two_runs": f"""{_RULES}, {_ENV} SELECT risk_tier, 2 * count(*) AS rows, 2 * count(*) AS ids, cast(2 AS bigint) AS runs
        FROM canon JOIN good USING (doc_id) GROUP BY risk_tier""",
    "audit_retry": f"""{_RULES}, {_ENV}, a AS (SELECT risk_tier, canon.record_id, {_COSTS} FROM canon JOIN good USING (doc_id))
        SELECT risk_tier, count(*) AS rows, count(*) AS ids, count(DISTINCT record_id) AS records,
        cast(sum(cost_usd) AS decimal(18,6)) AS cost_usd FROM a GROUP BY risk_tier""",
    "audit_missing_timestamp": f"""{_RULES}, {_ENV} SELECT record_id FROM good WHERE doc_id NOT IN (SELECT doc_id FROM canon)""",
    "input_fingerprint": f"{_RULES} SELECT record_id, {_HASH} AS input_record_hash FROM canon",
    "dead_letter_write": f"""{_SEEDED} SELECT md5(document_text) AS text_md5, 'normalization' AS failure_stage, 'run-1' AS pipeline_run_id,
        violations AS error_message, '2024-02-01T00:00:00+00:00' AS failed_at,
        '/dead-letter/normalization/2024/02/01/run-1_20240201T000000' AS folder FROM seeded WHERE violations <> ''""",
    "dead_letter_replay": f"{_SEEDED} SELECT violations, count(*) AS records FROM seeded WHERE violations <> '' GROUP BY violations",
    "classified_split": f"""WITH {_ENV} SELECT 'classification' AS failure_stage, error_code, count(*) AS records FROM classified
        WHERE error_code IS NOT NULL GROUP BY error_code""",
    "batch_pipeline": f"""{_RULES}, {_RESP}, j AS (SELECT doc_id, {_reply_error("response_text")} AS e, response_text AS t, input_tokens, output_tokens FROM resp),
        g AS (SELECT canon.ag AS agency, json_extract_string(t, '$.risk_tier') AS risk_tier,
          cast(json_extract_string(t, '$.compliance_score') AS decimal(4,3)) AS score, {_COSTS} FROM canon JOIN j USING (doc_id) WHERE e IS NULL)
        SELECT agency, risk_tier, count(*) AS records, cast(sum(score) AS decimal(18,3)) AS score_sum,
        cast(sum(cost_usd) AS decimal(18,6)) AS cost_usd FROM g GROUP BY agency, risk_tier""",
    "batch_run": f"""{_SCREENED} SELECT risk_tier, true AS quality_gate_passed, count(*) AS records, cast(sum(score) AS decimal(18,3)) AS score_sum,
        cast(sum(input_tokens + output_tokens) AS bigint) AS tokens_used, cast(sum(cost_usd) AS decimal(18,6)) AS cost_usd
        FROM costed GROUP BY risk_tier""",
    "batch_reject": f"""WITH {_REC}, g AS ({_gate_rows("rec", _BAD)}), message AS (SELECT concat('gate closed: ',
          cast(sum(unexpected_count) AS varchar), ' defects in ', cast(max(total) AS varchar), ' records') AS error FROM g)
        SELECT record_id, 'quality_gate' AS failure_stage, (SELECT error FROM message) AS error FROM rec""",
    "stream_pipeline": _stream("true"),
    "stream_gated": _stream("false"),
    "ndjson_prefix": f"WITH {_REC} SELECT record_id, md5(document_text) AS text_md5 FROM rec WHERE doc_id % 5 <> 2",
    "score_isolated": f"""{_RULES}, {_ruled("canon")} SELECT record_id, CASE WHEN doc_id % 13 = 0 THEN 'invoke' END AS error_code,
        CASE WHEN doc_id % 13 <> 0 THEN risk_tier END AS risk_tier FROM ruled""",
    "score_retry": f"""{_RULES}, {_ruled("canon")} SELECT record_id, cast(NULL AS varchar) AS error_code, risk_tier,
        CASE WHEN doc_id % 13 = 0 THEN 2 ELSE 1 END AS attempt FROM ruled""",
    "scoring_limits": f"""{_RULES}, {_ruled("canon")}, n AS (SELECT *, greatest(length({_MESSAGE}) // 4, 1) + 512 > 1500 AS big FROM ruled)
        SELECT record_id, CASE WHEN big THEN 'oversize' END AS error_code, CASE WHEN NOT big THEN risk_tier END AS risk_tier,
        NOT big AS billed FROM n""",
    "scoring_paced": f"""{_RULES}, {_ruled("canon")} SELECT count(*) AS calls, 0 AS moments_above FROM ruled""",
    "reply_codes": """WITH c(k, error_code, billed, reasoning, tokens_used) AS (VALUES (0, NULL, true, 'why', 7), (1, 'invoke', false, NULL, -1),
        (2, 'envelope', false, NULL, -1), (3, 'content', false, NULL, -1), (4, 'usage', false, NULL, -1), (5, NULL, true, 'why', 0),
        (6, NULL, true, 'why', 0), (7, NULL, true, 'why', 0), (8, NULL, true, 'why', 0), (9, 'non_json', true, NULL, 7),
        (10, 'not_object', true, NULL, 7), (11, 'missing', true, NULL, 7), (12, 'bad_tier', true, NULL, 7), (13, 'bad_alignment', true, NULL, 7),
        (14, 'bad_score', true, NULL, 7), (15, 'score_range', true, NULL, 7), (16, NULL, true, 'None', 7),
        (17, 'bad_score', true, NULL, 7), (18, 'usage', false, NULL, -1), (19, NULL, true, 'why', 3))
        SELECT doc_id, error_code, billed, reasoning, tokens_used FROM documents JOIN c ON doc_id % 20 = k""",
    "cost_price_frame": f"""WITH {_USAGE}, {_PRICES} SELECT doc_id, model_id, input_tokens, output_tokens,
        cast(coalesce(input_tokens * pin * 0.001, 0) AS decimal(12,6)) AS cost_input_usd,
        cast(coalesce(output_tokens * pout * 0.001, 0) AS decimal(12,6)) AS cost_output_usd,
        cast(cast(coalesce(input_tokens * pin * 0.001, 0) AS decimal(12,6)) + cast(coalesce(output_tokens * pout * 0.001, 0) AS decimal(12,6)) AS decimal(12,6)) AS cost_usd
        FROM usage LEFT JOIN prices USING (model_id)""",
    "dead_letter_rerun": f"""{_RULES}, failed AS (SELECT record_id FROM norm WHERE NOT ({_KEEPS}))
        SELECT 'batch' AS job, record_id, 'normalization' AS failure_stage, true AS key_ok, true AS line_ok FROM failed
        UNION ALL SELECT 'stream', record_id, 'normalization', true, NULL FROM failed""",
}

# Decimal columns by query, turned into doubles as the queries do.
_COSTED = ["cost_input_usd", "cost_output_usd", "cost_usd"]
_SUMMED = ["input_cost_usd", "output_cost_usd", "total_cost_usd"]
_DECIMALS = {
    "score_deterministic": ["score"],
    "reply_parse": ["score"],
    "classify_results": ["score"],
    "cost_summary": _SUMMED,
    "cost_observed": _SUMMED,
    "stream_totals": _SUMMED,
    "cost_custom_prices": _SUMMED,
    "cost_per_row": _COSTED,
    "cost_price_frame": _COSTED,
    "bronze_merge": ["score"],
    "gold_merge": ["score"],
    "merge_retry": ["score"],
    "merge_dedupe": ["score"],
    "schema_migration": ["score"],
    "audit_rows": ["compliance_score", *_COSTED],
    "audit_many_sources": ["compliance_score", *_COSTED],
    "audit_retry": ["cost_usd"],
    "batch_pipeline": ["score_sum", "cost_usd"],
    "batch_run": ["score_sum", "cost_usd"],
    "stream_pipeline": ["cost_usd"],
    "stream_gated": ["cost_usd"],
}


def _doubles(name: str, sql: str) -> str:
    if name not in _DECIMALS:
        return sql
    casts = ", ".join(f"cast({column} AS double) AS {column}" for column in _DECIMALS[name])
    return f"SELECT * REPLACE ({casts}) FROM ({sql}) AS exact"


ORACLES = {name: _doubles(name, sql) for name, sql in _ORACLES.items()}
