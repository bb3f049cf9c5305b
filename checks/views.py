"""The given tables seen as raw records, replies and envelopes.

``REC`` and ``RESP`` are one SQL text for both engines; every row of ``documents`` is kept and some
carry defects. ``{documents}`` stands for the table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REC = """
SELECT doc_id,
  concat('00000000-0000-4000-8000-', lpad(cast(doc_id AS string), 12, '0')) AS record_id,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * doc_id AS submitted_at,
  split_part('I-130 Petition|I-485 Adjustment|I-765 EAD|I-140 Immigrant Petition|I-20 Student Status|I-539 Extension|N-400 Naturalization|I-90 Green Card Renewal|I-129 Worker Petition|Unknown Form', '|', cast(doc_id % 10 + 1 AS int)) AS document_type,
  CASE WHEN doc_id % 20 < 11 THEN 'USCIS' WHEN doc_id % 20 = 11 THEN 'uscis' WHEN doc_id % 20 < 15 THEN 'CBP'
       WHEN doc_id % 20 < 17 THEN 'ICE' WHEN doc_id % 20 < 19 THEN 'TSA' WHEN doc_id % 40 < 20 THEN 'FEMA' ELSE 'NASA' END AS agency,
  concat('  A-', cast(doc_id AS string), ' ') AS applicant_id,
  CASE WHEN doc_id % 3 = 0 THEN ' PENDING ' WHEN doc_id % 3 = 1 THEN 'Approved' ELSE 'rfe_issued' END AS case_status,
  CASE WHEN doc_id % 10 < 7 THEN 'standard' WHEN doc_id % 10 < 9 THEN 'EXPEDITE' ELSE 'emergency' END AS priority_tier,
  text AS document_text,
  cast(floor(n_chars / 300.0) AS int) AS pages,
  CASE WHEN doc_id % 20 < 16 THEN '' WHEN doc_id % 20 < 19 THEN 'fraud_alert' ELSE 'legal_review,audit_required' END AS flags_csv,
  source AS source_key
FROM {documents}
"""

RESP = """
SELECT doc_id,
  CASE WHEN doc_id % 29 = 0 THEN 'not json'
       WHEN doc_id % 31 = 0 THEN '{{"compliance_score": 0.5, "risk_tier": "low"}}'
       WHEN doc_id % 37 = 0 THEN '{{"compliance_score": 0.5, "risk_tier": "critical", "policy_alignment": "aligned", "reasoning": "r"}}'
       WHEN doc_id % 41 = 0 THEN '{{"compliance_score": 1.5, "risk_tier": "low", "policy_alignment": "aligned", "reasoning": "r"}}'
       WHEN doc_id % 43 = 0 THEN '[1]'
       ELSE concat('{{"compliance_score": 0.', lpad(cast(doc_id % 100 AS string), 2, '0'), ', "risk_tier": "', split_part('low|medium|high', '|', cast(doc_id % 3 + 1 AS int)),
                   '", "policy_alignment": "', split_part('aligned|partial|non_compliant', '|', cast(doc_id % 3 + 1 AS int)), '", "reasoning": "r', cast(doc_id AS string), '"}}') END AS response_text,
  cast(floor(n_chars / 4.0) AS int) AS input_tokens,
  cast(40 + doc_id % 100 AS int) AS output_tokens
FROM {documents}
"""

BATCH_DAYS = 3
FILE_ROWS = 200


def utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as typed raw records, with seeded defects."""
    return utc(spark).sql(REC, documents=documents(spark, sf_dir))


def resp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model reply per document, valid and broken."""
    return utc(spark).sql(RESP, documents=documents(spark, sf_dir))


def env(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``resp`` inside the service envelope: (doc_id, response)."""
    envelope = F.to_json(
        F.struct(
            F.array(
                F.struct(F.lit("text").alias("type"), F.col("response_text").alias("text"))
            ).alias("content"),
            F.struct("input_tokens", "output_tokens").alias("usage"),
        )
    )
    body = F.when(F.col("doc_id") % 47 == 0, F.lit('{"content":[]}')).otherwise(envelope)
    return resp(spark, sf_dir).select("doc_id", body.alias("response"))


def flags() -> Column:
    """``flags_csv`` as a list."""
    return F.when(F.col("flags_csv") == "", F.array().cast("array<string>")).otherwise(
        F.split("flags_csv", ",")
    )


def typed(records: DataFrame) -> DataFrame:
    """``rec`` with the columns of the record contract only (plus doc_id and source_key)."""
    return records.withColumn("flags", flags()).withColumns(
        {
            "form_number": F.lit(None).cast("string"),
            "officer_notes": F.lit(None).cast("string"),
            "pages": F.col("pages").cast("bigint"),
        }
    ).drop("flags_csv")


def clean(records: DataFrame) -> DataFrame:
    """``rec`` without its defects: a batch that the gate passes."""
    return records.withColumns(
        {
            "document_type": F.when(
                F.col("document_type") == "Unknown Form", F.lit("I-751 Remove Conditions")
            ).otherwise(F.col("document_type")),
            "agency": F.when(F.col("agency") == "NASA", F.lit("FEMA")).otherwise(F.upper("agency")),
            "priority_tier": F.lower("priority_tier"),
            "document_text": F.concat(F.lit("Document text: "), "document_text"),
            "pages": F.greatest("pages", F.lit(1)),
        }
    )


def members(records: DataFrame) -> dict[str, Column]:
    """The JSON text of each member of a raw record, by key."""

    def text(name: str) -> Column:
        one = F.to_json(F.struct(F.col(name).alias("x")), {"ignoreNullFields": "false"})
        return F.substring(one, 6, 2**31 - 1).substr(F.lit(1), F.length(one) - 6)

    stamp = F.date_format("submitted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    quoted = {
        name: text(name)
        for name in records.columns
        if name not in ("doc_id", "submitted_at", "flags_csv", "pages", "source_key")
    }
    return {
        **quoted,
        "submitted_at": F.concat(F.lit('"'), stamp, F.lit('"')),
        "pages": F.col("pages").cast("string"),
        "flags": F.to_json(flags()),
    }


def record_line(parts: dict[str, Column]) -> Column:
    """One JSON object of member texts; a NULL text leaves its member out."""
    pairs = [F.concat(F.lit(f'"{name}":'), value) for name, value in parts.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def json_lines(records: DataFrame) -> DataFrame:
    """(doc_id, value, source_key) of raw records as JSON."""
    return records.select("doc_id", record_line(members(records)).alias("value"), "source_key")


def seeded(records: DataFrame) -> DataFrame:
    """Raw JSON records in which every kind of contract defect occurs, chosen by ``doc_id % 23``."""
    parts = members(records)
    case = F.col("doc_id") % 23

    def at(number: int, text: str | None, name: str) -> None:
        swapped = F.lit(None).cast("string") if text is None else F.lit(text)
        parts[name] = F.when(case == number, swapped).otherwise(parts[name])

    at(1, None, "agency")
    at(2, "null", "flags")
    at(3, '["a",null]', "flags")
    at(4, "3.5", "pages")
    at(5, '"x"', "pages")
    at(6, '"rec-1"', "record_id")
    at(7, '"2025-6-5T1:2:3"', "submitted_at")
    at(8, "7", "document_type")
    at(11, None, "record_id")
    parts["surprise_field"] = F.when(case == 0, F.lit("1"))
    parts["_source_note"] = F.when(case == 9, F.lit('"dropped"'))
    parts["form_number"] = F.when(case == 10, F.lit("null"))
    first = {"agency": F.when(case == 12, F.lit('"NASA"'))}
    pairs = [
        F.concat(F.lit(f'"{name}":'), value) for name, value in [*first.items(), *parts.items()]
    ]
    line = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    return records.select("doc_id", line.alias("value"))


def varied(records: DataFrame) -> DataFrame:
    """Raw JSON records that write the same values in every accepted form."""
    parts = members(records)
    pages, stamp = F.greatest("pages", F.lit(1)).cast("string"), F.unix_timestamp("submitted_at")
    form = F.col("doc_id") % 7
    parts["pages"] = (
        F.when(form == 0, pages)
        .when(form == 1, F.concat(F.lit('"'), pages, F.lit('"')))
        .when(form == 2, F.concat(F.lit('" '), pages, F.lit(' "')))
        .when(form == 3, F.concat(F.lit('"+'), pages, F.lit('"')))
        .when(form == 4, F.concat(F.lit('"'), pages, F.lit('.0"')))
        .when(form == 5, F.concat(pages, F.lit(".0")))
        .otherwise(F.lit("true"))
    )

    def shaped(pattern: str, hours: int = 0) -> Column:
        moved = F.timestamp_seconds(stamp + 3600 * hours)
        return F.concat(F.lit('"'), F.date_format(moved, pattern), F.lit('"'))

    parts["submitted_at"] = (
        F.when(form == 0, shaped("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == 1, shaped("yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .when(form == 2, shaped("yyyy-MM-dd"))
        .when(form == 3, shaped("yyyy-MM-dd HH:mm"))
        .when(form == 4, stamp.cast("string"))
        .when(form == 5, F.concat(stamp.cast("string"), F.lit("250")))
        .otherwise(F.concat(F.lit('"'), stamp.cast("string"), F.lit('"')))
    )
    identity = F.col("record_id")
    parts["record_id"] = F.concat(
        F.lit('"'),
        F.when(form == 0, F.upper(identity))
        .when(form == 1, F.replace(identity, F.lit("-"), F.lit("")))
        .when(form == 2, F.concat(F.lit("{"), identity, F.lit("}")))
        .when(form == 3, F.concat(F.lit("urn:uuid:"), identity))
        .otherwise(identity),
        F.lit('"'),
    )
    return records.select("doc_id", record_line(parts).alias("value"))


def soiled(records: DataFrame) -> DataFrame:
    """JSON lines of which some are not one JSON object, chosen by ``doc_id % 17``."""
    plain = F.col("value")
    case = F.col("doc_id") % 17
    value = (
        F.when(case == 1, F.concat(plain, F.lit(" x")))
        .when(case == 3, plain.substr(F.lit(1), F.length(plain) - 1))
        .when(case == 5, F.concat(plain, plain))
        .when(case == 7, F.concat(F.lit("["), plain, F.lit("]")))
        .when(case == 9, F.replace(plain, F.lit('"agency":'), F.lit("'agency':")))
        .when(case == 11, F.replace(plain, F.lit('"pages":'), F.lit('"pages":NaN,"p":')))
        .when(case == 13, F.concat(plain, F.lit(',"k":1')))
        .otherwise(plain)
    )
    return json_lines(records).withColumn("value", value)


def _reply(**changes) -> str:
    reply = {
        "compliance_score": 0.5,
        "risk_tier": "low",
        "policy_alignment": "aligned",
        "reasoning": "why",
        **changes,
    }
    return json.dumps({name: value for name, value in reply.items() if value is not ...})


def _enveloped(text: str, usage=None) -> str:
    usage = {"input_tokens": 3, "output_tokens": 4} if usage is None else usage
    return json.dumps({"content": [{"type": "text", "text": text}], "usage": usage})


#: (response, score_error), one for every error code and for odd forms that are no errors.
ODD_REPLIES = [
    (_enveloped(_reply()), None),
    (None, "down"),
    ("no envelope", None),
    ('{"content":[]}', None),
    (_enveloped(_reply(), {"input_tokens": -1}), None),
    (_enveloped(_reply(), []), None),
    (_enveloped(_reply(), 0), None),
    (_enveloped(_reply(), ""), None),
    (_enveloped(_reply(), False), None),
    (_enveloped("no json"), None),
    (_enveloped("[1]"), None),
    (_enveloped(_reply(reasoning=...)), None),
    (_enveloped(_reply(risk_tier="none")), None),
    (_enveloped(_reply(policy_alignment="none")), None),
    (_enveloped(_reply(compliance_score="much")), None),
    (_enveloped(_reply(compliance_score=1.5)), None),
    (_enveloped(_reply(reasoning=None)), None),
    (_enveloped(_reply(compliance_score="0\x1c")), None),
    (_enveloped(_reply(), {"input_tokens": "3\x1c"}), None),
    (_enveloped(_reply(compliance_score="\u20030.5\x85"), {"input_tokens": " 3\xa0"}), None),
]
