"""Response envelopes and model replies: parse, validate, name the first error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.functions import coerce
from docgate.functions.once import with_once
from docgate.functions.text import UNICODE_SPACES, strip
from docgate.schemas import ALIGNMENTS, REPLY_KEYS, RISK_TIERS

_REPLY_SCHEMA = ", ".join(f"{key} VARIANT" for key in REPLY_KEYS) + ", _corrupt STRING"
_ENVELOPE_SCHEMA = "content VARIANT, usage VARIANT, _corrupt STRING"
_OPTIONS = {
    "columnNameOfCorruptRecord": "_corrupt",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
# Text forms of numbers (fixed patterns).
_FLOAT_TEXT = (
    rf"^(?!.*__)[+-]?(?:{coerce.DIGITS}(?:\.(?:{coerce.DIGITS})?)?|\.{coerce.DIGITS})"
    rf"(?:[eE][+-]?{coerce.DIGITS})?$"
)
_COUNT_TEXT = rf"^(?!.*__)[+-]?{coerce.DIGITS}$"
NO_REASONING = "None"
_NOT_FINITE_TEXT = r"(?i)^[+-]?(?:inf|infinity|nan)$"

#: Error codes in the order they are looked for; the first that applies is reported.
ERROR_CODES = [
    "invoke",
    "envelope",
    "content",
    "usage",
    "non_json",
    "not_object",
    "missing",
    "bad_tier",
    "bad_alignment",
    "bad_score",
    "score_range",
]

_ENVELOPE_COLUMNS = ["reply", "input_tokens", "output_tokens", "envelope_error"]
_REPLY_COLUMNS = [*REPLY_KEYS, "reply_error"]
_RESULT_COLUMNS = [
    *REPLY_KEYS,
    "input_tokens",
    "output_tokens",
    "tokens_used",
    "model_id",
    "error_code",
    "billed",
]


def _complete(text: Column) -> Column:
    """True when ``text`` is one JSON value and nothing after it."""
    wrapped = F.json_object_keys(F.concat(F.lit('{"r":'), text, F.lit(',"#end":0}')))
    return F.coalesce(wrapped == F.array(F.lit("r"), F.lit("#end")), F.lit(False))


def parse_envelopes(scored: DataFrame, response: str = "response") -> DataFrame:
    """Add ``reply``, ``input_tokens``, ``output_tokens`` and ``envelope_error``.

    Codes: ``envelope`` (not JSON), ``content`` (no first text block), ``usage`` (counts that are no
    non-negative numbers). Absent counts are 0.
    """
    return _fixed(_envelopes(scored, response), _ENVELOPE_COLUMNS)


def _envelopes(scored: DataFrame, response: str) -> DataFrame:
    text = F.col(response)
    parsed = scored.withColumns(
        {
            "_env": F.from_json(text, _ENVELOPE_SCHEMA, _OPTIONS),
            "_complete": _complete(text),
        }
    )
    is_object = F.col("_env").isNotNull() & F.col("_env._corrupt").isNull()
    opened = parsed.withColumns(
        {
            "_object": is_object,
            "_block": F.when(is_object, F.try_variant_get("_env.content", "$[0].text", "variant")),
            "_usage": F.coalesce(coerce.kind(F.col("_env.usage")), F.lit("VOID")),
            "_in": F.try_variant_get("_env.usage", "$.input_tokens", "variant"),
            "_out": F.try_variant_get("_env.usage", "$.output_tokens", "variant"),
        }
    )
    counted = opened.withColumns(
        {"reply": coerce.shown(F.col("_block")), "_in": _count("_in"), "_out": _count("_out")}
    )
    # Other JSON than an object is told from no JSON only where it matters.
    readable = F.col("_complete") & F.when(F.col("_object"), True).otherwise(
        F.try_parse_json(text).isNotNull()
    )
    # Empty values of any type count as no usage.
    usage = F.col("_env.usage")
    none = (
        (F.col("_usage") == "VOID")
        | F.coalesce(F.to_json(usage).isin("[]", "false", '""'), F.lit(False))
        | F.coalesce(F.try_variant_get(usage, "$", "double") == 0, F.lit(False))
    )
    usage_kept = none | F.col("_usage").startswith("OBJECT")
    counts_kept = F.coalesce((F.col("_in") >= 0) & (F.col("_out") >= 0), F.lit(False))
    judged = counted.withColumn(
        "envelope_error",
        F.when(text.isNull() | ~readable, F.lit("envelope"))
        .when(F.col("_block").isNull(), F.lit("content"))
        .when(~usage_kept | ~counts_kept, F.lit("usage")),
    )
    good = F.col("envelope_error").isNull()
    return judged.withColumns(
        {
            "reply": F.when(good, F.col("reply")),
            "input_tokens": F.when(good, F.col("_in")),
            "output_tokens": F.when(good, F.col("_out")),
        }
    ).drop("_env", "_complete", "_object", "_block", "_usage", "_in", "_out")


def _number_text(value: Column) -> Column:
    """Text without the white space that Python's ``int`` and ``float`` allow around a number."""
    return strip(F.try_variant_get(value, "$", "string"), UNICODE_SPACES)


def _count(column: str) -> Column:
    """A token count: absent is 0, not a number is NULL."""
    value = F.col(column)
    name = coerce.kind(value)
    text = _number_text(value)
    return (
        F.when(name.isNull(), F.lit(0))
        .when(name == "BIGINT", F.try_variant_get(value, "$", "int"))
        .when(name == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("int"))
        .when(
            (name == "DOUBLE") | name.startswith("DECIMAL"),
            F.try_variant_get(value, "$", "double").try_cast("int"),
        )
        .when(
            (name == "STRING") & text.rlike(_COUNT_TEXT),
            F.regexp_replace(text, "_", "").try_cast("int"),
        )
    )


def parse_replies(enveloped: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``compliance_score``, ``risk_tier``, ``policy_alignment``, ``reasoning``, ``reply_error``.

    A reply must be one JSON object with the four keys; more keys are tolerated. The fields are
    NULL when ``reply_error`` is set.
    """
    return _fixed(_replies(enveloped, reply), _REPLY_COLUMNS)


def _replies(enveloped: DataFrame, reply: str) -> DataFrame:
    text = F.col(reply)
    parsed = enveloped.withColumns(
        {
            "_r": F.from_json(text, _REPLY_SCHEMA, _OPTIONS),
            "_whole": _complete(text),
        }
    )
    is_object = (
        F.col("_r").isNotNull() & F.col("_r._corrupt").isNull() & text.rlike(r"^[ \t\r\n]*\{")
    )
    parsed = parsed.withColumns(
        {
            "_object": is_object,
            "_score": _score(F.col("_r.compliance_score")),
            "_tier": coerce.text(F.col("_r.risk_tier")),
            "_alignment": coerce.text(F.col("_r.policy_alignment")),
            # A null is kept, as the text that its reader makes of it.
            "_reasoning": F.when(
                coerce.kind(F.col("_r.reasoning")) == "VOID", F.lit(NO_REASONING)
            ).otherwise(coerce.shown(F.col("_r.reasoning"))),
        }
    )
    missing = [F.col(f"_r.{key}").isNull() for key in REPLY_KEYS]
    no_json = F.when(F.col("_object"), False).otherwise(F.try_parse_json(text).isNull())
    error = (
        F.when(text.isNull() | ~F.col("_whole"), F.lit("non_json"))
        .when(no_json, F.lit("non_json"))
        .when(~F.col("_object"), F.lit("not_object"))
        .when(missing[0] | missing[1] | missing[2] | missing[3], F.lit("missing"))
        .when(~F.coalesce(F.col("_tier").isin(RISK_TIERS), F.lit(False)), F.lit("bad_tier"))
        .when(
            ~F.coalesce(F.col("_alignment").isin(ALIGNMENTS), F.lit(False)), F.lit("bad_alignment")
        )
        .when(F.col("_score").isNull(), F.lit("bad_score"))
        .when(F.isnan("_score") | ~F.col("_score").between(0.0, 1.0), F.lit("score_range"))
    )
    judged = parsed.withColumn("reply_error", error)
    fields = {
        "compliance_score": "_score",
        "risk_tier": "_tier",
        "policy_alignment": "_alignment",
        "reasoning": "_reasoning",
    }
    return judged.withColumns(
        {
            name: F.when(F.col("reply_error").isNull(), F.col(staged))
            for name, staged in fields.items()
        }
    ).drop("_r", "_whole", "_object", *fields.values())


def _score(value: Column) -> Column:
    name = coerce.kind(value)
    text = _number_text(value)
    return (
        F.when(
            (name == "BIGINT") | (name == "DOUBLE") | name.startswith("DECIMAL"),
            F.try_variant_get(value, "$", "double"),
        )
        .when(name == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double"))
        .when(
            (name == "STRING") & text.rlike(_FLOAT_TEXT),
            F.regexp_replace(text, "_", "").try_cast("double"),
        )
        .when((name == "STRING") & text.rlike(_NOT_FINITE_TEXT), F.lit(float("nan")))
    )


def classify(scored: DataFrame, model_id: str) -> DataFrame:
    """Verdict columns for scored rows (``response``, ``score_error``, ``classified_at``).

    Adds the result fields and ``error_code``, the first of :data:`ERROR_CODES` that applies.
    ``billed`` marks rows whose envelope could be read: they cost tokens even when the reply is
    no good.
    """
    parsed = _replies(_envelopes(scored, "response"), "reply")
    judged = parsed.withColumns(
        {
            "error_code": F.when(F.col("score_error").isNotNull(), F.lit("invoke")).otherwise(
                F.coalesce("envelope_error", "reply_error")
            ),
            "billed": F.col("score_error").isNull() & F.col("envelope_error").isNull(),
            "tokens_used": F.col("input_tokens") + F.col("output_tokens"),
            "model_id": F.lit(model_id),
        }
    ).drop("envelope_error", "reply_error", "reply")
    return _fixed(judged, _RESULT_COLUMNS)


def _fixed(rows: DataFrame, names: list[str]) -> DataFrame:
    # Results are fixed once, at the end: filters on them must not drag the parsing along.
    return with_once(rows, {name: F.col(name) for name in names})
