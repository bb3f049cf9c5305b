"""Model requests: user message, request body, token estimate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.schemas import MAX_REPLY_TOKENS, REQUEST_VERSION, TEMPERATURE

# Layout of the user message (fixed format): heading, then label and field in this order.
_HEADING = "Evaluate this federal document record for compliance."
_LABELS = [
    "record_id",
    "agency",
    "document_type",
    "case_status",
    "priority_tier",
    "pages",
]


def user_message() -> Column:
    """The message that presents one canonical record to the model."""
    parts: list[Column] = [F.lit(f"{_HEADING}\n")]
    for label in _LABELS:
        parts += [F.lit(f"{label}: "), F.col(label).cast("string"), F.lit("\n")]
    flags = F.when(F.size("flags") > 0, F.array_join("flags", ", ")).otherwise(F.lit("none"))
    return F.concat(
        *parts, F.lit("flags: "), flags, F.lit("\ndocument_text:\n"), F.col("document_text")
    )


def request_body(
    message: Column,
    system_prompt: str,
    max_tokens: int = MAX_REPLY_TOKENS,
    temperature: float = TEMPERATURE,
) -> Column:
    """The request as JSON text."""
    content = F.array(F.struct(F.lit("text").alias("type"), message.alias("text")))
    return F.to_json(
        F.struct(
            F.lit(REQUEST_VERSION).alias("anthropic_version"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
            F.lit(system_prompt).alias("system"),
            F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias(
                "messages"
            ),
        )
    )


def token_estimate(message: Column, max_tokens: int = MAX_REPLY_TOKENS) -> Column:
    """Tokens a request may use: a quarter of its characters, at least 1, plus the reply limit."""
    return F.greatest(F.floor(F.char_length(message) / 4), F.lit(1)) + max_tokens


def with_requests(
    records: DataFrame,
    system_prompt: str,
    max_tokens: int = MAX_REPLY_TOKENS,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """Add ``request_body`` and ``estimated_tokens`` to canonical records."""
    prepared = records.withColumn("_message", user_message())
    return prepared.withColumns(
        {
            "request_body": request_body(F.col("_message"), system_prompt, max_tokens, temperature),
            "estimated_tokens": token_estimate(F.col("_message"), max_tokens),
        }
    ).drop("_message")
