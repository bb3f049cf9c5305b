"""Synthetic records with the documented distributions.

Every value is drawn from a hash of (seed, id), so a record depends on neither the partitioning nor
the other records.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.schemas import (
    AGENCY_SHARES,
    CASE_STATUSES,
    DOCUMENT_TYPES,
    FLAG_COUNT_SHARES,
    FLAG_POOL,
    FORM_NUMBERS,
    NOTE_SHARE,
    TIER_SHARES,
)

#: Vocabulary of the synthetic text.
WORDS = (
    "applicant record review notice evidence interview decision status filing receipt office "
    "address employer family travel entry date form page copy original translation signature "
    "statement request response hearing schedule officer case"
).split()

_DAYS = 90
_SECONDS = _DAYS * 86_400


def synth_records(ids: DataFrame, seed: int, as_of: datetime, id_column: str = "id") -> DataFrame:
    """One record per row of ``ids``, submitted within the 90 days before ``as_of``."""
    key = F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string"))
    drawn = ids.select(id_column, key.alias("_key")).withColumns(
        {
            "_hash": F.sha2("_key", 256),
            "_uuid": F.md5(F.concat(F.lit("id:"), F.col("_key"))),
            "_text": F.md5(F.concat(F.lit("text:"), F.col("_key"))),
        }
    )
    flag_at = _index(6, len(FLAG_POOL))
    # A second flag that differs from the first: step 1..n-1 places onward.
    other_at = (flag_at + 1 + _index(7, len(FLAG_POOL) - 1)) % len(FLAG_POOL)
    flag, other = _pick_at(FLAG_POOL, flag_at), _pick_at(FLAG_POOL, other_at)
    flag_count = _weighted(5, FLAG_COUNT_SHARES)
    uuid = F.concat_ws(
        "-", *[F.substring("_uuid", at, n) for at, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]]
    )
    age = F.pmod(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint"), F.lit(_SECONDS))
    return drawn.select(
        id_column,
        uuid.alias("record_id"),
        F.timestamp_seconds(F.lit(int(as_of.timestamp())) - age).alias("submitted_at"),
        _pick(2, DOCUMENT_TYPES).alias("document_type"),
        _weighted(3, AGENCY_SHARES).alias("agency"),
        F.concat(
            F.lit("APP-"),
            (
                100_000
                + F.pmod(F.conv(F.substring("_uuid", 1, 8), 16, 10).cast("bigint"), F.lit(900_000))
            ).cast("string"),
        ).alias("applicant_id"),
        _pick(4, CASE_STATUSES).alias("case_status"),
        _weighted(8, TIER_SHARES).alias("priority_tier"),
        _sentences(3 + _index(9, 10)).alias("document_text"),
        _pick(10, FORM_NUMBERS).alias("form_number"),
        (1 + _index(11, 50)).alias("pages"),
        F.when(flag_count == "0", F.array().cast("array<string>"))
        .when(flag_count == "1", F.array(flag))
        .otherwise(F.array(flag, other))
        .alias("flags"),
        F.when(_draw(12) < int(NOTE_SHARE * 65_536), _sentences(F.lit(1))).alias("officer_notes"),
    )


def _draw(field: int) -> Column:
    """16 bits of the record's hash, another four digits for every field."""
    return F.conv(F.substring("_hash", 4 * field + 1, 4), 16, 10).cast("int")


def _index(field: int, size: int) -> Column:
    return F.floor(_draw(field) * size / 65_536).cast("int")


def _pick_at(values: list, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(value) for value in values]), at + 1)


def _pick(field: int, values: list) -> Column:
    return _pick_at(values, _index(field, len(values)))


def _weighted(field: int, shares: dict[str, float]) -> Column:
    upto, choice = 0.0, None
    for value, share in shares.items():
        upto += share
        below = _draw(field) < round(upto * 65_536)
        choice = F.when(below, F.lit(value)) if choice is None else choice.when(below, F.lit(value))
    return choice


def _sentences(count: Column) -> Column:
    """``count`` sentences of 8 words; words step through the text hash's digits."""

    def word(place: Column) -> Column:
        start = F.pmod(place, F.lit(30)) + 1
        chunk = F.conv(F.col("_text").substr(start, F.lit(3)), 16, 10).cast("int")
        return F.element_at(
            F.array(*[F.lit(w) for w in WORDS]), F.pmod(chunk + place, F.lit(len(WORDS))) + 1
        )

    def sentence(number: Column) -> Column:
        words = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda at: word(number * 8 + at))
        text = F.array_join(words, " ")
        return F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)), F.lit("."))

    return F.array_join(F.transform(F.sequence(F.lit(1), count), sentence), " ")
