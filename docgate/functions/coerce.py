"""Typed values out of JSON values of unknown type.

Every function takes a VARIANT column that is SQL NULL when the key is absent, and gives NULL when
the JSON value is not acceptable for the wanted type. ``kind`` tells absent (NULL) from JSON null
(``VOID``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docgate.functions.text import UNICODE_SPACES, strip

# Patterns of accepted text forms (fixed values).
_ISO = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"(?:[Tt _]\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:[Zz]|[+\-\u2212](?:[01]\d|2[0-3]):?[0-5]\d)?)?$"
)
# The usual form, which the engine's own cast reads in any session time zone.
_PLAIN_ISO = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)$"
)
_ISO_TIME = r"[Tt _](\d{2}:\d{2}(?::\d{2})?)"
_ISO_FRACTION = r"[.,](\d{1,6})"
_ISO_OFFSET = r"[Tt _].*([+\-\u2212])(\d{2}):?(\d{2})$"
_DECIMAL_TEXT = r"^[+-]?(?:\d+\.?\d*|\.\d+)$"
# Digits with single underscores between them. Character classes only: the regex engine recurses on
# repeated groups, and hostile text must not exhaust its stack.
DIGITS = r"\d[\d_]*(?<!_)"
_INT_TEXT = rf"^(?!.*__)[+-]?{DIGITS}(?:\.0+)?$"
_HEX = "[0-9A-Fa-f]"
_UUID_HYPHENS = f"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
_UUID = rf"^(?:{_UUID_HYPHENS}|{_HEX}{{32}}|\{{{_UUID_HYPHENS}\}}|urn:uuid:{_UUID_HYPHENS})$"

# Numbers beyond this are milliseconds, up to it seconds (fixed value).
_MILLIS_ABOVE = 20_000_000_000
# Last and first instant of the supported calendar, in microseconds.
_MAX_MICROS = 253_402_300_799_999_999
_MIN_MICROS = -62_135_596_800_000_000


def kind(value: Column) -> Column:
    """JSON type as SQL text (``STRING``, ``BIGINT``, ``VOID``, ...), NULL when absent."""
    return F.schema_of_variant(value)


def text(value: Column, name: Column | None = None) -> Column:
    """JSON strings only; numbers and the rest are not turned into text.

    Here and below ``name`` is the value's :func:`kind`, for callers that have it already.
    """
    name = kind(value) if name is None else name
    return F.when(name == "STRING", F.try_variant_get(value, "$", "string"))


def shown(value: Column) -> Column:
    """Any JSON value as text, for messages."""
    return F.coalesce(text(value), F.to_json(value))


def number(value: Column, name: Column | None = None) -> Column:
    """JSON numbers as DECIMAL(38,9); other types and numbers out of range give NULL."""
    name = kind(value) if name is None else name
    return F.when(
        (name == "BIGINT") | (name == "DOUBLE") | name.startswith("DECIMAL"),
        F.try_variant_get(value, "$", "decimal(38,9)"),
    )


def whole(value: Column, name: Column | None = None) -> Column:
    """Whole numbers: JSON integers, integral decimals, booleans and integer-like text."""
    name = kind(value) if name is None else name
    as_text = strip(F.try_variant_get(value, "$", "string"), UNICODE_SPACES)
    digits = F.regexp_replace(F.regexp_replace(as_text, r"\.0+$", ""), "_", "")
    decimal = F.try_variant_get(value, "$", "decimal(38,9)")
    return (
        F.when(name == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        .when(
            (name == "DOUBLE") | name.startswith("DECIMAL"),
            F.when(decimal == F.floor(decimal), decimal.try_cast("bigint")),
        )
        .when(name == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("bigint"))
        .when((name == "STRING") & as_text.rlike(_INT_TEXT), digits.try_cast("bigint"))
    )


def _from_epoch(seconds_or_millis: Column) -> Column:
    scaled = F.when(
        F.abs(seconds_or_millis) > _MILLIS_ABOVE, seconds_or_millis * 1_000
    ).otherwise(seconds_or_millis * 1_000_000)
    micros = F.round(scaled, 0).try_cast("bigint")
    return F.when(micros.between(_MIN_MICROS, _MAX_MICROS), F.timestamp_micros(micros))


def instant_of_text(as_text: Column) -> Column:
    """ISO date or date-time text (UTC when it names no offset), or epoch digits, as TIMESTAMP."""
    # One canonical UTC text, then the offset as plain minutes: the session time zone never
    # matters, and offsets beyond the engine's 18 hours work.
    local = F.concat(
        F.substring(as_text, 1, 10),
        F.lit("T"),
        F.coalesce(F.nullif(F.regexp_extract(as_text, _ISO_TIME, 1), F.lit("")), F.lit("00:00")),
    )
    local = F.concat(local, F.when(F.length(local) == 16, F.lit(":00")).otherwise(F.lit("")))
    fraction = F.regexp_extract(as_text, _ISO_FRACTION, 1)
    parsed = F.concat(
        local, F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction)), F.lit("Z")
    ).try_cast("timestamp")
    sign = F.when(F.regexp_extract(as_text, _ISO_OFFSET, 1) == "+", F.lit(1)).otherwise(F.lit(-1))
    minutes = F.regexp_extract(as_text, _ISO_OFFSET, 2).try_cast("int") * 60 + F.regexp_extract(
        as_text, _ISO_OFFSET, 3
    ).try_cast("int")
    shifted = F.timestamp_add("MINUTE", -sign * F.coalesce(minutes, F.lit(0)), parsed)
    return (
        F.when(as_text.rlike(_PLAIN_ISO), as_text.try_cast("timestamp"))
        .when(as_text.rlike(_ISO), shifted)
        .when(as_text.rlike(_DECIMAL_TEXT), _from_epoch(as_text.try_cast("decimal(38,9)")))
    )


def instant(value: Column, name: Column | None = None) -> Column:
    """Date-times from ISO text, epoch seconds or epoch milliseconds, as TIMESTAMP."""
    name = kind(value) if name is None else name
    as_text = F.try_variant_get(value, "$", "string")
    return F.when(name == "STRING", instant_of_text(as_text)).otherwise(
        _from_epoch(number(value, name))
    )


def uuid_of_text(as_text: Column) -> Column:
    """UUID text in any accepted form, as lower-case hyphenated text."""
    digits = F.lower(F.regexp_replace(F.regexp_replace(as_text, "^urn:uuid:", ""), "[-{}]", ""))
    hyphenated = F.concat_ws(
        "-",
        F.substring(digits, 1, 8),
        F.substring(digits, 9, 4),
        F.substring(digits, 13, 4),
        F.substring(digits, 17, 4),
        F.substring(digits, 21, 12),
    )
    return F.when(as_text.rlike(_UUID), hyphenated)


def text_list(value: Column, name: Column | None = None) -> Column:
    """JSON lists of strings; a null or any other element makes the list unacceptable."""
    name = kind(value) if name is None else name
    items = F.try_variant_get(value, "$", "array<string>")
    return F.when(
        name.isin("ARRAY<STRING>", "ARRAY<VOID>")
        & ~F.exists(items, lambda item: item.isNull()),
        items,
    )
