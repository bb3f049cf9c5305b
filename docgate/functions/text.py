"""Text cleaning and hashing expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    IntegralType,
    StringType,
    TimestampType,
)

from docgate.schemas import MAX_TEXT_LENGTH

# White space (fixed values): Unicode's, and the four ASCII separators that text cleaning adds.
UNICODE_SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACES = UNICODE_SPACES + "\x1c\x1d\x1e\x1f"


def squeeze(text: Column) -> Column:
    """Collapse every run of white space to one blank and strip both ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def strip(text: Column, characters: str = SPACES) -> Column:
    """Strip white space from both ends and leave the inside alone."""
    return F.btrim(text, F.lit(characters))


def clip(text: Column) -> Column:
    """The first ``MAX_TEXT_LENGTH`` characters (the contract's own limit)."""
    return F.substring(text, 1, MAX_TEXT_LENGTH)


def canonical_json(columns: list[str]) -> Column:
    """Compact JSON of ``columns`` in name order, nulls kept, times in UTC."""
    options = {
        "ignoreNullFields": "false",
        "timeZone": "UTC",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    }
    return F.to_json(F.struct(*[F.col(name) for name in sorted(columns)]), options)


def _escaped(text: Column) -> Column:
    """``text`` as a JSON string of ASCII characters only, with surrogate pairs beyond U+FFFF.

    Each different character that needs it is replaced in the whole text at once, so the work grows
    with the characters a text uses, not with the square of its length.
    """
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for letter, raw in {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}.items():
        out = F.replace(out, F.lit(raw), F.lit(f"\\{letter}"))
    rest = F.array_distinct(F.regexp_extract_all(out, F.lit(r"[^\x20-\x7e]"), F.lit(0)))

    def replaced(done: Column, one: Column) -> Column:
        units = F.lower(F.hex(F.encode(one, "UTF-16BE")))
        return F.replace(done, one, F.regexp_replace(units, "(.{4})", r"\\u$1"))

    out = F.when(F.size(rest) > 0, F.aggregate(rest, out, replaced)).otherwise(out)
    return F.concat(F.lit('"'), out, F.lit('"'))


def _python_value(name: str, kind: DataType) -> Column:
    value = F.col(name)
    if isinstance(kind, StringType):
        shown = _escaped(value)
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
        items = F.transform(value, lambda one: F.coalesce(_escaped(one), F.lit("null")))
        shown = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(kind, TimestampType):
        # As Python's str() of a time in UTC: microseconds only where there are any.
        micros = F.date_format(value, ".SSSSSS")
        shown = F.concat(
            F.lit('"'),
            F.date_format(value, "yyyy-MM-dd HH:mm:ss"),
            F.when(micros == ".000000", F.lit("")).otherwise(micros),
            F.lit('+00:00"'),
        )
    elif isinstance(kind, (IntegralType, BooleanType)):
        shown = value.cast("string")
    else:
        raise TypeError(f"column {name} has no such form: {kind.simpleString()}")
    return F.coalesce(shown, F.lit("null"))


def python_json(rows: DataFrame, columns: list[str]) -> Column:
    """JSON of ``columns`` of ``rows`` as Python's ``json.dumps(record, sort_keys=True, default=str)``.

    Keys in order, a blank after commas and colons, all but ASCII escaped, nulls kept. Hashes of it
    compare with those made by Python programs. Columns are texts, lists of texts, whole numbers,
    booleans and times (shown in UTC, which the session's time zone must be).
    """
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    times = [name for name in columns if isinstance(kinds[name], TimestampType)]
    zone = rows.sparkSession.conf.get("spark.sql.session.timeZone")
    if times and zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError("set spark.sql.session.timeZone to UTC to print times")
    parts = []
    for name in sorted(columns):
        parts += [F.lit(f"{', ' if parts else '{'}{json.dumps(name)}: "), _python_value(name, kinds[name])]
    return F.concat(*parts, F.lit("}"))


def fingerprint(columns: list[str]) -> Column:
    """SHA-256 of :func:`canonical_json`."""
    return F.sha2(canonical_json(columns), 256)
