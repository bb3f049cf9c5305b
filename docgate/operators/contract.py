"""The record contract: twelve typed fields, every broken rule named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docgate.functions import coerce
from docgate.functions.once import with_once
from docgate.operators.normalize import normalized
from docgate.schemas import (
    AGENCIES,
    MIN_PAGES,
    MIN_TEXT_LENGTH,
    NULLABLE_FIELDS,
    OPTIONAL_FIELDS,
    PRIORITY_TIERS,
    RECORD_FIELDS,
    UNKNOWN_ID,
)

_COERCIONS = {
    "record_id": coerce.text,
    "submitted_at": coerce.instant,
    "pages": coerce.whole,
    "flags": coerce.text_list,
}


def parse_contract(parsed: DataFrame) -> DataFrame:
    """Normalize and check parsed JSON records (columns ``raw`` and ``keys``).

    Gives the canonical columns, ``violations`` (empty when valid), ``unknown_fields`` among them
    as ``<field>:unknown``, and ``record_ref``, the id to name in messages. Other columns stay.
    """
    # Types first, then values, then rules: nothing that several rules use is computed twice.
    typed = parsed.withColumns(
        {f"_k_{name}": coerce.kind(F.col(f"raw.{name}")) for name in RECORD_FIELDS}
    )
    values = {
        name: normalized(
            name, _COERCIONS.get(name, coerce.text)(F.col(f"raw.{name}"), F.col(f"_k_{name}"))
        )
        for name in RECORD_FIELDS
    }
    coerced = typed.withColumns(
        {
            **{f"_v_{name}": column for name, column in values.items()},
            "record_ref": F.coalesce(coerce.shown(F.col("raw.record_id")), F.lit(UNKNOWN_ID)),
        }
    ).drop("raw")
    unknown = F.filter(
        F.array_except(F.col("keys"), F.array(*[F.lit(name) for name in RECORD_FIELDS])),
        lambda key: ~key.startswith("_source_"),
    )
    unknown = F.transform(unknown, lambda key: F.concat(key, F.lit(":unknown")))
    judged = coerced.withColumn("violations", F.concat(_violations(), unknown))
    return _canonical(judged, drop=["keys", "malformed"])


def check_contract(records: DataFrame) -> DataFrame:
    """Check a typed, normalized record frame; absent columns count as missing fields."""
    allowed = set(RECORD_FIELDS)
    carried = [name for name in records.columns if name not in allowed]
    present = {field.name: field.dataType for field in records.schema if field.name in allowed}
    staged = {}
    for name in RECORD_FIELDS:
        if name not in present:
            staged[f"_v_{name}"] = F.lit(None).cast(_null_type(name))
            staged[f"_k_{name}"] = F.lit(None).cast("string")
            continue
        column = F.col(name)
        if name == "submitted_at" and isinstance(present[name], StringType):
            column = coerce.instant_of_text(column)
        staged[f"_v_{name}"] = column
        staged[f"_k_{name}"] = F.when(F.col(name).isNull(), F.lit("VOID")).otherwise(F.lit("SET"))
    reference = F.col("record_id") if "record_id" in present else F.lit(None)
    staged["record_ref"] = F.coalesce(reference, F.lit(UNKNOWN_ID))
    coerced = records.select(
        *carried, *[column.alias(name) for name, column in staged.items()]
    )
    return _canonical(coerced.withColumn("violations", _violations()), drop=[])


def split_contract(checked: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows; ``strict`` makes reading an invalid row an error that names it."""
    ok = F.size("violations") == 0
    if strict:
        message = F.concat(
            F.lit("contract broken by record "),
            F.col("record_ref"),
            F.lit(": "),
            F.array_join("violations", ", "),
        )
        failing = F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        return checked.where(failing), checked.where(~ok)
    return checked.where(ok), checked.where(~ok)


def _violations() -> Column:
    rules = []
    for name in RECORD_FIELDS:
        value, kind = F.col(f"_v_{name}"), F.col(f"_k_{name}")
        usable = value.isNotNull()
        if name == "record_id":
            usable = coerce.uuid_of_text(value).isNotNull()
        if name in NULLABLE_FIELDS:
            usable = usable | (kind == "VOID")
        rule = F.when(kind.isNotNull() & ~usable, F.lit(f"{name}:invalid"))
        if name not in OPTIONAL_FIELDS:
            rule = rule.when(kind.isNull(), F.lit(f"{name}:missing"))
        for broken, word in _limits(name, value):
            rule = rule.when(broken, F.lit(f"{name}:{word}"))
        rules.append(rule)
    return F.array_compact(F.array(*rules))


def _limits(name: str, value: Column) -> list[tuple[Column, str]]:
    if name == "agency":
        return [(~value.isin(AGENCIES), "not_allowed")]
    if name == "priority_tier":
        return [(~value.isin(PRIORITY_TIERS), "not_allowed")]
    if name == "document_text":
        return [(F.char_length(value) < MIN_TEXT_LENGTH, "too_short")]
    if name == "pages":
        return [(value < MIN_PAGES, "too_small")]
    return []


def _canonical(judged: DataFrame, drop: list[str]) -> DataFrame:
    staged = {f"_{part}_{name}" for name in RECORD_FIELDS for part in "vk"}
    carried = [name for name in judged.columns if name not in staged and name not in drop]
    fields = {name: F.col(f"_v_{name}") for name in RECORD_FIELDS}
    fields["record_id"] = F.coalesce(coerce.uuid_of_text(fields["record_id"]), fields["record_id"])
    fields["flags"] = F.coalesce(fields["flags"], F.array().cast("array<string>"))
    checked = judged.select(*[c.alias(name) for name, c in fields.items()], *carried)
    return with_once(checked, {"violations": F.col("violations")})


def _null_type(name: str) -> str:
    return {"submitted_at": "timestamp", "pages": "bigint", "flags": "array<string>"}.get(
        name, "string"
    )
