from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from docgate.operators.contract import check_contract
from docgate.operators.gate import document_expectations
from docgate.operators.normalize import normalize
from docgate.plans.batch import run_gate
from docgate.schemas import AGENCY_SHARES, TIER_SHARES
from docgate.sources.synthetic import synth_records

AS_OF = datetime(2024, 6, 1, tzinfo=timezone.utc)


def test_distributions_and_validity(spark):
    made = synth_records(spark.range(20_000), 7, AS_OF)
    n = made.count()
    for column, shares in (("agency", AGENCY_SHARES), ("priority_tier", TIER_SHARES)):
        found = {r[column]: r["count"] / n for r in made.groupBy(column).count().collect()}
        assert all(abs(found[value] - share) < 0.02 for value, share in shares.items())
    flags = {r["n"]: r["count"] / n for r in made.groupBy(F.size("flags").alias("n")).count().collect()}
    assert all(abs(flags[k] - share) < 0.02 for k, share in ((0, 0.80), (1, 0.15), (2, 0.05)))
    row = made.agg(
        F.avg(F.col("officer_notes").isNotNull().cast("int")).alias("notes"),
        F.min("pages").alias("least"),
        F.max("pages").alias("most"),
        F.min("submitted_at").alias("first"),
        F.max("submitted_at").alias("last"),
        F.countDistinct("record_id").alias("ids"),
        F.count_if(F.size(F.array_distinct("flags")) < F.size("flags")).alias("repeated"),
    ).head()
    assert abs(row["notes"] - 0.3) < 0.02
    assert (row["least"], row["most"], row["ids"], row["repeated"]) == (1, 50, n, 0)
    assert datetime(2024, 3, 3) <= row["first"] <= row["last"] <= datetime(2024, 6, 1)
    assert run_gate(made, document_expectations()).passed
    checked = check_contract(normalize(made))
    assert checked.where(F.size("violations") > 0).count() == 0


def test_partitions_do_not_change_the_records(spark):
    one = synth_records(spark.range(0, 500, 1, 1), 7, AS_OF)
    many = synth_records(spark.range(0, 500, 1, 9), 7, AS_OF)
    other = synth_records(spark.range(0, 500, 1, 1), 8, AS_OF)
    assert one.exceptAll(many).count() == 0
    assert one.select("record_id").intersect(other.select("record_id")).count() == 0
