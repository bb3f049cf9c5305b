from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docgate.operators.admission import (
    budget_usage,
    caller_budget,
    feasible,
    infeasible,
)
from docgate.operators.cost import (
    cost_summary,
    cost_totals,
    run_cost,
    source_counts,
    unknown_models,
    with_row_cost,
)
from docgate.operators.ordering import first_per_key, last_per_key
from docgate.schemas import DEFAULT_MODEL


def usage(spark, rows, model=DEFAULT_MODEL):
    return spark.createDataFrame(
        [(model, a, b) for a, b in rows], "model_id STRING, input_tokens INT, output_tokens INT"
    )


def test_totals(spark):
    row = cost_totals(usage(spark, [(500, 100), (300, 50), (200, 50)])).head()
    assert (row["input_tokens"], row["output_tokens"], row["requests"]) == (1000, 200, 3)


def test_negative_counts_are_refused(spark):
    with pytest.raises(PySparkException, match="non-negative"):
        cost_totals(usage(spark, [(-1, 0)])).collect()


@pytest.mark.parametrize(
    ("rows", "costs"),
    [
        ([(10_000, 2_000)], ("0.030000", "0.030000", "0.060000")),
        ([(1_500, 300)] * 100, ("0.450000", "0.450000", "0.900000")),
        ([], ("0.000000", "0.000000", "0.000000")),
    ],
)
def test_run_cost(spark, rows, costs):
    row = run_cost(usage(spark, rows), DEFAULT_MODEL).head()
    assert (row["input_cost_usd"], row["output_cost_usd"], row["total_cost_usd"]) == tuple(
        Decimal(cost) for cost in costs
    )
    assert row["requests"] == len(rows)


def test_custom_prices(spark):
    prices = {"m": (Decimal("0.01"), Decimal("0.05"))}
    row = cost_summary(cost_totals(usage(spark, [(1_000, 1_000)], "m")), prices).head()
    assert row["total_cost_usd"] == Decimal("0.06")
    frame = spark.createDataFrame(
        [("m", Decimal("0.01"), Decimal("0.05"))],
        "model_id STRING, input_usd_per_1k DECIMAL(12,6), output_usd_per_1k DECIMAL(12,6)",
    )
    assert run_cost(usage(spark, [(1_000, 1_000)], "m"), "m", frame).head()["total_cost_usd"] == Decimal("0.06")


def test_unknown_model(spark):
    rows = usage(spark, [(1, 1)], "other")
    with pytest.raises(PySparkException, match="No pricing configured for model other"):
        cost_summary(cost_totals(rows)).collect()
    assert [r["model_id"] for r in unknown_models(rows).collect()] == ["other"]
    assert with_row_cost(rows).head()["cost_usd"] == Decimal("0.000000")


def test_row_cost_adds_rounded_parts(spark):
    prices = {"m": (Decimal("0.0005"), Decimal("0.0005"))}
    rows = usage(spark, [(1, 1)], "m")
    row = with_row_cost(rows, prices).head()
    assert (row["cost_input_usd"], row["cost_usd"]) == (Decimal("0.000001"), Decimal("0.000002"))
    assert cost_summary(cost_totals(rows), prices).head()["total_cost_usd"] == Decimal("0.000001")


def test_source_counts(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,)], "source_key STRING")
    assert {r["source_key"]: r["records"] for r in source_counts(rows).collect()} == {"a": 2, "unknown": 1}


def requests_of(spark, runs):
    rows = [(run, i, amount) for run, amounts in runs.items() for i, amount in enumerate(amounts)]
    return spark.createDataFrame(rows, "run STRING, seq BIGINT, tokens BIGINT")


def test_infeasible(spark):
    rows = requests_of(spark, {"a": [101, -1, 100, 0]})
    assert infeasible(rows, 100).count() == 2
    assert feasible(rows, 100).count() == 2
    for wrong in (0, -1):
        with pytest.raises(ValueError, match="positive"):
            infeasible(rows, wrong)
        with pytest.raises(ValueError, match="positive"):
            caller_budget(wrong, 10, 1)


def test_budget(spark):
    assert caller_budget(60, 40_000, 4) == (15.0, 10_000.0)
    rows = requests_of(spark, {"a": [100] * 30}).withColumn("caller", F.lit(0))
    row = budget_usage(rows, "caller", "tokens", 60, 40_000, 4).head()
    assert (row["requests"], row["minutes"]) == (30, 2.0)


def test_first_and_last_of_a_hot_key_are_limited_before_the_shuffle(spark):
    rows = spark.range(1_000).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS k", "id")
    first = {r["k"]: r["id"] for r in first_per_key(rows, ["k"], ["id"]).collect()}
    last = {r["k"]: r["id"] for r in last_per_key(rows, ["k"], ["id"]).collect()}
    assert (first["hot"], last["hot"], len(first)) == (0, 999, 667)
    plan = first_per_key(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
