"""Token cost: totals, summaries and per-row cost, in exact decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.schemas import DEFAULT_PRICES


UNKNOWN_SOURCE = "unknown"
BROADCAST_PRICES = 10_000
SALTS = 64


def _priced(rows: DataFrame, prices=None) -> DataFrame:
    """Add ``input_usd_per_1k`` and ``output_usd_per_1k``, NULL for models without a price.

    ``prices`` is a dict ``model -> (input, output)``, which becomes a literal lookup in the
    projection, or a frame (model_id, input_usd_per_1k, output_usd_per_1k). A run has few models, so
    a join on them is one hot key: a frame of up to ``BROADCAST_PRICES`` rows is counted and
    broadcast, and a larger one joined on the model and a salt. None means the default prices.
    """
    if isinstance(prices, DataFrame):
        if prices.limit(BROADCAST_PRICES + 1).count() <= BROADCAST_PRICES:
            return rows.join(F.broadcast(prices), "model_id", "left")
        salts = prices.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn("_salt", (F.rand() * SALTS).cast("int"))
        return salted.join(salts, ["model_id", "_salt"], "left").drop("_salt")
    table = DEFAULT_PRICES if prices is None else prices
    found = {"input_usd_per_1k": 0, "output_usd_per_1k": 1}
    columns = {}
    for name, side in found.items():
        pairs = [
            F.lit(part)
            for model, price in table.items()
            for part in (model, Decimal(str(price[side])).quantize(Decimal("0.000001")))
        ]
        columns[name] = F.create_map(*pairs)[F.col("model_id")] if pairs else F.lit(None)
    return rows.withColumns({n: c.cast("decimal(12,6)") for n, c in columns.items()})


def _usd(tokens: Column, per_thousand: Column) -> Column:
    return tokens.cast("decimal(20,0)") * per_thousand.cast("decimal(12,6)") * F.lit(Decimal("0.001"))


def cost_totals(billed: DataFrame) -> DataFrame:
    """Token sums and request count per model. Negative counts are an error."""
    checked = [
        F.when(
            F.col(name) < 0, F.raise_error(F.lit("token counts must be non-negative")).cast("int")
        )
        .otherwise(F.col(name))
        .alias(name)
        for name in ("input_tokens", "output_tokens")
    ]
    return (
        billed.select("model_id", *checked)
        .groupBy("model_id")
        .agg(
            F.sum("input_tokens").alias("input_tokens"),
            F.sum("output_tokens").alias("output_tokens"),
            F.count(F.lit(1)).alias("requests"),
        )
    )


def cost_summary(totals: DataFrame, prices=None) -> DataFrame:
    """Cost of each model's totals; a model without a price is an error that names it.

    Both parts are rounded to 6 places; the total is rounded from the unrounded sum.
    """
    priced = _priced(totals, prices)
    missing = F.concat(F.lit("No pricing configured for model "), F.col("model_id"))
    price_in = F.when(
        F.col("input_usd_per_1k").isNull(), F.raise_error(missing).cast("decimal(12,6)")
    ).otherwise(F.col("input_usd_per_1k"))
    cost_in = _usd(F.col("input_tokens"), price_in)
    cost_out = _usd(F.col("output_tokens"), F.col("output_usd_per_1k"))
    return priced.select(
        "model_id",
        "input_tokens",
        "output_tokens",
        cost_in.cast("decimal(18,6)").alias("input_cost_usd"),
        cost_out.cast("decimal(18,6)").alias("output_cost_usd"),
        (cost_in + cost_out).cast("decimal(18,6)").alias("total_cost_usd"),
        "requests",
    )


def run_cost(billed: DataFrame, model_id: str, prices=None) -> DataFrame:
    """One summary row for one model, zeros when it was never called."""
    totals = cost_totals(billed.where(F.col("model_id") == model_id)).agg(
        F.lit(model_id).alias("model_id"),
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("input_tokens", "output_tokens", "requests")
        ],
    )
    return cost_summary(totals, prices)


def observed_totals(spark: SparkSession, model_id: str, counts: list[dict]) -> DataFrame:
    """Totals of one model from what was counted while its rows were written, one dict per write."""
    names = ("input_tokens", "output_tokens", "requests")
    row = (model_id, *[sum(each[name] for each in counts) for name in names])
    kinds = "model_id STRING, input_tokens BIGINT, output_tokens BIGINT, requests BIGINT"
    return spark.createDataFrame([row], kinds)


def unknown_models(rows: DataFrame, prices=None) -> DataFrame:
    """Models without a price, to be asked before anything is paid for."""
    models = rows.select("model_id").distinct()
    return _priced(models, prices).where(F.col("input_usd_per_1k").isNull()).select("model_id")


def with_row_cost(results: DataFrame, prices=None) -> DataFrame:
    """Add ``cost_input_usd``, ``cost_output_usd`` and ``cost_usd`` to every row.

    The total adds the rounded parts. Models without a price cost 0.
    """
    priced = _priced(results, prices)
    zero = F.lit(Decimal("0.000000")).cast("decimal(12,6)")
    parts = {
        "cost_input_usd": _usd(F.col("input_tokens"), F.col("input_usd_per_1k")),
        "cost_output_usd": _usd(F.col("output_tokens"), F.col("output_usd_per_1k")),
    }
    return (
        priced.withColumns(
            {name: F.coalesce(c.cast("decimal(12,6)"), zero) for name, c in parts.items()}
        )
        .withColumn(
            "cost_usd", (F.col("cost_input_usd") + F.col("cost_output_usd")).cast("decimal(12,6)")
        )
        .drop("input_usd_per_1k", "output_usd_per_1k")
        .select(*results.columns, "cost_input_usd", "cost_output_usd", "cost_usd")
    )


def source_counts(records: DataFrame) -> DataFrame:
    """Distinct source keys with their row counts; rows without one count as ``unknown``."""
    key = F.coalesce(F.col("source_key"), F.lit(UNKNOWN_SOURCE))
    return records.groupBy(key.alias("source_key")).agg(F.count(F.lit(1)).alias("records"))
