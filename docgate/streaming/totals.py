"""Running token totals per model, as streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docgate.operators.cost import cost_summary, cost_totals
from docgate.plans.staging import STAGING_SCHEMA
from docgate.session import child_names, path_exists

TOTALS_SCHEMA = "model_id STRING, input_tokens BIGINT, output_tokens BIGINT, requests BIGINT"


def billed_stream(spark: SparkSession, staging: str) -> DataFrame:
    """Every paid call of a job's staging table as a stream, calls made again included.

    Both jobs add files there and never change them.
    """
    rows = spark.readStream.schema(STAGING_SCHEMA).option("recursiveFileLookup", "true").parquet(staging)
    return rows.where("billed").select("model_id", "input_tokens", "output_tokens")


def start_totals(
    billed: DataFrame, out: str, checkpoint: str, *, every: str | None = "5 minutes"
) -> StreamingQuery:
    """Keep the totals of (model_id, input_tokens, output_tokens) over all micro-batches.

    The state is one row per model, so it does not grow with the calls; a restart goes on with it.
    Each micro-batch writes all totals to a folder of its own below ``out``, which a batch run again
    after a restart replaces. ``every=None`` works off what is there and stops.
    """
    out = out.rstrip("/")

    def keep(totals: DataFrame, batch_id: int) -> None:
        totals.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch={batch_id:012d}")

    writer = (
        cost_totals(billed)
        .writeStream.outputMode("complete")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals of the newest micro-batch; none before the first."""
    out = out.rstrip("/")
    # A write that did not finish has no marker.
    done = [n for n in child_names(spark, out) if path_exists(spark, f"{out}/{n}/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], TOTALS_SCHEMA)
    return spark.read.schema(TOTALS_SCHEMA).parquet(f"{out}/{max(done)}")


def running_cost(spark: SparkSession, out: str, prices=None) -> DataFrame:
    """The cost of the newest totals."""
    return cost_summary(read_totals(spark, out), prices)
