"""The stream job: every micro-batch is scored, audited and dead-lettered, and gated if asked."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType

from docgate.operators.gate import Expectation, gate_view
from docgate.plans.batch import audit_reduced, reduce_run, run_gate
from docgate.plans.staging import Scoring, dead_letter_failures, stage
from docgate.sources.ndjson import parse_lines, well_formed
from docgate.sources.payloads import decode_payloads


def stream_run_id(batch: DataFrame, batch_id: int) -> str:
    """``<query id>-<batch id>``: the same for a batch that is run again after a restart."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query_id}-{batch_id}"


def screen_batch(
    out: str,
    scoring: Scoring,
    *,
    stream_name: str,
    prompt_hash: str | None = None,
    expectations: Sequence[Expectation] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function to give to ``foreachBatch``.

    A stream has no gate unless ``expectations`` are given: audit rows then carry its verdict, which
    does not stop the stream; without, they say passed. An empty batch does nothing.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_id = stream_run_id(batch, batch_id)
        parsed = parse_batch(batch, stream_name)
        passed = not expectations or run_gate(gate_view(well_formed(parsed)), expectations).passed
        staged = stage(parsed, f"{out}/staging", run_id, scoring)
        reduced = reduce_run(staged, f"{out}/reduced", run_id)
        audit_reduced(reduced, out, run_id, scoring, passed, prompt_hash, source_bucket=stream_name)
        dead_letter_failures(staged, out, run_id)

    return process


def parse_batch(batch: DataFrame, stream_name: str) -> DataFrame:
    """Lines or payloads of one micro-batch, parsed, with the columns of a batch scan."""
    names = batch.columns
    key = [name for name in ("source_path", "shard") if name in names][:1]
    located = batch.select(
        *[name for name in ("value", "data") if name in names][-1:],
        F.lit(stream_name).alias("source_bucket"),
        (F.col(key[0]) if key else F.lit(None).cast("string")).alias("source_key"),
        (F.col("source_block") if "source_block" in names else F.lit(0)).cast("bigint").alias(
            "source_block"
        ),
        (F.col("sequence") if key == ["shard"] else F.monotonically_increasing_id())
        .cast("bigint")
        .alias("source_seq"),
    )
    return decode_payloads(located) if "data" in located.columns else parse_lines(located)


def without_copies(lines: DataFrame, within: str) -> DataFrame:
    """Stream lines or payloads without those whose record came before, in whatever micro-batch.

    A record is known by its ``record_id``, a line without one by its whole text. It is remembered
    for ``within`` (such as ``1 hour``) after it arrived, so the state holds what arrives in that
    time and no more. Arrival, not the record's own time, drives the watermark: no record is ever too
    late. Of copies the first to arrive stays. Lines are shuffled by a hash of the record; copies of
    one record pass by one row of state and are never gathered.
    """
    text = F.col([name for name in ("value", "data") if name in lines.columns][-1])
    if "data" in lines.columns and not isinstance(lines.schema["data"].dataType, BinaryType):
        text = F.coalesce(F.try_to_binary(text, F.lit("base64")).cast("string"), text)
    text = text.cast("string")
    known = F.concat(F.lit("id "), F.get_json_object(text, "$.record_id"))
    key = F.sha2(F.coalesce(known, F.concat(F.lit("line "), text), F.lit("")), 256)
    arrived = lines.withColumns({"_copy_of": key, "_arrived": F.current_timestamp()})
    kept = arrived.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_copy_of"])
    return kept.drop("_copy_of", "_arrived")


def start_stream(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    scoring: Scoring,
    *,
    stream_name: str,
    every: str | None = "5 minutes",
    prompt_hash: str | None = None,
    expectations: Sequence[Expectation] | None = None,
    unique_within: str | None = None,
) -> StreamingQuery:
    """Start the stream job. ``every=None`` works off what is there and stops.

    With ``unique_within`` a record that came before is left out (:func:`without_copies`).
    """
    if unique_within is not None:
        lines = without_copies(lines, unique_within)
    process = screen_batch(
        out.rstrip("/"),
        scoring,
        stream_name=stream_name,
        prompt_hash=prompt_hash,
        expectations=expectations,
    )
    writer = lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
