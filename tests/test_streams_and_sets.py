"""Copies across micro-batches, running totals, sets given as frames, Python's JSON."""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from docgate.functions.text import python_json
from docgate.operators import gate
from docgate.plans.batch import run_gate
from docgate.streaming.job import without_copies
from docgate.streaming.source import read_line_stream
from docgate.streaming.totals import read_totals, start_totals

TEXTS = [
    "plain", "", None, 'quote " and \\ slash', "tab\tnew\nline\r\x08\x0c", "\x00\x01\x1f\x7f",
    "Ärger, señor, naïve", "  　 中文", "emoji 😀 and 𝒳, again 😀", "\\u0041 \\n $1 \\\\", "/</>&'",
]


def test_json_and_hash_equal_pythons(spark):
    when = [datetime(2024, 1, 2, 3, 4, 5, n % 3 * 100, tzinfo=UTC) for n in range(len(TEXTS))]
    rows = [
        {"b": text, "a": n, "tags": [text, "x"] if n % 2 else [], "at": at, "ok": None if n == 1 else n > 2}
        for n, (text, at) in enumerate(zip(TEXTS, when, strict=True))
    ]
    frame = spark.createDataFrame(rows, "b string, a long, tags array<string>, at timestamp, ok boolean")
    got = frame.select("a", python_json(frame, frame.columns).alias("j")).collect()
    want = {row["a"]: json.dumps(row, sort_keys=True, default=str) for row in rows}
    assert {r.a: r.j for r in got} == want
    digest = frame.select("a", F.sha2(python_json(frame, frame.columns), 256).alias("h")).collect()
    assert {r.a: r.h for r in digest} == {a: hashlib.sha256(j.encode()).hexdigest() for a, j in want.items()}
    with pytest.raises(TypeError):
        python_json(frame.withColumn("d", F.lit(1.5)), ["d"])


@pytest.mark.parametrize("bound", [gate.BROADCAST_VALUES, 4, 1])
def test_a_set_in_a_frame_counts_and_samples_like_a_list(spark, bound):
    allowed = [f"v{n}" for n in range(0, 40, 2)]
    # A third of all rows share one value outside the set.
    rows = [(f"r{n:04d}", None if n % 11 == 0 else "v1" if n % 3 == 0 else f"v{n % 45}") for n in range(600)]
    batch = spark.createDataFrame(rows, "record_id string, agency string")
    repeated = spark.createDataFrame([(v,) for v in allowed * 2] + [(None,)], "v string")
    listed = run_gate(batch, [gate.not_null("agency"), gate.in_set("agency", allowed)])
    marked, rules = gate.with_marks(
        batch, [gate.not_null("agency"), gate.in_frame("agency", repeated)], bound
    )
    assert marked.count() == len(rows)
    assert run_gate(marked, rules) == listed
    if bound == gate.BROADCAST_VALUES:
        assert run_gate(batch, [gate.not_null("agency"), gate.in_frame("agency", repeated)]) == listed


def test_an_empty_set_and_an_absent_column(spark):
    batch = spark.createDataFrame([("a", "x"), ("b", None)], "record_id string, agency string")
    none = spark.createDataFrame([], "v string")
    result = run_gate(batch, [gate.in_frame("agency", none), gate.in_frame("lacking", none)])
    assert [(d["column"], d["unexpected_count"]) for d in result.failure_details] == [
        ("agency", 1), ("lacking", 0)
    ]
    assert run_gate(batch.limit(0), [gate.in_frame("agency", none)]).passed


def drain(stream, root):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def test_copies_are_known_across_restarts_and_lines_without_id_by_their_text(spark, tmp_path):
    root = str(tmp_path)
    first = ['{"record_id": "1", "x": 1}', '{"record_id": "2"}', "broken", "{}", '{"record_id": null}']
    second = ['{"x": 1, "record_id": "1"}', '{"record_id": "3"}', "broken", "other", "{}"]
    for lot in (first * 2, second):
        spark.createDataFrame([(line,) for line in lot], "value string").write.mode("append").text(
            f"{root}/in"
        )
        drain(without_copies(read_line_stream(spark, f"{root}/in"), "1 day"), root)
    got = sorted(r.value for r in spark.read.parquet(f"{root}/out").collect())
    assert got == sorted([*first, '{"record_id": "3"}', "other"])


def test_totals_go_on_after_a_restart(spark, tmp_path):
    root = str(tmp_path)
    kinds = "model_id string, input_tokens int, output_tokens int"
    assert read_totals(spark, f"{root}/totals").count() == 0
    for lot in ([("a", 1, 2), ("b", 3, 4)], [("a", 10, 20)], []):
        spark.createDataFrame(lot, kinds).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(kinds).parquet(f"{root}/in")
        start_totals(stream, f"{root}/totals", f"{root}/state", every=None).awaitTermination()
    got = {tuple(row) for row in read_totals(spark, f"{root}/totals").collect()}
    assert got == {("a", 11, 22, 2), ("b", 3, 4, 1)}
