from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docgate.errors import GateRejected
from docgate.plans.batch import new_run_id, run_batch
from docgate.plans.staging import Scoring
from docgate.schemas import AUDIT_SCHEMA
from docgate.sinks.dead_letter import read_dead_letters
from docgate.sinks.tables import read_table
from docgate.streaming.job import parse_batch, screen_batch, start_stream
from docgate.streaming.source import read_line_stream
from tests.helpers import record, reply_client, write_lines


def calls(path):
    return len(path.read_text().splitlines()) if path.exists() else 0


def letters(spark, out):
    return sorted(
        (r["failure_stage"], r["error_message"]) for r in read_dead_letters(spark, out).collect()
    )


def test_batch_job(spark, tmp_path):
    good = [record() for _ in range(5)]
    write_lines(tmp_path / "in/docs/2024/01/01", "a.ndjson", [*good, good[0], "broken"])
    write_lines(tmp_path / "in/docs/2024/01/02", "b.ndjson", [record(record_id="bad id")])
    out, log = str(tmp_path / "out"), tmp_path / "calls"
    scoring = Scoring(reply_client(calls=str(log)))

    report = run_batch(
        spark, str(tmp_path / "in"), "docs/", out, scoring, run_id="run 1", prompt_hash="p"
    )
    assert (report.gate.passed, report.gate.total) == (True, 7)
    assert (report.bronze_rows, report.gold_rows, report.audit_rows) == (5, 5, 5)
    assert calls(log) == 6
    assert report.cost["requests"] == 6
    assert [stage for stage, _ in letters(spark, out)] == ["ingestion", "normalization"]
    assert report.dead_letters["classification"] == ""
    rows = read_table(spark, f"{out}/audit", AUDIT_SCHEMA).collect()
    assert {r["record_id"] for r in rows} == {r["record_id"] for r in good}
    keys = "docs/2024/01/01/a.ndjson"
    assert {(r["source_bucket"], r["source_key"], r["quality_gate_passed"]) for r in rows} == {
        ("in", keys, True)
    }
    sources = spark.read.parquet(f"{out}/run_sources").collect()
    assert {r["source_key"]: r["records"] for r in sources} == {
        "docs/2024/01/01/a.ndjson": 7,
        "docs/2024/01/02/b.ndjson": 1,
    }

    again = run_batch(spark, str(tmp_path / "in"), "docs/", out, scoring, run_id="run 1")
    assert (again.bronze_rows, again.gold_rows, again.audit_rows) == (0, 0, 0)
    assert calls(log) == 6
    assert read_table(spark, f"{out}/bronze").count() == 5


def test_restart_scores_only_what_is_missing(spark, tmp_path):
    log = tmp_path / "calls"
    scoring = Scoring(reply_client(calls=str(log)))
    write_lines(tmp_path / "in", "a.ndjson", [record(), record()])
    run_batch(spark, str(tmp_path / "in"), "", str(tmp_path / "out"), scoring, run_id="r")
    write_lines(tmp_path / "in", "b.ndjson", [record()])
    report = run_batch(spark, str(tmp_path / "in"), "", str(tmp_path / "out"), scoring, run_id="r")
    assert (calls(log), report.bronze_rows, report.audit_rows) == (3, 1, 1)


def test_finished_waves_are_kept(spark, tmp_path):
    log, out = tmp_path / "calls", str(tmp_path / "out")
    records = [record(pages=i + 1) for i in range(40)]
    write_lines(tmp_path / "in", "a.ndjson", records)

    def make():
        answer = reply_client(calls=str(log))()
        refuse = reply_client("no json")()
        return lambda bodies: [
            (refuse if "pages: 7\\n" in body else answer)([body])[0] for body in bodies
        ]

    with pytest.raises(PySparkException, match="no verdict"):
        run_batch(
            spark, str(tmp_path / "in"), "", out, Scoring(make, waves=8, strict=True), run_id="r"
        )
    files = list((tmp_path / "out/staging").glob("*/*/part-*"))
    kept = spark.read.parquet(*map(str, files)).count() if files else 0
    before = calls(log)
    scoring = Scoring(reply_client(calls=str(log)), waves=8)
    report = run_batch(spark, str(tmp_path / "in"), "", out, scoring, run_id="r")
    assert (report.bronze_rows, report.audit_rows) == (40, 40)
    assert calls(log) - before == 40 - kept
    staged = spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/staging")
    assert staged.count() == 40


def test_rejected_batch_is_dead_lettered_whole(spark, tmp_path):
    write_lines(tmp_path / "in", "a.ndjson", [record(), record(agency="NASA"), "broken"])
    out, log = str(tmp_path / "out"), tmp_path / "calls"
    with pytest.raises(GateRejected, match="gate closed: 1 defects in 2 records"):
        run_batch(spark, str(tmp_path / "in"), "", out, Scoring(reply_client(calls=str(log))))
    assert [stage for stage, _ in letters(spark, out)] == ["ingestion", *["quality_gate"] * 2]
    assert (calls(log), read_table(spark, f"{out}/gold").count()) == (0, 0)


def test_rejected_batch_may_go_on(spark, tmp_path):
    write_lines(tmp_path / "in", "a.ndjson", [record(), record(agency="uscis")])
    scoring = Scoring(reply_client())
    report = run_batch(
        spark,
        str(tmp_path / "in"),
        "",
        str(tmp_path / "out"),
        scoring,
        stop_on_reject=False,
        bronze_on_reject=True,
    )
    assert (report.bronze_rows, report.gold_rows, report.audit_rows) == (2, 0, 2)
    fixed = run_batch(
        spark,
        str(tmp_path / "in"),
        "",
        str(tmp_path / "out2"),
        scoring,
        gate_after_normalize=True,
    )
    assert fixed.gold_rows == 2


def test_failed_replies_are_dead_lettered_and_billed(spark, tmp_path):
    given = record()
    write_lines(tmp_path / "in", "a.ndjson", [given])
    out = str(tmp_path / "out")
    report = run_batch(spark, str(tmp_path / "in"), "", out, Scoring(reply_client("no json")))
    assert (report.bronze_rows, report.audit_rows, report.cost["input_tokens"]) == (0, 0, 100)
    letter = read_dead_letters(spark, out).head()
    assert letter["error_message"] == f"no verdict on record {given['record_id']}: non_json"
    assert json.loads(letter["record"])["record_id"] == given["record_id"]


@pytest.mark.parametrize(
    ("line", "reply", "message"),
    [
        ("broken", None, "not a JSON object: line"),
        (record(record_id="r-9"), None, "contract broken by record r-9"),
        (record(), "no json", "no verdict on record"),
    ],
)
def test_strict_jobs_stop(spark, tmp_path, line, reply, message):
    write_lines(tmp_path / "in", "a.ndjson", [record(), line])
    scoring = Scoring(reply_client(reply), strict=True)
    with pytest.raises(PySparkException, match=message):
        run_batch(spark, str(tmp_path / "in"), "", str(tmp_path / "out"), scoring)


def test_unknown_model_is_refused_before_any_call(spark, tmp_path):
    write_lines(tmp_path / "in", "a.ndjson", [record()])
    log = tmp_path / "calls"
    scoring = Scoring(reply_client(calls=str(log)), model_id="other", callers=2)
    with pytest.raises(KeyError, match="other"):
        run_batch(spark, str(tmp_path / "in"), "", str(tmp_path / "out"), scoring)
    assert calls(log) == 0


def test_empty_source(spark, tmp_path):
    report = run_batch(spark, str(tmp_path / "none"), "", str(tmp_path / "out"), Scoring(reply_client()))
    assert (report.gate.passed, report.gate.total, report.bronze_rows) == (True, 0, 0)
    assert report.cost["requests"] == 0
    assert new_run_id() != new_run_id()


def test_partitioning_does_not_change_the_tables(spark, tmp_path):
    write_lines(tmp_path / "in", "a.ndjson", [record(pages=i + 1) for i in range(60)])
    scoring = Scoring(reply_client())
    found = []
    for size in ("134217728", "2000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        out = str(tmp_path / size)
        run_batch(spark, str(tmp_path / "in"), "", out, scoring, run_id="r")
        rows = read_table(spark, f"{out}/audit", AUDIT_SCHEMA).drop("audit_id", "created_at", "classified_at")
        found.append({str(r) for r in rows.collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and len(found[0]) == 60


def stream(spark, tmp_path, scoring):
    out = str(tmp_path / "out")
    query = start_stream(
        read_line_stream(spark, str(tmp_path / "in")),
        out,
        str(tmp_path / "checkpoint"),
        scoring,
        stream_name="feed",
        every=None,
    )
    query.awaitTermination()
    return read_table(spark, f"{out}/audit", AUDIT_SCHEMA).collect()


def test_stream_job_resumes(spark, tmp_path):
    log = tmp_path / "calls"
    scoring = Scoring(reply_client(calls=str(log)))
    (tmp_path / "in").mkdir()
    write_lines(tmp_path / "in", "a.ndjson", [record(), record(agency="uscis"), "broken"])
    rows = stream(spark, tmp_path, scoring)
    assert [(r["quality_gate_passed"], r["source_bucket"]) for r in rows] == [(True, "feed")] * 2
    assert len(stream(spark, tmp_path, scoring)) == 2
    write_lines(tmp_path / "in", "b.ndjson", [record()])
    rows = stream(spark, tmp_path, scoring)
    assert [r["quality_gate_passed"] for r in rows] == [True] * 3
    runs = {r["pipeline_run_id"] for r in rows}
    assert {run.rsplit("-", 1)[1] for run in runs} == {"0", "1"}
    assert len({run.rsplit("-", 1)[0] for run in runs}) == 1
    assert "None" not in runs.pop()
    assert calls(log) == 3
    assert [s for s, _ in letters(spark, str(tmp_path / "out"))] == ["ingestion"]


def test_replayed_micro_batch_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("docgate.streaming.job.stream_run_id", lambda batch, number: f"q-{number}")
    log, out = tmp_path / "calls", str(tmp_path / "out")
    process = screen_batch(out, Scoring(reply_client(calls=str(log))), stream_name="feed")
    rows = [(json.dumps(record()), "f", 0) for _ in range(4)]
    batch = spark.createDataFrame(rows, "value STRING, source_path STRING, source_block BIGINT")
    for _ in range(2):
        process(batch, 7)
    assert read_table(spark, f"{out}/audit", AUDIT_SCHEMA).count() == 4
    assert calls(log) == 4
    process(batch.limit(0), 8)
    assert calls(log) == 4


def test_payload_batches(spark):
    import base64

    data = base64.b64encode(json.dumps(record()).encode()).decode()
    batch = spark.createDataFrame([(data,)], "data STRING")
    row = parse_batch(batch, "feed").head()
    assert (row["malformed"], row["source_bucket"], row["source_key"]) == (False, "feed", None)


def test_payload_stream(spark, tmp_path):
    """A connector's stream of base64 payloads; here the connector is the text format."""
    import base64

    from docgate.streaming.source import read_payload_stream

    (tmp_path / "in").mkdir()
    texts = [json.dumps(record()), json.dumps(record(agency="NASA")), "broken"]
    lines = [base64.b64encode(text.encode()).decode() for text in texts]
    (tmp_path / "in/a.txt").write_text("\n".join([*lines, "%%%"]) + "\n")
    out = str(tmp_path / "out")
    query = start_stream(
        read_payload_stream(spark, "text", {"path": str(tmp_path / "in")}),
        out,
        f"{out}/checkpoint",
        Scoring(reply_client()),
        stream_name="feed",
        every=None,
    )
    query.awaitTermination()
    rows = read_table(spark, f"{out}/audit", AUDIT_SCHEMA).collect()
    assert [(r["source_bucket"], r["source_key"]) for r in rows] == [("feed", "unknown")]
    stages = [stage for stage, _ in letters(spark, out)]
    assert stages == ["ingestion", "ingestion", "normalization"]
    lost = read_dead_letters(spark, out, "ingestion").collect()
    assert {json.loads(r["record"])["_raw_line"] for r in lost} == {"broken", "%%%"}


def test_a_model_that_was_down_is_asked_again(spark, tmp_path):
    given = [record(pages=i + 1) for i in range(4)]
    write_lines(tmp_path / "in", "a.ndjson", [*given, given[0], "broken"])
    out, log = str(tmp_path / "out"), tmp_path / "calls"

    def down():
        def client(bodies):
            raise ConnectionError("down")

        return client

    first = run_batch(spark, str(tmp_path / "in"), "", out, Scoring(down), run_id="r")
    assert (first.bronze_rows, first.audit_rows) == (0, 0)
    assert [stage for stage, _ in letters(spark, out)] == [*["classification"] * 5, "ingestion"]
    up = Scoring(reply_client(calls=str(log)))
    for inserted, asked in ((4, 5), (0, 5)):
        report = run_batch(spark, str(tmp_path / "in"), "", out, up, run_id="r")
        assert (report.bronze_rows, report.gold_rows, report.audit_rows) == (inserted,) * 3
        assert calls(log) == asked
        assert [stage for stage, _ in letters(spark, out)] == ["ingestion"]
    source = json.loads(read_dead_letters(spark, out).head()["record"])
    assert (source["_source_bucket"], source["_source_key"], source["_source_line_number"]) == ("in", "a.ndjson", 6)


def test_a_worker_holds_few_long_requests_at_once(spark, tmp_path):
    """The requests of a task are 80 MB, in 8,000 rows; a worker must not grow by most of that."""
    from docgate.plans.staging import results, stage
    from tests.helpers import lines

    def resident():
        with open("/proc/self/statm") as own:
            return int(own.read().split()[1]) * 4096

    def make():
        answer, before = reply_client()(), resident()

        def client(bodies):
            if resident() - before > 50 << 20:
                raise MemoryError("too many requests at once")
            return answer(bodies)

        return client

    one = lines(spark, [record(document_text="A long petition. " * 580)]).drop("source_seq")
    some = spark.range(0, 8_000, 1, 1).withColumnRenamed("id", "source_seq").join(F.broadcast(one))
    staged = stage(some.select(*lines(spark, []).columns), str(tmp_path / "staging"), "r", Scoring(make))
    assert results(staged).count() == 8_000


def test_oversize_requests_are_refused_without_a_call(spark, tmp_path):
    write_lines(tmp_path / "in", "a.ndjson", [record(), record(document_text="long " * 1_000)])
    out, log = str(tmp_path / "out"), tmp_path / "calls"
    scoring = Scoring(
        reply_client(calls=str(log)), requests_per_minute=600, tokens_per_minute=1_000, callers=1
    )
    report = run_batch(spark, str(tmp_path / "in"), "", out, scoring, run_id="r")
    assert (report.bronze_rows, calls(log)) == (1, 1)
    assert [(s, m.rpartition(": ")[2]) for s, m in letters(spark, out)] == [("classification", "oversize")]
    with pytest.raises(KeyError, match="v9"):
        Scoring(reply_client(), prompt_version="v9")
    named = Scoring(reply_client(), prompt_version="v9", prompts={"v9": " Judge. "})
    assert named.system_prompt == "Judge." and len(named.prompt_hash) == 64


def test_results_are_shuffled_once(spark, tmp_path):
    """Bronze, gold and audit are written from the reduced run without another exchange."""
    from docgate.plans.batch import audit_rows, reduce_run
    from docgate.plans.staging import staged_run

    write_lines(tmp_path / "in", "a.ndjson", [record() for _ in range(3)])
    out = str(tmp_path / "out")
    run_batch(spark, str(tmp_path / "in"), "", out, Scoring(reply_client()), run_id="r")
    reduced = reduce_run(staged_run(spark, f"{out}/staging", "r"), f"{out}/again", "r")
    rows = audit_rows(reduced, run_id="r", gate_passed=True)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 3
