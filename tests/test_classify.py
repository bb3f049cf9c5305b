from __future__ import annotations

import itertools
import json
import os
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.clients import rule_scorer
from docgate.operators.admission import caller_budget
from docgate.operators.contract import parse_contract
from docgate.operators.replies import classify, parse_envelopes, parse_replies
from docgate.operators.requests import with_requests
from docgate.operators.scoring import Pace, _ask, score, score_from_table
from docgate.sources.ndjson import parse_lines
from tests.helpers import lines, record

VERDICT = {
    "compliance_score": 0.5,
    "risk_tier": "low",
    "policy_alignment": "aligned",
    "reasoning": "r",
}


def requests_of(spark, *records):
    return with_requests(parse_contract(parse_lines(lines(spark, records))), "system")


def envelope(text, usage=None):
    body = {"content": [{"type": "text", "text": text}]}
    return json.dumps(body if usage is None else {**body, "usage": usage})


def test_message_and_body(spark):
    given = record(pages="2", flags=["a", "b"], document_text="Ten and more characters")
    row = requests_of(spark, given).head()
    body = json.loads(row["request_body"])
    message = body["messages"][0]["content"][0]["text"]
    assert body["anthropic_version"] == "bedrock-2023-05-31"
    assert (body["max_tokens"], body["temperature"], body["system"]) == (512, 0.0, "system")
    assert message.splitlines() == [
        "Evaluate this federal document record for compliance.",
        f"record_id: {given['record_id']}",
        "agency: USCIS",
        "document_type: N-400 Naturalization",
        "case_status: pending",
        "priority_tier: standard",
        "pages: 2",
        "flags: a, b",
        "document_text:",
        "Ten and more characters",
    ]
    assert row["estimated_tokens"] == len(message) // 4 + 512
    assert "flags: none\n" in json.loads(requests_of(spark, record(flags=[])).head()["request_body"])[
        "messages"
    ][0]["content"][0]["text"]


@pytest.mark.parametrize("chunk", [1, 3, 25, 1000])
def test_one_answer_per_row_whatever_the_chunk(spark, chunk):
    rows = [record(pages=i + 1) for i in range(40)]
    scored = classify(score(requests_of(spark, *rows), rule_scorer(), chunk), "m")
    got = {r["record_id"]: r["reasoning"] for r in scored.collect()}
    assert got == {r["record_id"]: f"{r['pages']} pages" for r in rows}


def test_chunk_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        score(requests_of(spark, record()), rule_scorer(), 0)


def test_failing_calls_are_rows(spark):
    def make():
        def client(bodies):
            if any("pages: 2\n" in body.replace("\\n", "\n") for body in bodies):
                raise RuntimeError("down")
            return [
                ValueError("odd") if "pages: 3\\n" in body else envelope(json.dumps(VERDICT))
                for body in bodies
            ]

        return client

    rows = [record(pages=i) for i in (1, 2, 3)]
    scored = classify(score(requests_of(spark, *rows), make, 1), "m")
    got = {r["pages"]: (r["error_code"], r["score_error"]) for r in scored.collect()}
    assert got == {
        1: (None, None),
        2: ("invoke", "RuntimeError: down"),
        3: ("invoke", "ValueError: odd"),
    }


def test_rows_without_body_are_not_called(spark):
    def make():
        return lambda bodies: [1 / 0 for _ in bodies]

    rows = requests_of(spark, record()).withColumn("request_body", F.lit(None).cast("string"))
    row = score(rows, make).head()
    assert (row["response"], row["score_error"], row["classified_at"]) == (None, None, None)


def test_a_wrong_number_of_answers_is_an_error(spark):
    row = score(requests_of(spark, record()), lambda: lambda bodies: []).head()
    assert row["score_error"] == "ValueError: 0 answers to 1 requests"


def test_stored_responses(spark):
    rows = [record(), record()]
    stored = spark.createDataFrame(
        [(rows[0]["record_id"], envelope(json.dumps(VERDICT)), None)],
        "record_id STRING, response STRING, classified_at TIMESTAMP",
    )
    scored = classify(score_from_table(requests_of(spark, *rows), stored), "m")
    got = {r["record_id"]: r["error_code"] for r in scored.collect()}
    assert got == {rows[0]["record_id"]: None, rows[1]["record_id"]: "invoke"}


ENVELOPES = [
    (None, "envelope", None),
    ("nope", "envelope", None),
    ('{"content":[{"text":"a"}]} x', "envelope", None),
    ("[]", "content", None),
    ("3", "content", None),
    ("{}", "content", None),
    ('{"content":[]}', "content", None),
    ('{"content":{"text":"a"}}', "content", None),
    ('{"content":[{"kind":"x"}]}', "content", None),
    (envelope("a"), None, (0, 0)),
    (envelope("a", {}), None, (0, 0)),
    ('{"content":[{"text":"a"}],"usage":null}', None, (0, 0)),
    (envelope("a", {"input_tokens": 5, "output_tokens": "7"}), None, (5, 7)),
    (envelope("a", {"input_tokens": 5.9}), None, (5, 0)),
    (envelope("a", {"input_tokens": -1}), "usage", None),
    (envelope("a", {"input_tokens": None}), "usage", None),
    (envelope("a", {"output_tokens": "x"}), "usage", None),
]


def test_envelopes(spark):
    frame = spark.createDataFrame(
        [(i, text) for i, (text, _, _) in enumerate(ENVELOPES)], "i INT, response STRING"
    )
    rows = parse_envelopes(frame).orderBy("i").collect()
    for row, (text, error, tokens) in zip(rows, ENVELOPES, strict=True):
        assert (text, row["envelope_error"]) == (text, error)
        assert (row["input_tokens"], row["output_tokens"]) == (tokens or (None, None))


def changed(**changes):
    made = {**VERDICT, **changes}
    return json.dumps({k: v for k, v in made.items() if v is not ...})


REPLIES = [
    (changed(), None, 0.5),
    (changed(compliance_score="0.25", extra=1), None, 0.25),
    (changed(compliance_score=True), None, 1.0),
    (changed(compliance_score=0), None, 0.0),
    (changed(compliance_score=" 1_0e-2 "), None, 0.1),
    (changed(reasoning=5), None, 0.5),
    ("not json", "non_json", None),
    (changed() + " and more", "non_json", None),
    ("```json\n" + changed() + "\n```", "non_json", None),
    (changed().replace('"', "'"), "non_json", None),
    ("[1]", "not_object", None),
    ("3", "not_object", None),
    ("null", "not_object", None),
    ('"text"', "not_object", None),
    (changed(reasoning=...), "missing", None),
    (changed(compliance_score=..., risk_tier="critical"), "missing", None),
    (changed(risk_tier="critical"), "bad_tier", None),
    (changed(risk_tier=["low"]), "bad_tier", None),
    (changed(risk_tier=None), "bad_tier", None),
    (changed(policy_alignment="Aligned"), "bad_alignment", None),
    (changed(compliance_score=None), "bad_score", None),
    (changed(compliance_score=[0.5]), "bad_score", None),
    (changed(compliance_score="half"), "bad_score", None),
    (changed(compliance_score="0.5f"), "bad_score", None),
    (changed(compliance_score=1.5), "score_range", None),
    (changed(compliance_score=-0.1), "score_range", None),
    (changed(compliance_score="nan"), "score_range", None),
    (changed(compliance_score="inf"), "score_range", None),
    (changed(reasoning=None), None, 0.5),
]


def test_replies(spark):
    frame = spark.createDataFrame(
        [(i, text) for i, (text, _, _) in enumerate(REPLIES)], "i INT, reply STRING"
    )
    rows = parse_replies(frame).orderBy("i").collect()
    for row, (text, error, value) in zip(rows, REPLIES, strict=True):
        assert (text, row["reply_error"], row["compliance_score"]) == (text, error, value)


def test_failed_replies_are_billed(spark):
    frame = spark.createDataFrame(
        [(envelope("nope", {"input_tokens": 9, "output_tokens": 1}), None), ("bad", None), (None, "down")],
        "response STRING, score_error STRING",
    )
    rows = classify(frame, "m").collect()
    assert [(r["error_code"], r["billed"], r["tokens_used"]) for r in rows] == [
        ("non_json", True, 10),
        ("envelope", False, None),
        ("invoke", False, None),
    ]


FLOAT_TEXT = st.text("0123456789+-._eE infat\x1c\xa0", max_size=8)


@settings(max_examples=10, deadline=None)
@given(st.lists(FLOAT_TEXT, min_size=1, max_size=60))
def test_score_text_like_python(spark, texts):
    frame = spark.createDataFrame(
        [(i, changed(compliance_score=text)) for i, text in enumerate(texts)], "i INT, reply STRING"
    )
    for row, text in zip(parse_replies(frame).orderBy("i").collect(), texts, strict=True):
        try:
            value = float(text)
            expected = None if 0.0 <= value <= 1.0 else "score_range"
        except ValueError:
            value, expected = None, "bad_score"
        assert (text, row["reply_error"]) == (text, expected)
        if expected is None:
            assert row["compliance_score"] == value


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ("1" * 200_000 + "x", "bad_score"),
        ("1_" * 200_000, "bad_score"),
        ("0_" * 200_000 + "0", None),
        (" " * 200_000 + "0.5", None),
        ("." + "0" * 200_000, None),
    ],
)
def test_long_number_text_is_judged(spark, text, error):
    frame = spark.createDataFrame([(changed(compliance_score=text),)], "reply STRING")
    assert parse_replies(frame).head()["reply_error"] == error
    body = envelope("a", {"input_tokens": text})
    parsed = parse_envelopes(spark.createDataFrame([(body,)], "response STRING")).head()
    assert parsed["envelope_error"] == (None if text.strip("0_") == "" else "usage")


def test_one_raising_record_fails_alone(spark):
    given = [record(pages=i + 1) for i in range(10)]

    def make():
        answer = rule_scorer()()

        def client(bodies):
            if any("pages: 4\\n" in body for body in bodies):
                raise RuntimeError("down")
            return answer(bodies)

        return client

    rows = classify(score(requests_of(spark, *given), make), "m").collect()
    assert [r["error_code"] for r in rows].count(None) == 9
    assert [r["pages"] for r in rows if r["error_code"] == "invoke"] == [4]


def fake_clock(monkeypatch):
    clock = [0.0]
    monkeypatch.setattr("time.monotonic", lambda: clock[0])
    monkeypatch.setattr("time.sleep", lambda seconds: clock.__setitem__(0, clock[0] + seconds))
    return clock


def test_pace_keeps_to_both_limits(monkeypatch):
    clock = fake_clock(monkeypatch)
    pace = Pace(60, 600)
    times = []
    for requests, tokens in [(25, 0), (25, 0), (25, 0), (1, 600), (1, 1_200)]:
        pace.wait(requests, tokens)
        times.append(round(clock[0], 6))
    assert times == [25, 50, 75, 110, 230]  # tokens are saved up for one call only
    clock[0] += 1_000
    pace.wait(25, 0)
    assert clock[0] == 1_230
    pace.wait(25, 0)
    assert clock[0] == 1_255


def test_repeated_calls_are_paced(monkeypatch):
    clock = fake_clock(monkeypatch)
    calls = []

    def client(bodies):
        calls.append((clock[0], len(bodies)))
        raise RuntimeError("throttled")

    answers = _ask(client, ["a", "b", "c"], [1, 1, 1], Pace(60, 10**9))
    assert len(answers) == 3 and calls == [(3, 3), (4, 1), (5, 1), (6, 1)]


def test_short_tasks_keep_to_the_limit(spark, tmp_path):
    """60 tasks of 10 rows, some of whose calls fail: the call log never exceeds the limit."""
    log, callers, per_minute = str(tmp_path), 8, 6_000
    rows = spark.range(0, 600, 1, 60).select(F.col("id").cast("string").alias("request_body"))

    def make():
        import os
        import time
        import uuid

        def client(bodies):
            with open(os.path.join(log, uuid.uuid4().hex), "w") as out:
                out.write(f"{time.time()} {len(bodies)}")
            if "7" in bodies[0]:
                raise RuntimeError("throttled")
            return bodies

        return client

    start = time.time()
    budget = caller_budget(per_minute, 10**15, callers)
    done = score(rows, make, chunk_rows=5, pace=budget).select("response", "score_error").collect()
    assert len(done) == 600
    calls = sorted(tuple(map(float, open(os.path.join(log, f)).read().split())) for f in os.listdir(log))
    assert sum(n for _, n in calls) > 600
    for i, (first, _) in enumerate(calls):
        for last, total in zip(
            (t for t, _ in calls[i:]), itertools.accumulate(n for _, n in calls[i:]), strict=True
        ):
            assert total <= (last - first) * per_minute / 60 + callers * 5 + 1
    assert sum(n for _, n in calls) <= (calls[-1][0] - start) * per_minute / 60
