"""Scoring: one model call per record, through a client the caller supplies.

A client is a callable ``list[str] -> list[str | Exception]``: request bodies in, one response
envelope or error per body out, in the same order. ``make_client`` builds it once per task, so
connections are reused across the rows of a partition.
"""

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.schemas import CHUNK_ROWS

SCORE_SCHEMA = "response STRING, score_error STRING, classified_at TIMESTAMP"
Client = Callable[[list], list]
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: So much text goes to a Python worker at once, however many rows it is.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """While a scored table is written: at most ``most`` bytes of requests at once in a Python worker.

    Spark's own bound is 10,000 rows, which long texts make large in each of an executor's workers.
    """
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


class Pace:
    """Waits until a task's share of the limits allows its next call.

    A task begins with nothing: it waits before a call, not after it. So ``n`` tasks that call at the same
    time keep to ``n`` shares however often tasks end and others begin, with no state outside the task. What
    a task saves while it does other work counts, up to what its next call needs.
    """

    def __init__(self, requests_per_minute: float, tokens_per_minute: float):
        self.rates = (requests_per_minute / 60, tokens_per_minute / 60)
        self.room = [0.0, 0.0]
        self.seen = time.monotonic()

    def wait(self, requests: int, tokens: int) -> None:
        now = time.monotonic()
        passed, self.seen = now - self.seen, now
        needs = (requests, tokens)
        refilled = [r + passed * rate for r, rate in zip(self.room, self.rates, strict=True)]
        # Going into debt and sleeping it off admits calls larger than a minute's share.
        self.room = [min(r, n) - n for r, n in zip(refilled, needs, strict=True)]
        debt = max(-r / rate for r, rate in zip(self.room, self.rates, strict=True))
        if debt > 0:
            time.sleep(debt)


def _ask(client: Client, bodies: list[str], tokens: list[int], limiter: Pace | None) -> list:
    """One answer or error per body; a chunk that fails as a whole is asked one by one.

    Every call, a repeated one too, waits for its own requests and tokens first.
    """
    if limiter:
        limiter.wait(len(bodies), sum(tokens))
    try:
        answers = client(bodies)
        if len(answers) == len(bodies):
            return list(answers)
        failure: Exception = ValueError(f"{len(answers)} answers to {len(bodies)} requests")
    except Exception as raised:
        failure = raised
    if len(bodies) == 1:
        return [failure]
    each = zip(bodies, tokens, strict=True)
    return [answer for body, n in each for answer in _ask(client, [body], [n], limiter)]


def score(
    requests: DataFrame,
    make_client: Callable[[], Client],
    chunk_rows: int = CHUNK_ROWS,
    body: str = "request_body",
    pace: tuple[float, float] | None = None,
) -> DataFrame:
    """Add ``response``, ``score_error`` and ``classified_at`` to every row.

    Rows whose ``body`` is NULL are passed over without a call. A failed call becomes the row's
    ``score_error``, and only that row's; it never fails the task. ``pace`` is the share of requests
    and tokens per minute of one task (see :class:`Pace`), with the row's ``estimated_tokens``. Only these columns travel
    to Python, and nothing is shuffled. Persist the result (see ``docgate.plans.batch``) before
    using it twice, or the calls are made twice.
    """
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")

    def call(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        client = make_client()
        limiter = Pace(*pace) if pace else None
        for bodies, tokens in batches:
            # Only one chunk of the batch's requests is unpacked at a time.
            wanted = [i for i in range(len(bodies)) if bodies[i].is_valid]
            response = [None] * len(bodies)
            error = [None] * len(bodies)
            when = [None] * len(bodies)
            for start in range(0, len(wanted), chunk_rows):
                rows = wanted[start : start + chunk_rows]
                asked = [bodies[i].as_py() for i in rows]
                answers = _ask(client, asked, [tokens[i].as_py() for i in rows], limiter)
                stamp = datetime.now(UTC)
                for i, answer in zip(rows, answers, strict=True):
                    if isinstance(answer, Exception):
                        error[i] = f"{type(answer).__name__}: {answer}"
                    else:
                        response[i], when[i] = answer, stamp
            yield pa.StructArray.from_arrays(
                [
                    pa.array(response, pa.string()),
                    pa.array(error, pa.string()),
                    pa.array(when, pa.timestamp("us", tz="UTC")),
                ],
                names=["response", "score_error", "classified_at"],
            )

    scored = F.arrow_udf(call, SCORE_SCHEMA).asNondeterministic()
    known = "estimated_tokens" in requests.columns
    tokens = F.coalesce(F.col("estimated_tokens"), F.lit(0)) if known else F.lit(0)
    return requests.withColumn("_score", scored(F.col(body), tokens.cast("long"))).select(
        *[F.col(name) for name in requests.columns], "_score.*"
    )


def score_from_table(requests: DataFrame, responses: DataFrame, key: str = "record_id") -> DataFrame:
    """Score from stored responses (``key``, ``response``, ``classified_at``), one per key."""
    joined = requests.join(responses.select(key, "response", "classified_at"), key, "left")
    return joined.withColumn(
        "score_error", F.when(F.col("response").isNull(), F.lit("no stored response"))
    )
