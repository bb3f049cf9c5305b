"""The staging table: every input line with its verdict or its error, written once per run.

The model is paid per call, so its answers are written down before anything else uses them. Bronze,
gold, audit and dead letters all read staging. A restarted run scores only lines that staging lacks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docgate.operators.admission import caller_budget
from docgate.operators.contract import parse_contract
from docgate.operators.cost import unknown_models
from docgate.operators.replies import classify
from docgate.operators.requests import with_requests
from docgate.operators.scoring import Client, score, small_batches
from docgate.schemas import (
    CHUNK_ROWS,
    DEFAULT_MODEL,
    DEFAULT_PROMPT,
    MAX_REPLY_TOKENS,
    PROMPTS,
    TEMPERATURE,
)
from docgate.session import child_names, path_exists
from docgate.sinks.audit import input_fingerprint
from docgate.sinks.dead_letter import raw_line_json, record_json, write_dead_letters
from docgate.sinks.tables import align, run_dir
from docgate.sources.ndjson import parse_lines, row_key, well_formed

STAGING_SCHEMA = (
    "row_key STRING, source_bucket STRING, source_key STRING, source_block BIGINT, "
    "source_seq BIGINT, record_id STRING, submitted_at TIMESTAMP, input_record_hash STRING, "
    "compliance_score DOUBLE, risk_tier STRING, policy_alignment STRING, reasoning STRING, "
    "input_tokens INT, output_tokens INT, tokens_used INT, model_id STRING, "
    "classified_at TIMESTAMP, billed BOOLEAN, error_code STRING, error_message STRING, "
    "failed_record STRING, source_line BIGINT, attempt INT, pipeline_run_id STRING"
)
#: Stage under which a line with this error code is dead-lettered; all other codes are
#: ``classification``.
FAILURE_STAGES = {"malformed": "ingestion", "contract": "normalization"}
#: Error codes that may be gone on the next attempt; a restart scores these lines again.
RETRIED = ["invoke"]
OVERSIZE = "oversize"
NO_LIMIT = 10**15


@dataclass(frozen=True)
class Scoring:
    """How records are scored: client factory, model, prompt, prices, limits.

    ``requests_per_minute`` and ``tokens_per_minute`` limit the whole job: a request above the token
    limit is refused without a call, and each task keeps to its share, for ``callers`` tasks that call
    at the same time (as many as the session runs by default); ``paced=False`` leaves the waiting to
    clients that do it themselves. ``prompt_version`` names a prompt of
    ``prompts`` and wins over ``system_prompt``. ``waves`` cuts a run into that many staging
    writes: a job that dies keeps, and never pays again for, the waves it has finished. ``strict``
    stops the job at the first line that fails instead of dead-lettering it.
    """

    make_client: Callable[[], Client]
    model_id: str = DEFAULT_MODEL
    system_prompt: str = PROMPTS[DEFAULT_PROMPT]
    prompt_version: str | None = None
    prompts: object = field(default_factory=lambda: dict(PROMPTS))
    requests_per_minute: int | None = None
    tokens_per_minute: int | None = None
    paced: bool = True
    prices: object = None
    chunk_rows: int = CHUNK_ROWS
    callers: int | None = None
    waves: int = 1
    max_tokens: int = MAX_REPLY_TOKENS
    temperature: float = TEMPERATURE
    strict: bool = False

    def __post_init__(self):
        if self.prompt_version is not None:
            if self.prompt_version not in self.prompts:
                raise KeyError(f"no prompt version {self.prompt_version}")
            object.__setattr__(self, "system_prompt", self.prompts[self.prompt_version].strip())

    @property
    def prompt_hash(self) -> str:
        """SHA-256 of the prompt, as in the prompt table."""
        return hashlib.sha256(self.system_prompt.strip().encode()).hexdigest()

    def pace(self, spark: SparkSession) -> tuple[float, float] | None:
        """Requests and tokens per minute of one task; None without limits."""
        if not self.paced or (self.requests_per_minute is None and self.tokens_per_minute is None):
            return None
        callers = self.callers or spark.sparkContext.defaultParallelism
        rpm, tpm = self.requests_per_minute or NO_LIMIT, self.tokens_per_minute or NO_LIMIT
        return caller_budget(rpm, tpm, callers)


def check_price(spark: SparkSession, scoring: Scoring) -> None:
    """Refuse to start when the model has no price: the calls would be paid, then not accounted."""
    model = spark.range(1).select(F.lit(scoring.model_id).alias("model_id"))
    if not unknown_models(model, scoring.prices).isEmpty():
        raise KeyError(f"No pricing configured for model {scoring.model_id}")


def judge(parsed: DataFrame, scoring: Scoring) -> DataFrame:
    """Contract, scoring and reply checks for parsed lines with their ``row_key``."""
    checked = parse_contract(parsed.withColumn("_malformed", F.col("malformed")))
    checked = checked.withColumn("_valid", (F.size("violations") == 0) & ~F.col("_malformed"))
    requests = with_requests(
        checked, scoring.system_prompt, scoring.max_tokens, scoring.temperature
    ).withColumn("request_body", F.when(F.col("_valid"), F.col("request_body")))
    oversize = F.lit(False)
    if scoring.tokens_per_minute is not None:
        oversize = F.coalesce(F.col("estimated_tokens") > scoring.tokens_per_minute, F.lit(False))
    requests = requests.withColumn("_oversize", F.col("_valid") & oversize).withColumn(
        "request_body", F.when(~F.col("_oversize"), F.col("request_body"))
    )
    pace = scoring.pace(parsed.sparkSession)
    judged = classify(
        score(requests, scoring.make_client, scoring.chunk_rows, pace=pace), scoring.model_id
    )
    code = (
        F.when(F.col("_malformed"), F.lit("malformed"))
        .when(~F.col("_valid"), F.lit("contract"))
        .when(F.col("_oversize"), F.lit(OVERSIZE))
        .otherwise(F.col("error_code"))
    )
    staged = judged.withColumn("error_code", code).withColumns(
        {
            "billed": F.col("billed") & F.col("_valid") & ~F.col("_oversize"),
            "source_line": F.col("line_ordinal") if "line_ordinal" in parsed.columns else F.lit(None),
            "input_record_hash": F.when(F.col("_valid"), input_fingerprint()),
            "error_message": F.when(
                F.col("error_code") == "malformed",
                F.concat(F.lit("not a JSON object: line in "), F.coalesce("source_key", F.lit("stream"))),
            )
            .when(
                F.col("error_code") == "contract",
                F.concat(
                    F.lit("contract broken by record "),
                    F.col("record_ref"),
                    F.lit(": "),
                    F.array_join("violations", ", "),
                ),
            )
            .when(
                F.col("error_code").isNotNull(),
                F.concat(
                    F.lit("no verdict on record "),
                    F.col("record_id"),
                    F.lit(": "),
                    F.coalesce("score_error", "error_code"),
                ),
            ),
            "failed_record": F.when(F.col("error_code") == "malformed", raw_line_json(F.col("value")))
            .when(F.col("error_code") == "contract", F.col("value"))
            .when(F.col("error_code").isNotNull(), record_json()),
        }
    )
    if scoring.strict:
        staged = staged.withColumn(
            "error_code",
            F.when(
                F.col("error_message").isNotNull(), F.raise_error(F.col("error_message"))
            ).otherwise(F.col("error_code")),
        )
    return staged


def billed_metrics(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows`` watched for what they cost: requests and tokens, known once they are written."""
    seen = Observation()
    paid = F.coalesce(F.col("billed"), F.lit(False))
    sums = [
        F.coalesce(F.sum(F.when(paid, F.col(name))), F.lit(0)).cast("bigint").alias(name)
        for name in ("input_tokens", "output_tokens")
    ]
    return rows.observe(seen, F.count_if(paid).alias("requests"), *sums), seen


def stage(
    lines: DataFrame, path: str, run_id: str, scoring: Scoring, spent: list[dict] | None = None
) -> DataFrame:
    """Score the lines that ``path`` lacks for the run, append them, and read the run back.

    Lines whose call failed (``RETRIED``) count as lacking: running again asks for them again, and
    their newest attempt replaces the earlier ones. ``lines`` may be parsed already; if not, those
    that are left are parsed here. Lines of :func:`store_lines` bring their ``row_key`` and ``wave``,
    and each wave reads its own folder only. ``spent`` takes one entry per write: the requests and
    tokens it paid for, counted while it was written; only for lines that are known not to be empty,
    since a plan found empty might report nothing and be waited for.
    """
    spark = lines.sparkSession
    check_price(spark, scoring)
    pending = lines if "row_key" in lines.columns else lines.withColumn("row_key", row_key())
    if "wave" not in pending.columns:
        wave = F.pmod(F.xxhash64("row_key"), F.lit(scoring.waves)).cast("int")
        pending = pending.withColumn("wave", wave)
    attempt = len(child_names(spark, run_dir(path, run_id)))
    if attempt:
        # Equal lines share a key; one of each is enough to know them by.
        before = staged_run(spark, path, run_id)
        done = before.groupBy("row_key").agg(F.max(F.col("error_code").isin(RETRIED)).alias("again"))
        done = done.where(~F.coalesce("again", F.lit(False))).select("row_key")
        pending = pending.join(done, "row_key", "left_anti")
    for wave in range(scoring.waves):
        # The share is taken before the parsing, so a line is parsed in its own wave only.
        share = pending.where(F.col("wave") == wave).drop("wave")
        if "malformed" not in share.columns:
            share = parse_lines(share)
            share = well_formed(share, strict=True) if scoring.strict else share
        judged = judge(share, scoring).withColumn("pipeline_run_id", F.lit(run_id))
        rows = align(judged.withColumn("attempt", F.lit(attempt + wave)), STAGING_SCHEMA)
        seen = None
        if spent is not None:
            rows, seen = billed_metrics(rows)
        with small_batches(spark):
            rows.drop("pipeline_run_id", "attempt").write.mode("overwrite").parquet(
                f"{run_dir(path, run_id)}/attempt={attempt + wave}"
            )
        if seen is not None:
            spent.append(seen.get)
    return staged_run(spark, path, run_id)


def staged_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The staged rows of one run: of each line, those of its newest attempt."""
    folder = run_dir(path, run_id)
    if not path_exists(spark, folder):
        return spark.createDataFrame([], STAGING_SCHEMA)
    rows = spark.read.schema(STAGING_SCHEMA).option("basePath", folder).parquet(folder)
    if len(child_names(spark, folder)) > 1:
        # Only lines whose call failed can have a newer attempt.
        failed = rows.where(F.col("error_code").isin(RETRIED)).select("row_key").distinct()
        newest = (
            rows.join(failed, "row_key", "left_semi")
            .groupBy("row_key")
            .agg(F.max("attempt").alias("_newest"))
        )
        rows = rows.join(newest, "row_key", "left")
        rows = rows.where(F.coalesce(F.col("attempt") == F.col("_newest"), F.lit(True))).drop("_newest")
    return rows.withColumn("pipeline_run_id", F.lit(run_id))


def results(staged: DataFrame) -> DataFrame:
    """Classified rows."""
    return staged.where(F.col("error_code").isNull())


def failures(staged: DataFrame) -> DataFrame:
    """Rows that failed, with the ``failure_stage`` they belong to."""
    code = F.col("error_code")
    stage_name = F.lit("classification")
    for failing, name in FAILURE_STAGES.items():
        stage_name = F.when(code == failing, F.lit(name)).otherwise(stage_name)
    return staged.where(code.isNotNull()).withColumn("failure_stage", stage_name)


def dead_letter_failures(staged: DataFrame, root: str, run_id: str) -> dict[str, str]:
    """Make the dead letters of a run its failed rows, one folder per stage that has any.

    Letters of an earlier attempt at the same run are replaced, so running again adds none.
    """
    failed = failures(staged)
    counts = {r["failure_stage"]: r["count"] for r in failed.groupBy("failure_stage").count().collect()}
    return {
        name: write_dead_letters(
            failed.where(F.col("failure_stage") == name),
            root,
            F.col("failed_record"),
            stage=name,
            run_id=run_id,
            error=F.col("error_message"),
            rows=counts.get(name, 0),
        )
        for name in [*FAILURE_STAGES.values(), "classification"]
    }
