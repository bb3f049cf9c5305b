"""One query per operator, each over whole tables."""

from __future__ import annotations

import time
from datetime import UTC, date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import views as v
from checks.clients import failing_client, rule_scorer
from docgate.errors import GateRejected
from docgate.operators import admission, contract, cost, gate, replies, requests, scoring
from docgate.operators.normalize import normalize
from docgate.plans.batch import run_batch
from docgate.plans.staging import STAGING_SCHEMA, Scoring, failures, results, stage
from docgate.schemas import DEFAULT_MODEL, PROMPTS, RESULT_SCHEMA
from docgate.session import copy_file, matches, scratch_path
from docgate.functions.text import clip, squeeze
from docgate.sinks import audit, dead_letter, tables
from docgate.sinks.ndjson import write_ndjson
from docgate.sources import ndjson
from docgate.sources.payloads import decode_payloads
from docgate.sources.prompts import prompt_table
from docgate.sources.synthetic import synth_records
from docgate.sinks.tables import align
from docgate.streaming.job import screen_batch, start_stream, without_copies
from docgate.streaming.shards import append_shards, read_shards
from docgate.streaming.source import read_line_stream
from docgate.streaming.totals import billed_stream, running_cost, start_totals

PROMPT = PROMPTS["compliance_v1"]
RUN = "run-1"
DAYS = [datetime(2024, 1, day, tzinfo=UTC) for day in (1, 2, 3)]
RPM, TPM = 60, 40_000
CALLERS = 4
AS_OF = datetime(2024, 6, 1, tzinfo=UTC)
CUSTOM_PRICES = {"model-a": (Decimal("0.01"), Decimal("0.05"))}
PRICES = {
    "model-a": (Decimal("0.003"), Decimal("0.015")),
    "model-b": (Decimal("0.0008"), Decimal("0.004")),
}
ALL_PRICES = {**PRICES, "model-c": (Decimal("0.00025"), Decimal("0.00125"))}


# -- inputs ------------------------------------------------------------------


def _folder(spark: SparkSession, records: DataFrame) -> str:
    """Raw records as NDJSON below ``federal-documents/YYYY/MM/DD``, spread over three days."""
    root = scratch_path(v.utc(spark), "ndjson")
    for number, day in enumerate(DAYS):
        share = records.where(F.col("doc_id") % len(DAYS) == number)
        write_ndjson(share.drop("doc_id", "source_key"), f"{root}/federal-documents", day)
    return root


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.typed(v.rec(spark, sf_dir))


def _parsed(spark: SparkSession, lines: DataFrame) -> DataFrame:
    return ndjson.parse_lines(lines)


def _seen(parsed: DataFrame) -> DataFrame:
    text = F.try_variant_get("raw.document_text", "$", "string")
    return parsed.select(
        F.try_variant_get("raw.record_id", "$", "string").alias("record_id"),
        F.md5(text).alias("text_md5"),
    )


def _stamp(column: str = "submitted_at"):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized records that keep the contract."""
    checked = contract.check_contract(normalize(_plain(spark, sf_dir)))
    return contract.split_contract(checked)[0]


def _result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified rows of ``env`` with a record id, as a sink gets them."""
    classified = replies.classify(
        v.env(spark, sf_dir).withColumns(
            {
                "score_error": F.lit(None).cast("string"),
                "classified_at": F.lit("2024-02-01 00:00:00").cast("timestamp"),
            }
        ),
        DEFAULT_MODEL,
    )
    identity = F.concat(
        F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("doc_id").cast("string"), 12, "0")
    )
    return classified.withColumn("record_id", identity).drop("response")


def _table_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "record_id",
        "pipeline_run_id",
        F.col("compliance_score").cast("decimal(4,3)").alias("score"),
        "risk_tier",
        "policy_alignment",
        "reasoning",
        _or_minus("input_tokens"),
        _or_minus("output_tokens"),
        "tokens_used",
    )


def _or_minus(column: str):
    """A count, -1 for none: whole numbers stay whole in every client."""
    return F.coalesce(F.col(column), F.lit(-1)).alias(column)


def _doubles(query):
    """Exact decimals as doubles, which every client compares alike."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = query(spark, sf_dir)
        return rows.select(
            *[
                F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
                for name, kind in rows.dtypes
            ]
        )

    return run


# -- sources -----------------------------------------------------------------


def ndjson_scan(spark, sf_dir):
    root = _folder(spark, _plain(spark, sf_dir))
    return _seen(_parsed(spark, ndjson.read_ndjson(spark, root, "federal-documents/")))


def ndjson_scan_day(spark, sf_dir):
    root = _folder(spark, _plain(spark, sf_dir))
    scans = [
        _seen(_parsed(spark, ndjson.read_ndjson_day(spark, root, "federal-documents/", day))).withColumn(
            "day", F.lit(day.isoformat())
        )
        for day in [*(stamp.date() for stamp in DAYS), date(2024, 1, 4)]
    ]
    scan = scans[0]
    for other in scans[1:]:
        scan = scan.unionByName(other)
    return scan


def ndjson_prefix(spark, sf_dir):
    """Keys that start with a text that ends inside a folder name, odd file names included."""
    root = scratch_path(v.utc(spark), "ndjson")
    records = _plain(spark, sf_dir)
    for share, day in enumerate(("01", "02", "11", "hidden1", "hidden2")):
        rows = records.where(F.col("doc_id") % 5 == share).drop("doc_id", "source_key")
        folder = f"{root}/docs/2024/01/{day}" if share < 3 else f"{root}-{day}"
        rows.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    for share, name in ((3, "03/_b"), (4, "04/.c")):
        for number, (path, _) in enumerate(matches(spark, f"{root}-hidden{share - 2}/part-*")):
            copy_file(spark, path, f"{root}/docs/2024/01/{name}{number}.ndjson")
    return _seen(_parsed(spark, ndjson.read_ndjson(spark, root, "docs/2024/01/0")))


def _bucketed_files(spark, sf_dir):
    """One file of records and empty lines for every 200 documents, in the order of their ids."""
    lines = v.json_lines(v.rec(spark, sf_dir)).withColumns(
        {
            "bucket": F.floor(F.col("doc_id") / v.FILE_ROWS),
            # An empty line after every fifth record: it has no ordinal.
            "value": F.when(F.col("doc_id") % 5 == 0, F.concat("value", F.lit("\n"))).otherwise(
                F.col("value")
            ),
        }
    )
    root = scratch_path(spark, "ndjson")
    (
        lines.repartition("bucket")
        .sortWithinPartitions("bucket", "doc_id")
        .select("bucket", "value")
        .write.partitionBy("bucket")
        .text(f"{root}/files")
    )
    return root


def _numbered(numbered, root):
    return numbered.select(
        F.regexp_extract("value", r'"record_id":"([^"]*)"', 1).alias("record_id"),
        F.regexp_extract("source_key", r"^files/bucket=(\d+)/", 1).cast("bigint").alias("bucket"),
        (F.col("source_bucket") == root.rsplit("/", 1)[-1]).alias("bucket_ok"),
        "line_ordinal",
    )


def ndjson_provenance(spark, sf_dir):
    root = _bucketed_files(spark, sf_dir)
    return _numbered(ndjson.with_line_ordinal(ndjson.read_ndjson(spark, root, "files")), root)


def ndjson_resplit(spark, sf_dir):
    """Lines numbered while files were cut into many splits, and read when they no longer are."""
    root = _bucketed_files(spark, sf_dir)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "50000")
    try:
        numbered = ndjson.with_line_ordinal(ndjson.read_ndjson(spark, root, "files"))
    finally:
        spark.conf.set(setting, before)
    return _numbered(numbered, root)


def malformed_lines(spark, sf_dir):
    root = scratch_path(v.utc(spark), "ndjson")
    v.soiled(v.rec(spark, sf_dir)).select("value").write.text(root)
    parsed = _parsed(spark, ndjson.read_ndjson(spark, root))
    identity = F.regexp_extract("value", r"(00000000-0000-4000-8000-\d{12})", 1)
    return parsed.select(identity.alias("record_id"), "malformed")


def payload_decode(spark, sf_dir):
    lines = v.soiled(v.rec(spark, sf_dir))
    encoded = F.base64(F.col("value").cast("binary"))
    data = F.when(F.col("doc_id") % 19 == 0, F.concat(F.lit("%"), encoded)).otherwise(encoded)
    decoded = decode_payloads(lines.select(F.col("doc_id").alias("sequence"), data.alias("data")))
    return decoded.select(
        "sequence",
        "malformed",
        F.when(
            ~F.col("malformed"), F.md5(F.try_variant_get("raw.document_text", "$", "string"))
        ).alias("text_md5"),
    )


def _drain(stream: DataFrame, root: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_ingest(spark, sf_dir):
    root = _folder(spark, _plain(spark, sf_dir))
    _drain(read_line_stream(spark, f"{root}/federal-documents", max_files_per_batch=4), root)
    return _seen(_parsed(spark, spark.read.parquet(f"{root}/out")))


def stream_resume(spark, sf_dir):
    """Each day's files arrive after the query has stopped; the next start reads only the new ones."""
    root = scratch_path(v.utc(spark), "stream")
    records = _plain(spark, sf_dir)
    for number, day in enumerate(DAYS):
        share = records.where(F.col("doc_id") % len(DAYS) == number)
        write_ndjson(share.drop("doc_id", "source_key"), f"{root}/in", day)
        _drain(read_line_stream(spark, f"{root}/in"), root)
    seen = _seen(_parsed(spark, spark.read.parquet(f"{root}/out")))
    return seen.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("times"), F.max("text_md5").alias("text_md5")
    )


def _payloads(spark, sf_dir) -> DataFrame:
    """Records as payloads of a log: the source is the shard, the document id the sequence."""
    records = _plain(spark, sf_dir)
    fields = [name for name in records.columns if name not in ("doc_id", "source_key")]
    return records.select(
        F.col("source_key").alias("shard"),
        F.col("doc_id").alias("sequence"),
        F.to_json(F.struct(*fields), dead_letter.RECORD_JSON).cast("binary").alias("data"),
    )


def _read_log(spark, root: str) -> DataFrame:
    decoded = decode_payloads(spark.read.parquet(f"{root}/out"))
    return decoded.select(
        "shard",
        "sequence",
        F.try_variant_get("raw.record_id", "$", "string").alias("record_id"),
        F.md5(F.try_variant_get("raw.document_text", "$", "string")).alias("text_md5"),
    )


def shard_ingest(spark, sf_dir):
    """Every shard of a log from its first record; a shard with many is split at its files."""
    root = scratch_path(v.utc(spark), "shards")
    append_shards(_payloads(spark, sf_dir).repartition(8), f"{root}/log")
    _drain(read_shards(spark, f"{root}/log", task_rows=500), root)
    return _read_log(spark, root)


def shard_resume(spark, sf_dir):
    """The log grows after the query has stopped, twice; each start goes on after the last sequences."""
    root = scratch_path(v.utc(spark), "shards")
    payloads = _payloads(spark, sf_dir)
    # A shard's sequences only grow: each part holds the ids after those of the part before.
    top = payloads.agg(F.max("sequence")).head()[0] or 0
    for part in range(3):
        low, high = part * (top + 1) // 3, (part + 1) * (top + 1) // 3
        append_shards(
            payloads.where((F.col("sequence") >= low) & (F.col("sequence") < high)), f"{root}/log"
        )
        _drain(read_shards(spark, f"{root}/log"), root)
    return (
        _read_log(spark, root)
        .groupBy("shard")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.countDistinct("record_id").alias("distinct_records"),
            F.max("sequence").alias("position"),
        )
    )


def stream_unique(spark, sf_dir):
    """Every record comes twice, a third of them again after a restart; each is let through once."""
    root = scratch_path(v.utc(spark), "copies")
    records = _plain(spark, sf_dir)
    fields = [name for name in records.columns if name not in ("doc_id", "source_key")]
    sent = records.select("doc_id", F.to_json(F.struct(*fields), dead_letter.RECORD_JSON).alias("value"))
    for again in (sent.union(sent), sent.where(F.col("doc_id") % 3 == 0)):
        again.select("value").write.mode("append").text(f"{root}/in")
        _drain(without_copies(read_line_stream(spark, f"{root}/in"), "10 days"), root)
    return (
        _seen(_parsed(spark, spark.read.parquet(f"{root}/out")))
        .groupBy("record_id")
        .agg(F.count(F.lit(1)).alias("times"), F.max("text_md5").alias("text_md5"))
    )


def stream_totals(spark, sf_dir):
    """Token totals over micro-batches that come in two lots, the second after a restart."""
    root = scratch_path(v.utc(spark), "totals")
    usage = _usage(spark, sf_dir).withColumns(
        {name: F.col(name).cast("int") for name in ("input_tokens", "output_tokens")}
    )
    paid = usage.withColumn("billed", F.lit(True))
    for lot in range(2):
        share = align(paid.where(F.col("doc_id") % 2 == lot), STAGING_SCHEMA)
        share.repartition(3).write.mode("append").parquet(f"{root}/staging")
        query = start_totals(
            billed_stream(spark, f"{root}/staging"), f"{root}/totals", f"{root}/state", every=None
        )
        query.awaitTermination()
    return running_cost(spark, f"{root}/totals", ALL_PRICES)


def cost_observed(spark, sf_dir):
    """A run's cost as counted while it is staged, in three waves, without reading it again."""
    root = scratch_path(v.utc(spark), "observed")
    paid: list[dict] = []
    records = _plain(spark, sf_dir)
    fields = [name for name in records.columns if name not in ("doc_id", "source_key")]
    located = records.select(
        F.to_json(F.struct(*fields), dead_letter.RECORD_JSON).alias("value"),
        F.lit("raw").alias("source_bucket"),
        "source_key",
        F.lit(0).cast("bigint").alias("source_block"),
        F.lit(0).cast("bigint").alias("source_seq"),
    )
    stage(located, f"{root}/staging", RUN, Scoring(rule_scorer(), waves=3), paid)
    return cost.cost_summary(cost.observed_totals(spark, DEFAULT_MODEL, paid)).drop("model_id")


def synth(spark, sf_dir):
    made = synth_records(
        v.documents(spark, sf_dir).select("doc_id"), seed=42, as_of=AS_OF, id_column="doc_id"
    )
    return made.select(
        "doc_id",
        "record_id",
        _stamp(),
        "document_type",
        "agency",
        "applicant_id",
        "case_status",
        "priority_tier",
        "form_number",
        "pages",
        F.array_join("flags", ",").alias("flags"),
        F.size(F.split("document_text", r"\. ")).alias("sentences"),
        F.col("officer_notes").isNotNull().alias("has_notes"),
    )


def prompt_registry(spark, sf_dir):
    prompts = v.documents(spark, sf_dir).select(
        F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("version"),
        F.concat(F.lit(" \n\t"), "text", F.lit("\n ")).alias("text"),
    )
    return prompt_table(prompts).select("version", "sha256", F.length("text").alias("n_chars"))


# -- normalize and contract --------------------------------------------------


def normalize_text(spark, sf_dir):
    docs = v.documents(spark, sf_dir)
    messy = F.concat(
        F.lit("\u3000 "),
        F.replace("text", F.lit("e "), F.lit("e\u2003 \u00a0\t")),
        F.lit("\x1c\n"),
    )
    cleaned = docs.select("doc_id", clip(squeeze(messy)).alias("text"))
    return cleaned.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"))


def normalize_record(spark, sf_dir):
    rows = normalize(_plain(spark, sf_dir).withColumn("_source_key", F.lit("dropped")))
    assert "_source_key" not in rows.columns
    return rows.select(
        "record_id",
        "document_type",
        "agency",
        "applicant_id",
        "case_status",
        "priority_tier",
        F.md5("document_text").alias("text_md5"),
        "pages",
    )


def contract_violations(spark, sf_dir):
    checked = contract.parse_contract(_parsed(spark, v.seeded(v.rec(spark, sf_dir))))
    return checked.select(
        "doc_id", "record_ref", F.array_join("violations", ",").alias("violations")
    )


def contract_valid(spark, sf_dir):
    checked = contract.parse_contract(_parsed(spark, v.seeded(v.rec(spark, sf_dir))))
    valid, _ = contract.split_contract(checked)
    return valid.select(
        "record_id",
        _stamp(),
        "document_type",
        "agency",
        "applicant_id",
        "case_status",
        "priority_tier",
        F.md5("document_text").alias("text_md5"),
        "form_number",
        "pages",
        F.array_join("flags", ",").alias("flags"),
        "officer_notes",
    )


def contract_coercions(spark, sf_dir):
    checked = contract.parse_contract(_parsed(spark, v.varied(v.rec(spark, sf_dir))))
    return checked.select(
        "doc_id",
        "record_id",
        F.date_format("submitted_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("submitted_at"),
        "pages",
    )


# -- gate --------------------------------------------------------------------


def gate_counts(spark, sf_dir):
    return gate.gate_details(v.rec(spark, sf_dir), gate.document_expectations())


def gate_verdict(spark, sf_dir):
    return gate.gate_verdict(gate_counts(spark, sf_dir))


def gate_raw_verdict(spark, sf_dir):
    """The gate over raw JSON lines with seeded type defects."""
    view = gate.gate_view(_parsed(spark, v.seeded(v.rec(spark, sf_dir))))
    return gate.gate_details(view, gate.document_expectations())


def gate_details(spark, sf_dir):
    batch = v.rec(spark, sf_dir)
    rules = gate.document_expectations()
    counts = gate.gate_details(batch, rules).where("failed").drop("total", "failed")
    samples = gate.gate_samples(batch, rules)
    return samples.join(counts, ["expectation", "column_name"])


def gate_custom_sets(spark, sf_dir):
    rules = gate.document_expectations(
        document_types=[], agencies=["USCIS", "NASA", "uscis"], priority_tiers=["standard"]
    )
    return gate.gate_details(v.rec(spark, sf_dir), rules)


def gate_large_set(spark, sf_dir):
    batch = v.rec(spark, sf_dir)
    allowed = v.documents(spark, sf_dir).where(F.col("lang") == "en").select("source").distinct()
    return gate.unexpected_outside(batch, "source_key", allowed)


def gate_frame_set(spark, sf_dir):
    """A set given as a frame beside listed rules: counts from one aggregate, and its first samples."""
    batch = v.rec(spark, sf_dir)
    allowed = v.documents(spark, sf_dir).where(F.col("doc_id") % 4 < 3).select("doc_id")
    rules = [
        gate.not_null("record_id"),
        gate.in_frame("doc_id", allowed),
        gate.in_set("agency", ["USCIS", "CBP"]),
    ]
    marked, rules = gate.with_marks(batch, rules)
    counts = gate.gate_details(marked, rules)
    return counts.join(gate.gate_samples(marked, rules), ["expectation", "column_name"], "left").select(
        "total", "column_name", "unexpected_count", "failed", "sample_rank", "value"
    )


def _routed(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    verdict = gate.gate_verdict(gate.gate_details(batch, gate.document_expectations()))
    return gate.route(batch, verdict)


def gate_route_pass(spark, sf_dir):
    passed, rejected = _routed(v.clean(v.rec(spark, sf_dir)))
    return (
        passed.select("record_id", F.lit("passed").alias("branch"))
        .unionByName(rejected.select("record_id", F.lit("rejected").alias("branch")))
    )


def gate_route_reject(spark, sf_dir):
    passed, rejected = _routed(v.rec(spark, sf_dir))
    return (
        passed.select("record_id", F.lit("passed").alias("branch"))
        .unionByName(rejected.select("record_id", F.lit("rejected").alias("branch")))
    )


def gate_empty(spark, sf_dir):
    batch = v.rec(spark, sf_dir).where(F.length("document_text") < 0)
    return gate.gate_verdict(gate.gate_details(batch, gate.document_expectations()))


def gate_missing_column(spark, sf_dir):
    return gate.gate_details(
        v.rec(spark, sf_dir).drop("agency", "pages"), gate.document_expectations()
    )


# -- requests, scoring, replies ----------------------------------------------


def prompt_message(spark, sf_dir):
    rows = _canonical(spark, sf_dir).withColumn("message", requests.user_message())
    return rows.select("record_id", F.md5("message").alias("message_md5"))


def request_body(spark, sf_dir):
    rows = requests.with_requests(_canonical(spark, sf_dir), PROMPT)
    return rows.select("record_id", F.md5("request_body").alias("body_md5"))


def token_estimate(spark, sf_dir):
    rows = requests.with_requests(_canonical(spark, sf_dir), PROMPT)
    return rows.select("record_id", "estimated_tokens")


def _scored(spark, sf_dir, chunk_rows=25):
    asked = requests.with_requests(_canonical(spark, sf_dir), PROMPT)
    return replies.classify(scoring.score(asked, rule_scorer(), chunk_rows), DEFAULT_MODEL)


def score_deterministic(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "record_id",
        F.col("compliance_score").cast("decimal(4,3)").alias("score"),
        "risk_tier",
        "policy_alignment",
        "reasoning",
        "input_tokens",
        "output_tokens",
        F.col("classified_at").isNotNull().alias("stamped"),
    )


def score_chunked(spark, sf_dir):
    rows = _scored(spark, sf_dir, chunk_rows=7)
    return rows.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("records"), F.sum("tokens_used").alias("tokens_used")
    )


def score_isolated(spark, sf_dir):
    """A client that raises on some records: only those fail, not the chunks they are in."""
    asked = requests.with_requests(_canonical(spark, sf_dir), PROMPT)
    scored = scoring.score(asked, failing_client(13))
    return replies.classify(scored, DEFAULT_MODEL).select("record_id", "error_code", "risk_tier")


def _staged(spark, sf_dir, *attempts: Scoring) -> DataFrame:
    root = _folder(spark, _plain(spark, sf_dir))
    parsed = _parsed(spark, ndjson.read_ndjson(spark, root, "federal-documents/"))
    path = scratch_path(spark, "staging")
    for attempt in attempts:
        staged = stage(parsed, path, RUN, attempt)
    return staged


def score_retry(spark, sf_dir):
    """The model is down, then partly up, then up, under one run id: every record has one verdict."""
    staged = _staged(
        spark, sf_dir, Scoring(failing_client(1)), Scoring(failing_client(13)), Scoring(rule_scorer())
    )
    return staged.where("error_code is distinct from 'contract'").select(
        "record_id", "error_code", "risk_tier", "attempt"
    )


def scoring_limits(spark, sf_dir):
    """Requests above the token limit are refused without a call."""
    staged = _staged(spark, sf_dir, Scoring(rule_scorer(), tokens_per_minute=1_500, paced=False))
    return staged.where("error_code is distinct from 'contract'").select(
        "record_id", "error_code", "risk_tier", "billed"
    )


def scoring_paced(spark, sf_dir):
    """Calls from many short tasks, and the moments at which they are above the limit: none."""
    per_minute, callers, chunk = 600_000, spark.sparkContext.defaultParallelism, 5
    asked = requests.with_requests(_canonical(spark, sf_dir), PROMPT).repartition(60)
    budget = admission.caller_budget(per_minute, 10**15, callers)
    start = time.time()
    path = scratch_path(spark, "calls")
    scoring.score(asked, rule_scorer(), chunk, pace=budget).select("classified_at").write.parquet(path)
    log = spark.read.parquet(path)
    # Calls by hundredths of a second; their running sum is as short as the run is.
    moment = F.floor(F.unix_micros("classified_at") / 10_000)
    moments = log.groupBy(moment.alias("moment")).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.orderBy("moment"))
    allowed = ((F.col("moment") + 1) / 100 - start) * per_minute / 60
    return moments.select("n", (so_far > allowed).alias("above")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("calls"),
        F.count_if("above").cast("int").alias("moments_above"),
    )


def score_table(spark, sf_dir):
    answers = (
        v.env(spark, sf_dir)
        .join(v.rec(spark, sf_dir).select("doc_id", "record_id"), "doc_id")
        .withColumn("classified_at", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    )
    rows = replies.classify(
        scoring.score_from_table(_canonical(spark, sf_dir), answers), DEFAULT_MODEL
    )
    return rows.select("record_id", "error_code", "risk_tier")


def envelope_parse(spark, sf_dir):
    rows = replies.parse_envelopes(v.env(spark, sf_dir))
    return rows.select(
        "doc_id",
        F.md5("reply").alias("reply_md5"),
        _or_minus("input_tokens"),
        _or_minus("output_tokens"),
        "envelope_error",
    )


def reply_parse(spark, sf_dir):
    rows = replies.parse_replies(v.resp(spark, sf_dir), "response_text")
    return rows.select(
        "doc_id",
        F.col("compliance_score").cast("decimal(4,3)").alias("score"),
        "risk_tier",
        "policy_alignment",
        "reasoning",
        "reply_error",
    )


def reply_errors(spark, sf_dir):
    rows = replies.parse_replies(v.resp(spark, sf_dir), "response_text")
    return rows.groupBy(F.coalesce("reply_error", F.lit("ok")).alias("error")).agg(
        F.count(F.lit(1)).alias("replies")
    )


def reply_codes(spark, sf_dir):
    """Every error code, and the odd forms that are no errors."""
    cases = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(e).alias("e")) for r, e in v.ODD_REPLIES])
    case = F.get(cases, (F.col("doc_id") % len(v.ODD_REPLIES)).cast("int"))
    rows = v.documents(spark, sf_dir).select(
        "doc_id",
        case["r"].alias("response"),
        case["e"].alias("score_error"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("classified_at"),
    )
    return replies.classify(rows, DEFAULT_MODEL).select(
        "doc_id", "error_code", "billed", "reasoning", _or_minus("tokens_used")
    )


def classify_results(spark, sf_dir):
    return _result_rows(spark, sf_dir).select(
        "doc_id",
        "error_code",
        "billed",
        F.col("compliance_score").cast("decimal(4,3)").alias("score"),
        "risk_tier",
        _or_minus("tokens_used"),
        "model_id",
    )


# -- cost --------------------------------------------------------------------


def _usage(spark, sf_dir):
    model = F.concat(
        F.lit("model-"), F.element_at(F.split(F.lit("a,b,c"), ","), (F.col("doc_id") % 3 + 1).cast("int"))
    )
    return v.resp(spark, sf_dir).select(
        "doc_id", model.alias("model_id"), "input_tokens", "output_tokens"
    )


def cost_totals(spark, sf_dir):
    return cost.cost_totals(_usage(spark, sf_dir))


def cost_summary(spark, sf_dir):
    return cost.cost_summary(cost.cost_totals(_usage(spark, sf_dir)), ALL_PRICES)


def cost_unknown_model(spark, sf_dir):
    return cost.unknown_models(_usage(spark, sf_dir), PRICES)


def cost_per_row(spark, sf_dir):
    return cost.with_row_cost(_usage(spark, sf_dir), PRICES)


def cost_custom_prices(spark, sf_dir):
    usage = _usage(spark, sf_dir).withColumn("model_id", F.lit("model-a"))
    return cost.run_cost(usage, "model-a", CUSTOM_PRICES)


def cost_price_frame(spark, sf_dir):
    rows = [(model, *price) for model, price in PRICES.items()]
    kinds = "model_id string, input_usd_per_1k decimal(12,6), output_usd_per_1k decimal(12,6)"
    return cost.with_row_cost(_usage(spark, sf_dir), spark.createDataFrame(rows, kinds)).select(
        "doc_id", "model_id", "input_tokens", "output_tokens",
        "cost_input_usd", "cost_output_usd", "cost_usd",
    )


def source_keys(spark, sf_dir):
    return cost.source_counts(
        v.rec(spark, sf_dir).withColumn(
            "source_key", F.when(F.col("doc_id") % 11 > 0, F.col("source_key"))
        )
    )


# -- admission ---------------------------------------------------------------


def _demand(spark, sf_dir):
    """One request per document; each source is a run, numbered by document."""
    return v.documents(spark, sf_dir).select(
        F.col("source").alias("run"),
        F.col("doc_id").alias("seq"),
        F.greatest(F.floor(F.col("n_chars") / 4), F.lit(1)).cast("bigint").alias("tokens"),
    )


def admission_infeasible(spark, sf_dir):
    demand = _demand(spark, sf_dir).withColumn(
        "tokens", F.when(F.col("seq") % 13 == 0, -F.col("tokens")).otherwise(F.col("tokens"))
    )
    return admission.infeasible(demand, 1_000)


def budget_split(spark, sf_dir):
    demand = _demand(spark, sf_dir).withColumn("caller", F.col("seq") % CALLERS)
    used = admission.budget_usage(demand, "caller", "tokens", RPM, TPM, CALLERS)
    return used.withColumn("minutes", F.round("minutes", 6))


# -- sinks -------------------------------------------------------------------


def bronze_merge(spark, sf_dir):
    root = scratch_path(v.utc(spark), "tables")
    tables.write_bronze(results(_result_rows(spark, sf_dir)), root, RUN, ["doc_id"])
    return _table_rows(tables.read_table(spark, f"{root}/bronze"))


def gold_merge(spark, sf_dir):
    """Two runs, of which only the first passed its gate."""
    root = scratch_path(v.utc(spark), "tables")
    good = results(_result_rows(spark, sf_dir))
    tables.write_gold(good, root, RUN, ["doc_id"], gate_passed=True)
    tables.write_gold(good, root, "run-2", ["doc_id"], gate_passed=False)
    return _table_rows(tables.read_table(spark, f"{root}/gold"))


def merge_retry(spark, sf_dir):
    """A run that stopped after some rows and was written again, changed, as a whole."""
    root = scratch_path(v.utc(spark), "tables")
    good = results(_result_rows(spark, sf_dir))
    tables.write_bronze(good.where(F.col("risk_tier") != "high"), root, RUN, ["doc_id"])
    again = good.withColumn("reasoning", F.concat(F.lit("again "), "reasoning"))
    for _ in range(2):
        tables.write_bronze(again, root, RUN, ["doc_id"])
    return _table_rows(tables.read_table(spark, f"{root}/bronze"))


def merge_dedupe(spark, sf_dir):
    """A third of all rows share one record id; the first of them wins."""
    root = scratch_path(v.utc(spark), "tables")
    good = results(_result_rows(spark, sf_dir))
    hot = F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.col("record_id"))
    tables.write_bronze(good.withColumn("record_id", hot), root, RUN, ["doc_id"])
    return _table_rows(tables.read_table(spark, f"{root}/bronze"))


def schema_migration(spark, sf_dir):
    """Rows of the first table version next to rows of the current one."""
    path = scratch_path(v.utc(spark), "tables")
    good = results(_result_rows(spark, sf_dir))
    old_columns = [
        name.split()[0]
        for name in RESULT_SCHEMA.split(", ")
        if name.split()[0] not in ("pipeline_run_id", "input_tokens", "output_tokens")
    ]
    good.where(F.col("risk_tier") == "low").select(*old_columns).write.parquet(f"{path}/old")
    old = tables.align(spark.read.parquet(f"{path}/old"), RESULT_SCHEMA)
    old.drop("pipeline_run_id").write.parquet(
        f"{path}/bronze/pipeline_run_id=__HIVE_DEFAULT_PARTITION__"
    )
    tables.write_bronze(good.where(F.col("risk_tier") != "low"), path, RUN, ["doc_id"])
    return _table_rows(tables.read_table(spark, f"{path}/bronze"))


def _audited(spark, sf_dir, source_key: str = "source_key") -> DataFrame:
    good = results(_result_rows(spark, sf_dir))
    inputs = _canonical(spark, sf_dir)
    keys = inputs.select("record_id", F.expr(source_key).alias("source_key"))
    return audit.audit_rows(
        audit.attach_inputs(good.join(keys, "record_id"), inputs, ["doc_id"]),
        run_id=RUN,
        gate_passed=True,
        prompt_hash="p1",
        source_bucket="raw",
    )


_AUDIT_COLUMNS = [
    "record_id",
    "pipeline_run_id",
    "compliance_score",
    "risk_tier",
    "policy_alignment",
    "input_tokens",
    "output_tokens",
    "tokens_used",
    "cost_input_usd",
    "cost_output_usd",
    "cost_usd",
    "quality_gate_passed",
    "source_bucket",
    "source_key",
    "input_record_hash",
    "prompt_hash",
]


def _audit_table(spark, path: str) -> DataFrame:
    rows = tables.read_table(spark, path, audit.AUDIT_SCHEMA)
    return rows.select(*_AUDIT_COLUMNS, _stamp(), _stamp("classified_at"))


def audit_rows(spark, sf_dir):
    path = scratch_path(v.utc(spark), "tables")
    audit.write_audit(_audited(spark, sf_dir), path, RUN, ["doc_id"])
    return _audit_table(spark, path)


def audit_many_sources(spark, sf_dir):
    """Every record from a source of its own: each audit row names it, however many there are."""
    path = scratch_path(v.utc(spark), "tables")
    own = "concat('key-', cast(doc_id as string))"
    audit.write_audit(_audited(spark, sf_dir, own), path, RUN, ["doc_id"])
    return _audit_table(spark, path)


def audit_two_runs(spark, sf_dir):
    """Two runs written by turns: ids need no order between them and are unique over both."""
    path = scratch_path(v.utc(spark), "tables")
    _audited(spark, sf_dir).write.parquet(f"{path}-staged")
    rows = spark.read.parquet(f"{path}-staged")
    for run, part in ((RUN, F.col("risk_tier") == "low"), ("run-2", F.lit(True)), (RUN, F.lit(True))):
        audit.write_audit(rows.where(part), path, run, ["doc_id"])
    written = tables.read_table(spark, path, audit.AUDIT_SCHEMA)
    return written.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("audit_id").alias("ids"),
        F.countDistinct("pipeline_run_id").alias("runs"),
    )


def audit_retry(spark, sf_dir):
    """A write that stopped after some tiers, then twice all rows; ids stay unique."""
    path = scratch_path(v.utc(spark), "tables")
    _audited(spark, sf_dir).write.parquet(f"{path}-staged")
    rows = spark.read.parquet(f"{path}-staged")
    audit.write_audit(rows.where(F.col("risk_tier") != "low"), path, RUN, ["doc_id"])
    for _ in range(2):
        audit.write_audit(rows, path, RUN, ["doc_id"])
    written = tables.read_table(spark, path, audit.AUDIT_SCHEMA)
    return written.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("audit_id").alias("ids"),
        F.countDistinct("record_id").alias("records"),
        F.sum("cost_usd").cast("decimal(18,6)").alias("cost_usd"),
    )


def audit_missing_timestamp(spark, sf_dir):
    good = results(_result_rows(spark, sf_dir))
    return audit.results_without_input(good, _canonical(spark, sf_dir)).select("record_id")


def input_fingerprint(spark, sf_dir):
    rows = _canonical(spark, sf_dir)
    return rows.select("record_id", audit.input_fingerprint().alias("input_record_hash"))


def input_fingerprint_python(spark, sf_dir):
    rows = _canonical(spark, sf_dir)
    return rows.select("record_id", audit.python_fingerprint(rows).alias("input_record_hash"))


def _letters(spark, sf_dir) -> tuple[str, str]:
    root = scratch_path(v.utc(spark), "letters")
    checked = contract.parse_contract(_parsed(spark, v.seeded(v.rec(spark, sf_dir))))
    _, invalid = contract.split_contract(checked)
    path = dead_letter.write_dead_letters(
        invalid,
        root,
        F.col("value"),
        stage="normalization",
        run_id=RUN,
        error=F.array_join("violations", ","),
        now=datetime(2024, 2, 1, tzinfo=UTC),
    )
    return root, path


def dead_letter_write(spark, sf_dir):
    root, path = _letters(spark, sf_dir)
    letters = dead_letter.read_dead_letters(spark, root, "normalization")
    return letters.select(
        F.md5(F.get_json_object("record", "$.document_text")).alias("text_md5"),
        "failure_stage",
        "pipeline_run_id",
        "error_message",
        "failed_at",
        F.lit(path[len(root) :]).alias("folder"),
    )


def dead_letter_replay(spark, sf_dir):
    root, _ = _letters(spark, sf_dir)
    again = dead_letter.replay(dead_letter.read_dead_letters(spark, root))
    return again.groupBy(F.array_join("violations", ",").alias("violations")).agg(
        F.count(F.lit(1)).alias("records")
    )


def dead_letter_rerun(spark, sf_dir):
    """Both jobs run twice over the same records: each failed record has one letter, with its source."""
    root = _folder(spark, _plain(spark, sf_dir))
    scans = ndjson.read_ndjson(spark, root, "federal-documents/")
    letters = []
    for job in ("batch", "stream"):
        out = scratch_path(spark, job)
        for _ in range(2):
            if job == "batch":
                run_batch(
                    spark, root, "federal-documents/", out, Scoring(rule_scorer()),
                    run_id=RUN, stop_on_reject=False,
                )
            else:
                lines = scans.select("value", F.col("source_key").alias("source_path"), "source_block")
                screen_batch(out, Scoring(rule_scorer()), stream_name="documents")(lines, 7)
        found = dead_letter.read_dead_letters(spark, out)
        letters.append(found.withColumn("job", F.lit(job)))
    field = lambda name: F.get_json_object("record", f"$.{name}")
    return letters[0].unionByName(letters[1]).select(
        "job",
        field("record_id").alias("record_id"),
        "failure_stage",
        field("_source_key").startswith("federal-documents/").alias("key_ok"),
        (field("_source_line_number").cast("long") >= 1).alias("line_ok"),
    )


def classified_split(spark, sf_dir):
    failed = failures(_result_rows(spark, sf_dir))
    return failed.groupBy("failure_stage", "error_code").agg(F.count(F.lit(1)).alias("records"))


# -- jobs --------------------------------------------------------------------


def flagship(spark, sf_dir):
    """Screen, score from stored replies, cost, and report by agency and risk tier."""
    checked = contract.check_contract(normalize(_plain(spark, sf_dir)))
    valid, _ = contract.split_contract(checked)
    scored = v.resp(spark, sf_dir).withColumn("reply", F.col("response_text"))
    parsed = replies.parse_replies(scored).where(F.col("reply_error").isNull())
    verdicts = parsed.select(
        "doc_id",
        "compliance_score",
        "risk_tier",
        "input_tokens",
        "output_tokens",
        F.lit(DEFAULT_MODEL).alias("model_id"),
    )
    joined = valid.select("doc_id", "agency").join(verdicts, "doc_id")
    return (
        cost.with_row_cost(joined)
        .groupBy("agency", "risk_tier")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(F.col("compliance_score").cast("decimal(4,3)"))
            .cast("decimal(18,3)")
            .alias("score_sum"),
            F.sum("cost_usd").cast("decimal(18,6)").alias("cost_usd"),
        )
    )


def _screened(spark, sf_dir, records: DataFrame, **options) -> tuple[str, object]:
    root = _folder(spark, records)
    out = scratch_path(spark, "batch")
    report = run_batch(
        spark,
        root,
        "federal-documents/",
        out,
        Scoring(rule_scorer()),
        run_id=RUN,
        **options,
    )
    return out, report


def batch_run(spark, sf_dir):
    """The whole job on a batch without defects: gold against audit, by tier."""
    out, _ = _screened(spark, sf_dir, v.typed(v.clean(v.rec(spark, sf_dir))))
    gold = tables.read_table(spark, f"{out}/gold")
    audited = tables.read_table(spark, f"{out}/audit", audit.AUDIT_SCHEMA)
    return (
        gold.join(audited.select("record_id", "cost_usd", "quality_gate_passed"), "record_id")
        .groupBy("risk_tier", "quality_gate_passed")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(F.col("compliance_score").cast("decimal(4,3)"))
            .cast("decimal(18,3)")
            .alias("score_sum"),
            F.sum("tokens_used").alias("tokens_used"),
            F.sum("cost_usd").cast("decimal(18,6)").alias("cost_usd"),
        )
    )


def batch_reject(spark, sf_dir):
    """The same job on the batch with defects: every record is in the dead letter."""
    root = _folder(spark, _plain(spark, sf_dir))
    out = scratch_path(spark, "batch")
    try:
        run_batch(
            spark, root, "federal-documents/", out, Scoring(rule_scorer()), run_id=RUN
        )
    except GateRejected:
        pass
    letters = dead_letter.read_dead_letters(spark, out)
    return letters.select(
        F.get_json_object("record", "$.record_id").alias("record_id"),
        "failure_stage",
        F.regexp_extract("error_message", r"^(.*?) \(", 1).alias("error"),
    )


def _streamed(spark, sf_dir, **options) -> DataFrame:
    root = _folder(spark, _plain(spark, sf_dir))
    out = scratch_path(spark, "stream")
    query = start_stream(
        read_line_stream(spark, f"{root}/federal-documents"),
        out,
        f"{out}/checkpoint",
        Scoring(rule_scorer()),
        stream_name="documents",
        every=None,
        **options,
    )
    query.awaitTermination()
    audited = tables.read_table(spark, f"{out}/audit", audit.AUDIT_SCHEMA).select(
        F.lit("audited").alias("outcome"),
        "risk_tier",
        "quality_gate_passed",
        "cost_usd",
    )
    letters = dead_letter.read_dead_letters(spark, out).select(
        F.col("failure_stage").alias("outcome"),
        F.lit("").alias("risk_tier"),
        F.lit(False).alias("quality_gate_passed"),
        F.lit(Decimal("0.000000")).cast("decimal(12,6)").alias("cost_usd"),
    )
    return (
        audited.unionByName(letters)
        .groupBy("outcome", "risk_tier", "quality_gate_passed")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum("cost_usd").cast("decimal(18,6)").alias("cost_usd"),
        )
    )


def stream_pipeline(spark, sf_dir):
    """The stream job over the batch with defects."""
    return _streamed(spark, sf_dir)


def stream_gated(spark, sf_dir):
    """The stream job with a gate, whose verdict goes into the audit rows and stops nothing."""
    return _streamed(spark, sf_dir, expectations=gate.document_expectations())


_QUERIES = {
    "ndjson_scan": ndjson_scan,
    "ndjson_scan_day": ndjson_scan_day,
    "ndjson_provenance": ndjson_provenance,
    "ndjson_resplit": ndjson_resplit,
    "ndjson_prefix": ndjson_prefix,
    "malformed_lines": malformed_lines,
    "payload_decode": payload_decode,
    "stream_ingest": stream_ingest,
    "stream_resume": stream_resume,
    "shard_ingest": shard_ingest,
    "shard_resume": shard_resume,
    "stream_unique": stream_unique,
    "stream_totals": stream_totals,
    "cost_observed": cost_observed,
    "gate_frame_set": gate_frame_set,
    "input_fingerprint_python": input_fingerprint_python,
    "synth_records": synth,
    "prompt_registry": prompt_registry,
    "normalize_text": normalize_text,
    "normalize_record": normalize_record,
    "contract_violations": contract_violations,
    "contract_valid": contract_valid,
    "contract_coercions": contract_coercions,
    "gate_counts": gate_counts,
    "gate_verdict": gate_verdict,
    "gate_raw_verdict": gate_raw_verdict,
    "gate_details": gate_details,
    "gate_custom_sets": gate_custom_sets,
    "gate_large_set": gate_large_set,
    "gate_route_pass": gate_route_pass,
    "gate_route_reject": gate_route_reject,
    "gate_empty": gate_empty,
    "gate_missing_column": gate_missing_column,
    "prompt_message": prompt_message,
    "request_body": request_body,
    "token_estimate": token_estimate,
    "score_deterministic": score_deterministic,
    "score_chunked": score_chunked,
    "score_isolated": score_isolated,
    "score_retry": score_retry,
    "scoring_limits": scoring_limits,
    "scoring_paced": scoring_paced,
    "score_table": score_table,
    "envelope_parse": envelope_parse,
    "reply_parse": reply_parse,
    "reply_errors": reply_errors,
    "reply_codes": reply_codes,
    "classify_results": classify_results,
    "cost_totals": cost_totals,
    "cost_summary": cost_summary,
    "cost_unknown_model": cost_unknown_model,
    "cost_per_row": cost_per_row,
    "cost_price_frame": cost_price_frame,
    "cost_custom_prices": cost_custom_prices,
    "source_keys": source_keys,
    "admission_infeasible": admission_infeasible,
    "budget_split": budget_split,
    "bronze_merge": bronze_merge,
    "gold_merge": gold_merge,
    "merge_retry": merge_retry,
    "merge_dedupe": merge_dedupe,
    "schema_migration": schema_migration,
    "audit_rows": audit_rows,
    "audit_many_sources": audit_many_sources,
    "audit_two_runs": audit_two_runs,
    "audit_retry": audit_retry,
    "audit_missing_timestamp": audit_missing_timestamp,
    "input_fingerprint": input_fingerprint,
    "dead_letter_write": dead_letter_write,
    "dead_letter_replay": dead_letter_replay,
    "dead_letter_rerun": dead_letter_rerun,
    "classified_split": classified_split,
    "batch_pipeline": flagship,
    "batch_run": batch_run,
    "batch_reject": batch_reject,
    "stream_pipeline": stream_pipeline,
    "stream_gated": stream_gated,
}

QUERIES = {name: _doubles(query) for name, query in _QUERIES.items()}
