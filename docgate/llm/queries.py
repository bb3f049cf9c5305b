"""One query per operator over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.llm import (
    chat,
    extract,
    language,
    mixing,
    naming,
    negatives,
    packing,
    periods,
    pieces,
    quality,
    repeats,
    sharding,
    simhash,
)
from docgate.llm.common import WORD

SHARDS = 8


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer file, in the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and class of near copies."""
    return simhash.near_copies(_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id", "n_links"
    )


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 35-word windows that also start elsewhere."""
    return repeats.drop_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 1, 2, 3 at most three times over."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts."""
    return naming.exact_copies(_table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, with digests read back from the output."""
    probe = spark.sql(
        "select -1L as conv_id, turn, role, '</s>[INST] ok [/INST]' as text"
        " from values (0L, 'user'), (1L, 'assistant') as t(turn, role)"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.format_paths(chat.chain(rows.unionByName(probe)))
    read = out.select(
        "conv_id",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.learnt_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from three quarters of the labels."""
    docs = _table(spark, sf_dir, "documents")
    held_out = language.in_holdout(F.col("doc_id"))
    model = language.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    out = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op8_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract.main_text(_table(spark, sf_dir, "pages"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards by key, and in nine."""
    out = sharding.assign_shards(
        _table(spark, sf_dir, "documents"),
        sharding.even_tree(SHARDS),
        sharding.even_tree(SHARDS + 1),
    )
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with base counts and the divergence verdict."""
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("char_distance", 9).alias("char_distance"),
        F.round("word_distance", 9).alias("word_distance"),
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded with begin and end ids, and decoded again."""
    model = tokenizer_path("piece_bpe_32k.model")
    ids = pieces.encode_texts(_table(spark, sf_dir, "documents"), model)
    return pieces.decode_ids(ids, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; one text in ten becomes periodic from some word on, by its id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    some = docs.select(
        "doc_id",
        "text",
        g.alias("g"),
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"),
    )
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = (F.floor((n - a) / (F.lit(3) + F.col("g") % 8)) + 1).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    root = F.slice("words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(root, times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return some.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and digests of them and of the text without repetitions."""
    found = periods.periodic_runs(with_planted_periods(_table(spark, sf_dir, "documents")))
    runs = F.col("runs")
    # The greatest length / period, compared by products; ties by start, then period.
    first = F.aggregate(
        runs,
        runs[0],
        lambda best, r: F.when(
            r["length"] * best["period"] > best["length"] * r["period"], r
        ).otherwise(best),
    )
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.when(F.size("runs") > 0, first).alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine_negatives(vectors, F.col("vec_id") % 50 == 0)


def _common_words() -> str:
    """Rows (reference, k, word) of the listed words, as SQL."""
    listed = sorted({w for some in quality.COMMON_WORDS.values() for w in some})
    lists = {**quality.COMMON_WORDS, quality.POOLED: listed}
    rows = [f"('{name}', {k}, '{w}')" for name, some in lists.items() for k, w in enumerate(some)]
    return ", ".join(rows)


def _distances(references: str) -> str:
    """Both distances of every document to ``references``, as SQL."""
    part = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((p + q) / 2)) ELSE 0 END / 2"
    terms = f"{part.format('p')} + {part.format('q')}"
    return f"""SELECT r, any_value(base_failed) AS base_failed, any_value(n_words) AS n_words,
    any_value(reference) AS reference,
    coalesce(sqrt(greatest(0, sum({terms}) FILTER (kind = 'char'))), 0) AS char_distance,
    coalesce(sqrt(greatest(0, sum({terms}) FILTER (kind = 'word'))), 0) AS word_distance
  FROM shares LEFT JOIN {references} USING (reference, kind, k) GROUP BY r"""


def _class_counts() -> str:
    """One row (k, n) per character class, as SQL over ``text``."""
    kept = [others.replace("'", "''") for others in quality.CLASSES.values()]
    return ", ".join(f"length(regexp_replace(text, '{others}', '', 'g'))" for others in kept)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_repeats": op2_repeats,
    "op3_mixing": op3_mixing,
    "op4_exact": op4_exact,
    "op5_chat": op5_chat,
    "op6_language": op6_language,
    "op7_packing": op7_packing,
    "op8_extract": op8_extract,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_periods": op12_periods,
    "op13_negatives": op13_negatives,
}

ORACLES = {
    "op2_repeats": r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
), often AS (
  SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT r, i + k AS p FROM windows JOIN often USING (h), range(35) AS t(k)
), words AS (
  SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT words.r, count(covered.p) AS n_removed,
    string_agg(word, ' ' ORDER BY words.p) FILTER (covered.p IS NULL) AS text
  FROM words LEFT JOIN covered ON words.r = covered.r AND words.p = covered.p GROUP BY words.r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
""",
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(concat_ws(':', '42', doc_id::VARCHAR)) AS draw
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS words,
    (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), clamped AS (
  SELECT *, sum(3 * words) OVER o - 3 * words AS spent, sum(weight) OVER () - sum(weight) OVER o + weight AS open
  FROM totals WINDOW o AS (ORDER BY 3.0 * words / weight, source)
), level AS (
  SELECT ((SELECT sum(words) FROM totals) - spent)::DOUBLE / open AS level FROM clamped
  WHERE ((SELECT sum(words) FROM totals) - spent)::DOUBLE / open * weight <= 3 * words
  ORDER BY 3.0 * words / weight, source LIMIT 1
), plan AS (
  SELECT source, words, least(weight * level, (3 * words)::DOUBLE) AS target FROM totals, level
), parts AS (
  SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END::BIGINT AS whole FROM plan
)
SELECT d.doc_id, d.source, d.size, p.words AS source_size, p.target,
  (d.size * p.whole + greatest(0, least(d.size, round(p.target - p.whole * p.words)::BIGINT
    - (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.size ROWS UNBOUNDED PRECEDING)
       - d.size))))::BIGINT AS taken
FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
""",
    "op4_exact": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
""",
    "op5_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(text, '(<|\[)(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) AS n FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' THEN 7 + n ELSE 16 + length(role) + n END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op10_quality": rf"""
WITH listed(reference, k, word) AS (VALUES {_common_words()}), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    CASE WHEN lang IN ('de', 'en', 'es', 'fr') THEN lang ELSE 'other' END AS reference
  FROM documents
), words AS (
  SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d
), grams AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
    FROM words WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE c IS NOT NULL
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM grams, range(3) AS t(k) WHERE n > 1 GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), base AS (
  SELECT d.r, doc_id, reference, len(ws) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    len(ws) < 50 OR 100 * coalesce(repeats.n, 0) > 50 * len(ws) AS base_failed
  FROM d LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)
), found AS (
  SELECT r, word, count(*) AS n FROM words GROUP BY r, word
), common AS (
  SELECT d.r, k, coalesce(n, 0) AS n FROM d JOIN listed USING (reference)
  LEFT JOIN found ON found.r = d.r AND found.word = listed.word
), counts AS (
  SELECT r, 'char' AS kind, unnest(range({len(quality.CLASSES)})) AS k, unnest([{_class_counts()}]) AS n FROM d
  UNION ALL SELECT r, 'word', k, n FROM common
  UNION ALL SELECT d.r, 'word', -1, any_value(len(ws)) - coalesce(sum(n), 0) FROM d LEFT JOIN common USING (r) GROUP BY d.r
), shares AS (
  SELECT counts.r, reference, kind, k, n, base_failed, n_words,
    n / nullif(sum(n) OVER (PARTITION BY counts.r, kind), 0)::DOUBLE AS p
  FROM counts JOIN base USING (r)
), first AS (
  SELECT reference, kind, k, n / sum(n) OVER (PARTITION BY reference, kind)::DOUBLE AS q FROM (
    SELECT reference, kind, k, sum(n) AS n FROM shares WHERE NOT base_failed GROUP BY ALL)
), near AS (
  SELECT r FROM ({_distances("first")})
  WHERE NOT base_failed AND char_distance <= {quality.MAX_CHAR_DISTANCE}
    AND (word_distance <= {quality.MAX_WORD_DISTANCE} OR n_words < {quality.GUARD_WORDS}
      OR reference = '{quality.POOLED}')
), second AS (
  SELECT reference, kind, k, n / sum(n) OVER (PARTITION BY reference, kind)::DOUBLE AS q FROM (
    SELECT reference, kind, k, sum(n) AS n FROM shares JOIN near USING (r) GROUP BY ALL)
), judged AS ({_distances("second")})
SELECT doc_id, base.n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base.base_failed,
  NOT base.base_failed AND char_distance <= {quality.MAX_CHAR_DISTANCE}
    AND (word_distance <= {quality.MAX_WORD_DISTANCE} OR base.n_words < {quality.GUARD_WORDS}
      OR base.reference = '{quality.POOLED}') AS kept,
  round(char_distance, 9) AS char_distance, round(word_distance, 9) AS word_distance
FROM base JOIN judged USING (r)
""",
    "op13_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_dot_product(a.parts, b.parts)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
""",
}
