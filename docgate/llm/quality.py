"""Quality rules by distribution divergence; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.functions.once import with_once
from docgate.llm.common import SPACE, stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Frequent function words of each language with a reference.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "las", "del", "un", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour"],
}
POOLED = "other"
# Character classes; what is in none of them, space included, is not counted.
CLASSES = {
    "lower": r"[^\p{Ll}]+",
    "upper": r"[^\p{Lu}]+",
    "digit": r"[^\p{N}]+",
    "mark": r"[^.,;:!?'\"()\-]+",
    "symbol": r"[^#*$%&|<>@^_~=+/\\{}\[\]]+",
}
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.25
GUARD_WORDS = 100
_ANY_WORD = r"[^\x20\x09-\x0D]"


def _repeat_words(words: Column, grams: Column) -> Column:
    """Words in 3-word windows that occur twice or more; ``grams`` are the windows' hashes."""
    ordered = F.array_sort(
        F.transform(grams, lambda gram, i: F.struct(gram.alias("gram"), i.alias("at")))
    )

    def repeated(rows: Column) -> Column:
        near = F.transform(
            rows,
            lambda row, i: F.when(
                (F.get(rows, i - 1)["gram"] == row["gram"])
                | (F.get(rows, i + 1)["gram"] == row["gram"]),
                row["at"],
            ),
        )
        return F.array_sort(F.array_compact(near))

    def covered(places: Column) -> Column:
        lengths = F.transform(
            places, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - at, F.lit(3)))
        )
        return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n)

    # Each step is bound to a variable by a one-element array, so it is computed once.
    found = F.transform(F.transform(F.array(ordered), repeated), covered)
    some = F.size(F.array_distinct(grams)) < F.size(grams)
    return F.when(some, F.get(found, F.lit(0))).otherwise(0).cast("long")


def measure(docs: DataFrame, common: dict[str, list[str]] = COMMON_WORDS) -> DataFrame:
    """Counts of each document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, reference (a language of ``common`` or the pooled one), classes and common
    (histograms as arrays of long; the last of common counts all other words).

    Null text counts as empty. Windows are told apart by 64-bit hashes within one document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        text.alias("text"),
        F.when(F.col("lang").isin(*common), F.col("lang")).otherwise(F.lit(POOLED)).alias("reference"),
    )
    rows = with_once(
        rows,
        {
            "words": F.filter(F.split("text", SPACE), lambda w: w != ""),
            "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(_ANY_WORD)),
        },
    )
    words = F.col("words")
    grams = F.transform(
        F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    listed = sorted({w for some in common.values() for w in some})
    rows = with_once(
        rows,
        {"grams": grams, "frequent": F.filter(words, lambda w: w.isin(*listed))},
    )

    def counted(of: list[str]) -> Column:
        def occurrences(word: Column) -> Column:
            return F.size(F.filter("frequent", lambda w: w == word)).cast("long")

        return F.transform(F.array(*map(F.lit, of)), occurrences)

    histogram = counted(listed)
    for language, some in common.items():
        histogram = F.when(F.col("reference") == language, counted(some)).otherwise(histogram)
    classes = [F.length(F.regexp_replace("text", others, "")) for others in CLASSES.values()]
    return with_once(
        rows.select(
            "doc_id",
            "reference",
            F.size("words").cast("long").alias("n_words"),
            F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            _repeat_words(words, F.col("grams")).alias("n_repeat_words"),
            F.array(*classes).cast("array<long>").alias("classes"),
            histogram.alias("common"),
        ),
        {
            "common": F.concat(
                "common",
                F.array(
                    F.col("n_words")
                    - F.aggregate("common", F.lit(0).cast("long"), lambda total, n: total + n)
                ),
            )
        },
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two histograms; 0 when either is empty."""

    def share(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda t, n: t + n)
        return F.transform(counts, lambda n: F.try_divide(n, total))

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(
        share(p), share(q), lambda x, y: part(x, (x + y) / 2) / 2 + part(y, (x + y) / 2) / 2
    )
    divergence = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    return F.coalesce(F.sqrt(F.greatest(F.lit(0.0), divergence)), F.lit(0.0))


def judge(docs: DataFrame, common: dict[str, list[str]] = COMMON_WORDS) -> DataFrame:
    """Every document with its counts, distances and verdict.

    A language's reference is the sum of the histograms of its documents that pass the base rules and
    are near the sum of all such documents; those without a listed language share one pooled
    reference. ``kept`` is false if the
    base rules fail (under 50 words, or over half of the words in repeated 3-word windows); else
    both Jensen-Shannon distances to the reference must be small, and the word distance counts only
    from 100 words on, below which a clean text's own counts scatter as far, and not against the
    pooled reference, which mixes languages.

    Null and empty texts fail the base rules; repeated rows are judged alike; an empty table gives
    no rows; other columns are ignored. References are one row per listed language and one more.
    """
    rows = stage(measure(docs, common), "measures").withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )
    longest = max(len(set().union(*common.values())), *map(len, common.values())) + 1

    def total(column: str, size: int) -> Column:
        sums = [F.sum(F.get(column, F.lit(i))) for i in range(size)]
        return F.array_compact(F.array(*sums)).alias(f"all_{column}")

    def compare(trusted: DataFrame) -> DataFrame:
        references = trusted.groupBy("reference").agg(
            total("classes", len(CLASSES)), total("common", longest)
        )
        found = rows.join(F.broadcast(references), "reference", "left").select(
            *rows.columns,
            js_distance(F.col("classes"), F.col("all_classes")).alias("char_distance"),
            js_distance(F.col("common"), F.col("all_common")).alias("word_distance"),
        )
        odd = (F.col("char_distance") > MAX_CHAR_DISTANCE) | (
            (F.col("word_distance") > MAX_WORD_DISTANCE)
            & (F.col("n_words") >= GUARD_WORDS)
            & (F.col("reference") != POOLED)
        )
        return found.withColumn("kept", ~F.col("base_failed") & ~odd)

    compared = compare(compare(rows.where("not base_failed")).where("kept"))
    return compared.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "reference",
        "char_distance",
        "word_distance",
    )
