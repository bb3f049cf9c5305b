"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docgate.llm.common import count_words, named, one_spaced, stage

MAX_EPOCHS = 3
SEED = 42


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """``sources`` (column source) with weights 1 to ``cycle``, repeating in code point order, null last."""
    marked = sources.select("*", F.col("source").isNull().alias("none"), F.col("source").alias("key"))
    ranked = named(marked, ["none", "key"], [], "rank")
    return ranked.withColumn("weight", F.col("rank") % cycle + 1).drop("rank")


def water_level(sources: DataFrame, budget: int, epochs: int) -> float:
    """The level at which ``least(weight * level, epochs * words)`` adds up to ``budget``.

    Each round takes the sources above their cap out and shares what is left by weight among the
    others; the level only rises, so the clamped set is a filter on the last level and a round is
    one aggregate. There are at most as many rounds as sources; a few are usual.
    """
    cap = F.col("words") * epochs
    level, clamped_before = 0.0, -1
    while True:
        above = cap < F.col("weight") * F.lit(level)
        clamped, spent, weight = sources.agg(
            F.count(F.when(above, True)),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if clamped == clamped_before or not weight:
            return level
        clamped_before = clamped
        level = (budget - spent) / weight


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    budget: int | None = None,
    epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    key: str | None = None,
) -> DataFrame:
    """How many words of each document the mix takes.

    ``weights`` has source and weight (positive integers); without it sources weigh 1, 2, 3,
    repeating. ``budget`` is the size of the mix in words, all words by default. A source's target
    is its share, at most ``epochs`` times its words. Of a target, the whole part goes to every
    document of the source as full repetitions; the fraction is filled in seeded random order, the
    last document in part, so taken words meet the target to less than one word.

    Returns doc_id, source, size, source_size, target, taken (and column ``key`` of ``docs``, where
    given). Null text has size 0; a null source is a source;
    sources without words get target 0. Order ties are broken by size, so repeated rows are
    interchangeable and reruns agree. The order is cut into 4,096 bins by hash, whose sums are
    added up per source first: a source of any size spreads over its bins.
    """
    carried = ["doc_id", "source"] + ([key] if key else [])
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    rows = stage(
        docs.select(*carried, count_words(F.col("text")).alias("size"), draw.alias("draw")),
        "sizes",
    ).withColumn("bin", F.substring("draw", 1, 3))
    bins = stage(rows.groupBy("source", "bin").agg(F.sum("size").alias("words")), "bins")
    totals = bins.groupBy("source").agg(F.sum("words").alias("words"))
    if weights is None:
        totals = cyclic_weights(totals)
    else:
        given = weights.select(F.col("source").alias("_source"), "weight")
        totals = totals.join(given, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    totals = stage(totals, "sources")
    if budget is None:
        budget = totals.agg(F.sum("words")).first()[0] or 0
    level = water_level(totals, budget, epochs)
    target = F.least(F.col("weight") * F.lit(level), (F.col("words") * epochs).cast("double"))
    plan = totals.select(
        F.col("source").alias("_source"),
        F.col("words").alias("source_size"),
        target.alias("target"),
        F.when(F.col("words") > 0, F.floor(target / F.col("words"))).otherwise(0).alias("whole"),
    ).withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    in_source = Window.partitionBy("source").orderBy("bin")
    starts = (
        bins.withColumn("before", F.sum("words").over(in_source) - F.col("words"))
        .join(plan, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "_source", F.col("bin").alias("_bin"), "before", "source_size", "target", "whole", "rest"
        )
    )
    ties = ["size"] + ([key] if key else [])
    in_bin = Window.partitionBy("source", "bin").orderBy("draw", *ties).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = rows.withColumn("upto", F.sum("size").over(in_bin)).join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("_bin"))
    )
    here = F.col("rest") - (F.col("before") + F.col("upto") - F.col("size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), here))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("whole") + part).cast("long").alias("taken"),
        *([key] if key else []),
    )


def draw_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, its columns unchanged.

    Options are those of :func:`mix`. A row taken in part once more appears with that many of its
    first words as text (and their length as n_chars, where there is such a column). Rows without
    words are never taken. Rows that repeat id and text are told apart by number.
    """
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))

    def numbered(rows: DataFrame, by: list[str]) -> DataFrame:
        alike = Window.partitionBy(*by).orderBy(*by)
        return rows.withColumn("_copy", F.row_number().over(alike))

    row = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text")
    given = row.select("row", "text", F.col("doc_id").alias("_id"), key.alias("_key"))
    given = numbered(given, ["_id", "_key"])
    taken = numbered(
        mix(docs.withColumn("_key", key), key="_key", **options).where("taken > 0"), ["doc_id", "_key"]
    ).select(
        F.col("doc_id").alias("_tid"),
        F.col("_key").alias("_tkey"),
        F.col("_copy").alias("_tcopy"),
        "size",
        "taken",
    )
    same = (
        F.col("_id").eqNullSafe(F.col("_tid"))
        & (F.col("_key") == F.col("_tkey"))
        & (F.col("_copy") == F.col("_tcopy"))
    )
    rest = (F.col("taken") % F.col("size")).cast("int")
    whole = F.array_repeat(F.lit(0), F.expr("cast(taken div size as int)"))
    times = F.concat(whole, F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    drawn = given.join(taken, same).select("row", "text", F.explode(times).alias("words"))
    part = F.call_function(
        "substring_index", F.trim(one_spaced(F.col("text"))), F.lit(" "), F.col("words")
    )
    text = F.when(F.col("words") == 0, F.col("text")).otherwise(part)
    drawn = drawn.select("row", F.when(F.col("words") > 0, text).alias("part"))
    fields = {f.name: F.col("row")[f.name] for f in docs.schema}
    fields["text"] = F.coalesce("part", fields["text"])
    if "n_chars" in fields:
        cut = F.length("part").cast(docs.schema["n_chars"].dataType)
        fields["n_chars"] = F.coalesce(cut, fields["n_chars"])
    return drawn.select(*[value.alias(name) for name, value in fields.items()])
