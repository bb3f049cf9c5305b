"""Words, staging and collision-free ranks shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docgate.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def one_spaced(text: Column) -> Column:
    """``text`` with every run of ASCII white space as one blank; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def count_words(text: Column) -> Column:
    """Number of runs free of ASCII white space; 0 for null."""
    words = F.trim(one_spaced(text))
    blanks = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return F.when(words == "", 0).otherwise(blanks + 1).cast("long")


def stage(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read again: lineage ends here.

    A lost executor then costs the tasks since the last stage, and nothing is computed twice.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def parts(rows: DataFrame) -> int:
    """Number of shuffle partitions of the session."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def named(
    rows: DataFrame, keys: list[str], ties: list[str], name: str, coarse: list[str] | None = None
) -> DataFrame:
    """Replace ``keys`` by an integer ``name`` (long), equal exactly for equal keys.

    Rows are range-partitioned and sorted by ``keys`` then ``ties``, so copies of one key spread
    over as many tasks as they need. Each task numbers its distinct keys; the keys at its two ends,
    which its neighbours may hold too, go into a summary that gives the offsets and one name for
    each such key. Keys are compared in full, never by hash alone. Nulls count as equal and come
    first. Names are the dense rank of the keys, from 0.

    The partitioner samples its keys to the driver. For long keys, ``coarse`` names short columns
    that depend on the keys alone: partitions are cut by them, and names are then unique but need
    not be dense or in order.
    """
    short = coarse or keys
    order = [*short, *(k for k in keys if k not in short), *ties]
    others = [c for c in rows.columns if c not in {*keys, *short}]
    of = {field.name: field.dataType for field in rows.schema}
    out = T.StructType(
        [T.StructField(c, of[c]) for c in others]
        + [T.StructField("_task", T.IntegerType()), T.StructField("_rank", T.LongType())]
        + [T.StructField(f"_key_{k}", of[k]) for k in keys]
        + [T.StructField("_distinct", T.LongType())]
    )

    def number(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        rank, schema, before = -1, None, {}
        # Distinct keys (rank, values) that share the first and the last row's short columns.
        head, tail, in_head = [], [], True

        def layout(given: pa.Schema) -> pa.Schema:
            own = {"_task": pa.int32(), "_rank": pa.int64(), "_distinct": pa.int64()}
            own |= {f"_key_{k}": given.field(k).type for k in keys}
            return pa.schema([(f.name, own.get(f.name) or given.field(f.name).type) for f in out])

        def changes(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
            found = np.zeros(batch.num_rows, dtype=bool)
            for c in names:
                column = batch.column(c)
                a, b = column.slice(1), column.slice(0, batch.num_rows - 1)
                unequal = pc.fill_null(pc.not_equal(a, b), False)
                found[1:] |= np.asarray(pc.or_(unequal, pc.xor(pc.is_null(a), pc.is_null(b))))
                found[0] |= not before or column[0].as_py() != before[c]
            return found

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            schema = schema or layout(batch.schema)
            parted = changes(batch, short)
            new = parted | changes(batch, keys)
            first_batch = rank < 0
            ranks = rank + np.cumsum(new)
            rank = int(ranks[-1])
            before = {c: batch.column(c)[n - 1].as_py() for c in {*short, *keys}}
            cuts = np.flatnonzero(parted)
            if first_batch:
                cuts = cuts[1:]
            begun = np.flatnonzero(new)

            def values(places: np.ndarray, batch=batch, ranks=ranks) -> list:
                return [
                    (int(ranks[i]), [batch.column(k)[i].as_py() for k in keys])
                    for i in places.tolist()
                ]

            if in_head:
                head += values(begun[begun < cuts[0]] if len(cuts) else begun)
            if len(cuts):
                in_head, tail = False, values(begun[begun >= cuts[-1]])
            elif not in_head:
                tail += values(begun)
            data = {c: batch.column(c) for c in others}
            data |= {"_task": pa.array([task] * n, pa.int32()), "_rank": pa.array(ranks, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [data[f.name] if f.name in data else pa.nulls(n, f.type) for f in schema],
                schema=schema,
            )
        for at, key in head + tail:
            data = {"_task": task, "_rank": at, "_distinct": rank + 1}
            data |= {f"_key_{k}": v for k, v in zip(keys, key, strict=True)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([data.get(f.name)], f.type) for f in schema], schema=schema
            )

    columns = list(dict.fromkeys([*others, *short, *keys]))
    ranged = rows.select(*columns).repartitionByRange(parts(rows), *short, *ties)
    done = stage(ranged.sortWithinPartitions(*order).mapInArrow(number, out), "names")
    held = [f"_key_{k}" for k in keys]
    ends = done.where("_distinct is not null").select("_task", "_rank", "_distinct", *held)
    by_task = Window.orderBy("_task", "_rank")  # a few rows for each task
    shared = (F.col("_rank") == 0) & F.lag("_task").over(by_task).isNotNull()
    for k in held:
        shared &= F.col(k).eqNullSafe(F.lag(k).over(by_task))
    grown = F.when(F.col("_rank") == 0, F.col("_distinct") - shared.cast("long")).otherwise(0)
    ends = ends.select("*", grown.alias("_grown"))
    ends = ends.select(
        "*", (F.sum("_grown").over(by_task) - F.col("_distinct")).alias("_start")
    ).select("*", F.min(F.col("_start") + F.col("_rank")).over(Window.partitionBy(*held)).alias("_name"))
    starts = ends.groupBy(F.col("_task").alias("_of")).agg(F.max("_start").alias("_start"))
    fixed = ends.select(
        F.col("_task").alias("_at"), F.col("_rank").alias("_as"), "_name"
    ).distinct()
    named_rows = (
        done.where("_distinct is null")
        .join(F.broadcast(starts), F.col("_task") == F.col("_of"))
        .join(
            F.broadcast(fixed),
            (F.col("_task") == F.col("_at")) & (F.col("_rank") == F.col("_as")),
            "left",
        )
    )
    value = F.coalesce(F.col("_name"), F.col("_start") + F.col("_rank"))
    return named_rows.select(*others, value.alias(name))
