"""Repeated passages by compacting the De Bruijn graph of word windows.

An edge of the graph is a window of ``size`` consecutive words, from its first ``size - 1`` words
to its last. Edges are too many to shuffle one by one, so paths are compacted first: consecutive
windows that have the same minimizer (the smallest hash of ``SEED_WORDS`` words in the window) form
one path, cut from its text by content alone. Equal paths are repeated as a whole. Only where different
paths share a minimizer does the graph branch, and only there are paths taken apart into edges,
read again from their source coordinates, and counted one by one. Joins bring the repeated
edges back to every place where their path occurs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import one_spaced, parts, stage
from docgate.session import scratch_path

WINDOW = 35
SEED_WORDS = 6
_AT_ONCE = 1 << 18
KEY = ["k1", "k2"]


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so their powers have inverses


def _codes(words: list[bytes]):
    """A 64-bit number for each word."""
    import numpy as np
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class _Hashes:
    """Polynomial hashes of all word ranges of one text, modulo 2^64."""

    def __init__(self, codes, base: int):
        import numpy as np

        n = len(codes)
        self.inverse = self._powers(pow(base, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * self._powers(base, n)[:n], out=self.sums[1:])

    @staticmethod
    def _powers(base: int, n: int):
        import numpy as np

        out = np.full(n + 1, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def __call__(self, start, end):
        """Hashes of the words from each ``start`` to before each ``end``, well mixed."""
        import numpy as np

        x = (self.sums[end] - self.sums[start]) * self.inverse[start]
        x ^= x >> np.uint64(33)
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x = x * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _paths(words: list[bytes], size: int, seed_words: int):
    """The paths of one text: minimizer hash, hash of all words, first window, number of windows."""
    import numpy as np

    codes = _codes(words)
    n = len(words) - size + 1
    span = size - seed_words + 1
    seeds = np.arange(n + span - 1)
    marks = _Hashes(codes, _BASES[0])(seeds, seeds + seed_words)
    minimal = np.empty(n, dtype=np.int64)
    for at in range(0, n, _AT_ONCE):
        view = np.lib.stride_tricks.sliding_window_view(marks[at : at + _AT_ONCE + span - 1], span)
        minimal[at : at + len(view)] = view.argmin(axis=1) + np.arange(at, at + len(view))
    first = np.flatnonzero(np.diff(minimal, prepend=-1))
    windows = np.diff(np.append(first, n))
    whole = _Hashes(codes, _BASES[1])(first, first + windows + size - 1)
    return marks[minimal[first]].view(np.int64), whole.view(np.int64), first, windows


def _schema(names: list[str]) -> str:
    return ", ".join(f"{name} long" for name in names)


def _frames(columns: Iterable[tuple], names: list[str], at_once: int = 100_000) -> Iterator:
    """Data frames of about ``at_once`` rows from tuples of equally long arrays."""
    import numpy as np
    import pandas as pd

    held, n = [], 0

    def flush():
        return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*held, strict=True)), strict=True)))

    for arrays in columns:
        held.append(arrays)
        n += len(arrays[0])
        if n >= at_once:
            yield flush()
            held, n = [], 0
    if held:
        yield flush()


def _all_paths(texts: DataFrame, size: int, seed_words: int) -> DataFrame:
    """Paths of all texts. ``place`` packs first window, number of windows and the copies bit."""

    names = ["mark", "whole", *KEY, "place"]

    def cut(frames: Iterable) -> Iterator:
        import numpy as np

        for frame in frames:
            for k1, k2, text, copies in frame.itertuples(index=False):
                words = text.split()
                if len(words) < size:
                    continue
                mark, whole, first, windows = _paths(words, size, seed_words)
                place = (first << 16) | (windows << 1) | (copies > 1)
                yield mark, whole, np.full(len(mark), k1), np.full(len(mark), k2), place

    text = F.col("text").cast("binary")
    return texts.select(*KEY, text.alias("text"), "copies").mapInPandas(
        lambda frames: _frames(cut(frames), names), _schema(names)
    )


def _weight(place: str = "place"):
    """A path of a text that has copies counts twice: it is repeated in any case."""
    return F.col(place).bitwiseAND(F.lit(1)) + 1


def _repeated_edges(branching: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Which windows of branching paths are repeated: mark, whole, mask (bit i: the i-th window)."""

    names = ["e1", "e2", "mark", "whole", "step", "times"]

    def take_apart(frames: Iterable) -> Iterator:
        import numpy as np

        for frame in frames:
            for text, found in frame.itertuples(index=False):
                words = text.split()
                rows = np.array([tuple(path.values()) for path in found], dtype=np.int64)
                windows = (rows[:, 3] >> 1) & 0x7FFF
                at = np.repeat(np.arange(len(rows)), windows)
                step = np.arange(len(at)) - np.repeat(np.cumsum(windows) - windows, windows)
                start = (rows[at, 3] >> 16) + step
                codes = _codes(words)
                e1, e2 = (
                    _Hashes(codes, base)(start, start + size).view(np.int64) for base in _BASES
                )
                yield e1, e2, rows[at, 0], rows[at, 1], step, rows[at, 2]

    by_text = branching.groupBy(*KEY).agg(
        F.collect_list(F.struct("mark", "whole", "times", "place")).alias("found")
    )
    edges = stage(
        texts.join(by_text, KEY)
        .select(F.col("text").cast("binary").alias("text"), "found")
        .mapInPandas(lambda frames: _frames(take_apart(frames), names), _schema(names)),
        "edges",
    )
    often = edges.groupBy("e1", "e2").agg(F.sum("times").alias("all")).where("all > 1")
    often = stage(often.select("e1", "e2"), "often")
    bit = F.expr("shiftleft(1L, cast(step as int))")
    return (
        edges.join(often, ["e1", "e2"])
        .groupBy("mark", "whole")
        .agg(F.bit_or(bit).alias("mask"))
    )


def _remove(texts: DataFrame, size: int, keep_text: bool) -> DataFrame:
    """What is left of each text; ``found`` lists its repeated windows as (place, mask)."""

    def remove(frames: Iterable) -> Iterator:
        import hashlib

        import numpy as np
        import pandas as pd

        for frame in frames:
            out = []
            for k1, k2, text, copies, found in frame.itertuples(index=False):
                words = text.split()
                n = len(words)
                edges = np.zeros(n + 1, dtype=np.int64)
                if copies > 1 and n >= size:
                    edges[0] = 1
                elif found is not None:
                    rows = np.array([tuple(path.values()) for path in found], dtype=np.int64)
                    windows = (rows[:, 0] >> 1) & 0x7FFF
                    at = np.repeat(np.arange(len(rows)), windows)
                    step = np.arange(len(at)) - np.repeat(np.cumsum(windows) - windows, windows)
                    hit = (rows[at, 1] >> step) & 1 == 1
                    start = ((rows[at, 0] >> 16) + step)[hit]
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + size, -1)
                gone = np.cumsum(edges[:n]) > 0
                turns = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                spans = [(int(a), int(b - a)) for a, b in zip(turns[::2], turns[1::2], strict=True)]
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                row = [k1, k2, n, int(gone.sum()), hashlib.sha256(kept).hexdigest(), spans]
                out.append([*row, kept.decode()] if keep_text else row)
            yield pd.DataFrame(out, columns=names)

    names = [*KEY, "n_words", "n_removed", "kept_sha256", "spans"] + ["kept_text"] * keep_text
    schema = _schema(names[:4]) + (
        ", kept_sha256 string, spans array<struct<start: int, length: int>>"
        + ", kept_text string" * keep_text
    )
    text = F.col("text").cast("binary")
    return texts.select(*KEY, text.alias("text"), "copies", "found").mapInPandas(remove, schema)


def drop_repeats(
    docs: DataFrame, size: int = WINDOW, seed_words: int = SEED_WORDS, keep_text: bool = False
) -> DataFrame:
    """Every row's words without those in windows of ``size`` words that also start elsewhere.

    Words are runs free of ASCII white space; elsewhere may be in the same text; windows are judged
    on the input. Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by
    blanks) and spans (array of start and length, in words, of what was removed), with
    ``keep_text`` also kept_text. Null text has no words; rows that repeat a text or an id are separate places;
    texts shorter than ``size`` stay whole; other columns are ignored.

    Equal texts are reduced to one, which counts as two places; texts are then stored once, bucketed
    by key, and later joins bring small rows to them without moving them. Words are told apart by 64
    bits of hash, windows by 128, texts by 120 bits of SHA-256. What is aggregated by a key is written
    before it is joined on that key: between two plain exchanges a hot key is split.
    """
    spark = docs.sparkSession
    words = F.trim(one_spaced(F.col("text")))
    digest = F.sha2(words, 256)

    def half(start: int):
        return F.conv(F.substring(F.col("sha"), start, 15), 16, 10).cast("long")

    keyed = docs.select("doc_id", words.alias("text"), digest.alias("sha")).select(
        "doc_id", "text", half(1).alias("k1"), half(16).alias("k2")
    )
    rows = stage(keyed.select("doc_id", *KEY), "keys")
    distinct = keyed.groupBy(*KEY).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    table = f"llm_texts_{uuid.uuid4().hex}"
    writer = distinct.write.bucketBy(parts(docs), *KEY).option("compression", "zstd")
    writer.option("path", scratch_path(spark, "llm-texts")).saveAsTable(table)
    texts = spark.table(table)

    # Only minimizers that occur twice can belong to repeated windows. The paths are cut a second
    # time instead of being stored: there are many, and few are needed.
    times = F.sum(_weight()).alias("times")
    often = _all_paths(texts, size, seed_words).groupBy("mark").agg(times).where("times > 1")
    often = stage(often.select("mark"), "often")
    places = stage(_all_paths(texts, size, seed_words).join(often, "mark"), "paths")
    paths = stage(
        places.groupBy("mark", "whole").agg(times, F.min(F.struct(*KEY, "place")).alias("first")),
        "distinct",
    )
    forks = paths.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    forks = stage(forks, "forks")
    branching = paths.join(forks, "mark").select("mark", "whole", "times", "first.*")
    edges = stage(_repeated_edges(branching, texts, size), "masks")
    repeated = (
        paths.join(edges, ["mark", "whole"], "left")
        .select("mark", "whole", F.when(F.col("times") > 1, -1).otherwise(F.col("mask")).alias("mask"))
        .where("mask is not null")
    )
    repeated = stage(repeated, "repeated")
    found = (
        places.join(repeated, ["mark", "whole"])
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("place", "mask")).alias("found"))
    )
    left = stage(_remove(texts.join(found, KEY, "left"), size, keep_text), "kept")
    spark.sql(f"drop table {table}")
    return rows.join(left, KEY).drop(*KEY)
