"""Periodic runs of words by string synchronising sets, and texts without their repetitions."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docgate.llm.common import WORD

MIN_LENGTH = 6
MIN_EXPONENT = 4
AT_ONCE = 1_000_000  # words; a longer text is taken alone
# Periods up to this are read off directly; scale t = 4, 8, 16, ... supplies 3t-1 to 6t-2.
SMALL = 10


def _mixed(a, b):
    """A 64-bit hash of each pair of hashes."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _stretches(words, period: int, low: int, high: int) -> list[tuple[int, int]]:
    """Maximal stretches [start, end) of words[low:high] with ``period``, three periods or longer."""
    import numpy as np

    some = words[low:high]
    equal = np.zeros(max(len(some) - period, 0) + 2, dtype=np.int8)
    equal[1:-1] = some[period:] == some[: len(some) - period]
    edges = np.flatnonzero(np.diff(equal))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= 2 * period
    return [
        (low + a, low + b + period)
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)
    ]


def _extended(words, at: int, period: int) -> tuple[int, int]:
    """The maximal stretch with ``period`` around words[at] == words[at + period]."""
    import numpy as np

    def matches(step: int, place: int) -> int:
        """Equal places from ``place`` on, in the direction of ``step``; looks ever further."""
        found, size = 0, 64
        while True:
            if step > 0:
                a = words[place + period : place + period + size]
                b = words[place : place + len(a)]
            else:
                low = max(place + 1 - size, 0)
                a, b = words[low : place + 1][::-1], words[low + period : place + 1 + period][::-1]
            unequal = np.flatnonzero(a != b)
            if len(unequal):
                return found + int(unequal[0])
            found += len(a)
            if len(a) < size:
                return found
            place += step * size
            size *= 2

    return at - matches(-1, at - 1), at + period + matches(1, at)


def cubic_runs(words, sizes) -> list[tuple[int, int, int]]:
    """All maximal (start, end, smallest period) of three periods or more.

    ``words`` are the numbered words of several texts, the longest first, each ended by a number that
    occurs nowhere else; ``sizes`` are their lengths, these ends included.

    Periods up to ``SMALL`` are found by comparing the words with themselves, shifted. For larger ones,
    scale t keeps those places whose window of t words, or the one t further, has the least hash of all
    windows that begin in between, windows with a period of t/3 or less left out: their runs are
    known from smaller scales. Whether a place is kept depends on the 2t words from it on alone, and
    of each 2t places in a row that are not all left out, one of the first t is kept. A run of period
    p from 3t-1 on and of length 3p has a place among its first p that is not left out, so the
    place kept near it and its copy p further lie in the run with their 2t words. Equal contexts of
    kept places at distances from 3t-1 to 6t-2 hence propose every period; words decide.
    """
    import numpy as np

    runs: dict[tuple[int, int], int] = {}
    for period in range(1, SMALL + 1):
        for span in _stretches(words, period, 0, len(words)):
            runs.setdefault(span, period)
    known = words.astype(np.uint64)  # hashes of the windows of `scale` words
    known = _mixed(known, known)
    known = _mixed(known[:-1], known[1:])
    known = _mixed(known[:-2], known[2:])
    scale, top = 4, np.uint64(2**64 - 1)
    ends = np.cumsum(sizes)
    while True:
        # A text must hold three periods of 3t-1 words; longer texts come first.
        longer = int(np.searchsorted(-np.asarray(sizes), -(3 * (3 * scale - 1) + 1), "right"))
        if not longer:
            break
        n = int(ends[longer - 1])
        hashes = known[: n - scale + 1]
        marks = np.zeros(len(hashes) + 1, dtype=np.int64)
        for (a, b), period in runs.items():
            if 3 * period <= scale <= b - a and b <= n:
                marks[a] += 1
                marks[b - scale + 1] -= 1
        hashes = np.where(np.cumsum(marks[:-1]) > 0, top, hashes)
        least, width = hashes, 1
        while width < scale:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        m = len(hashes) - scale  # places with a window t further
        if m <= 0:
            break
        least = np.minimum(least[:m], hashes[scale:])
        kept = np.flatnonzero(
            (least != top) & ((least == hashes[:m]) | (least == hashes[scale:]))
        )
        contexts = _mixed(known[: n - 2 * scale + 1], known[scale : n - scale + 1])
        keys = contexts[kept]
        order = np.lexsort((kept, keys))
        kept, keys = kept[order], keys[order]
        found = []
        head = np.arange(len(kept) - 1) if len(kept) else np.zeros(0, dtype=np.int64)
        step = 1
        while len(head):
            head = head[head + step < len(kept)]
            gap = kept[head + step] - kept[head]
            near = (keys[head + step] == keys[head]) & (gap < 6 * scale - 1)
            head, gap = head[near], gap[near]
            wide = gap >= 3 * scale - 1
            found.append(np.stack([gap[wide], kept[head[wide]]]))
            step += 1
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
        pairs = pairs[:, np.lexsort(pairs[::-1])]
        last = (0, 0, 0)
        for period, at in pairs.T.tolist():
            if period == last[0] and last[1] <= at and at + period < last[2]:
                continue
            start, end = _extended(words, at, period)
            last = (period, start, end)
            if end - start >= 3 * period:
                runs.setdefault((start, end), period)
        # Hashes of windows twice as long, for the next scale.
        known = contexts
        scale *= 2
    return [(a, b, period) for (a, b), period in runs.items()]


def periodic_runs(
    docs: DataFrame,
    keys: tuple[str, ...] = ("doc_id",),
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``keys``, n_words, ``runs`` and the ``collapsed`` text of every document.

    Words are runs free of ASCII white space of the whole text. ``runs`` lists all maximal stretches
    whose smallest period q fits ``min_exponent`` times (3 or more) and that have ``min_length`` words or more, as
    structs (start, length, period) by start, then period; words are numbered from 0. ``collapsed``
    are the words, joined by one blank, without those that any such run contains after its first q.

    Every text is judged alone, in its own task, so nothing is shuffled and no group can grow hot;
    texts are taken about a million words at a time, a longer one alone. A null or blank text has no
    words, no runs and an empty ``collapsed``. Rows that repeat a key are judged one by one; other
    columns are left out; an empty table gives no rows.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    held = [docs.schema[k] for k in keys]
    out = T.StructType(
        [
            *held,
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run)),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def judged(texts: list[list[str]]) -> tuple[list[list[dict]], list[str]]:
        import numpy as np

        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        numbers: dict[str, int] = {}
        coded, sizes = [], []
        for k in order:
            coded += [numbers.setdefault(w, len(numbers)) for w in texts[k]]
            coded.append(-1)
            sizes.append(len(texts[k]) + 1)
        words = np.array(coded, dtype=np.int64)
        ended = np.cumsum(np.array(sizes, dtype=np.int64)) if sizes else np.zeros(0, dtype=np.int64)
        words[ended - 1] = len(numbers) + np.arange(len(ended))
        runs: list[list[dict]] = [[] for _ in texts]
        dropped: dict[int, np.ndarray] = {}
        for start, end, period in sorted(cubic_runs(words, sizes)):
            if end - start < max(min_length, min_exponent * period):
                continue
            at = int(np.searchsorted(ended, start, "right"))
            k, low = order[at], start - (int(ended[at]) - sizes[at])
            runs[k].append({"start": low, "length": end - start, "period": period})
            if k not in dropped:
                dropped[k] = np.zeros(sizes[at], dtype=bool)
            dropped[k][low + period : low + end - start] = True
        collapsed = [
            " ".join(w for w, gone in zip(some, dropped[k].tolist(), strict=False) if not gone)
            if k in dropped
            else " ".join(some)
            for k, some in enumerate(texts)
        ]
        for some in runs:
            some.sort(key=lambda r: (r["start"], r["period"]))
        return runs, collapsed

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        found = re.compile(WORD).findall
        for batch in batches:
            texts = batch.column("text")
            start = 0
            while start < batch.num_rows:
                some, size, stop = [], 0, start
                while stop < batch.num_rows and (not some or size < AT_ONCE):
                    some.append(found(texts[stop].as_py() or ""))
                    size += len(some[-1]) + 1
                    stop += 1
                runs, collapsed = judged(some)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(f"key_{i}").slice(start, stop - start) for i in range(len(held))],
                        pa.array([len(words) for words in some], pa.int64()),
                        pa.array(runs, kind),
                        pa.array(collapsed, pa.string()),
                    ],
                    names=out.names,
                )
                start = stop

    given = docs.select(*[docs[k].alias(f"key_{i}") for i, k in enumerate(keys)], "text")
    return given.mapInArrow(find, out)
