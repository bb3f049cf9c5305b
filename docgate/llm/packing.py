"""Token sequences of fixed length by bin completion over the histogram of lengths."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docgate.llm.common import stage

CAPACITY = 2048
SLICES = 256
NODES = 2_000
Filling = tuple[tuple[int, int], ...]  # (length, copies), longest first

# How byte-level tokenizers cut a text before merging (a fixed value of theirs).
_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
# Characters on which regular expression libraries may disagree: white space that is no blank, tab
# or line end, and whatever lies outside well-known scripts and marks.
_ODD = re.compile(
    "[^\t\n\r\x20-\x7e\xa1-\xac\xae-\u0220\u0222-\u0233\u0250-\u02ad\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481"
    "\u2010-\u2027\u2030-\u205e\u20a0-\u20af\u3041-\u3094\u30a1-\u30fe\u4e00-\u9fa5]"
)
_LONG_WORD = 500


# -- token ids ---------------------------------------------------------------------------------


def _byte_ranks(path: str) -> dict[bytes, int] | None:
    """The tokens of a plain byte-level tokenizer as bytes, if their ids are in the order of its merges."""
    import json

    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, cut = held["model"], held["pre_tokenizer"] or {}
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and held["normalizer"] is None
    if model["type"] != "BPE" or not plain or cut.get("use_regex") is False:
        return None
    # Printable bytes stand for themselves, the others for the characters from U+0100 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    special = {added["content"] for added in held["added_tokens"]}
    tokens = {t: k for t, k in model["vocab"].items() if t not in special}
    merged = [tokens.get("".join(pair)) for pair in pairs]
    if None in merged or merged != sorted(merged) or len(tokens) != len(set(merged)) + 256:
        return None
    return {bytes(map(byte.__getitem__, t)): k for t, k in tokens.items()}


@lru_cache(maxsize=2)
def _encoder(path: str):
    """A function from a text to its token ids as little-endian unsigned 32-bit integers.

    The tokenizer itself does odd texts, texts with special tokens, and tokenizers of other kinds; the
    same merges in a faster library do the rest.
    """
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [added.content for added in tokenizer.get_added_tokens_decoder().values()]
    ranks = _byte_ranks(path)
    fast = None
    if ranks is not None:
        import tiktoken

        fast = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> bytes:
        if (
            fast is None
            or _ODD.search(text)
            or any(s in text for s in special)
            or max(map(len, text.split()), default=0) > _LONG_WORD
        ):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()

    return encode


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """The token pieces of each document: doc_id, piece, start, length, ids_crc32.

    A document is the ids of its text (null: none) and ``end_id``. One that is longer than
    ``capacity`` is cut into pieces of ``capacity``, of which the first may be shorter. ``tokenizer``
    is the path of a tokenizer file that every executor can open. The string of a special token in a
    text becomes that token, as the library's own call has it.
    """

    def pieces(frames: Iterable) -> Iterator:
        import zlib

        import pandas as pd

        encode = _encoder(tokenizer)
        end = end_id.to_bytes(4, "little")
        for frame in frames:
            texts = ["" if t is None else t for t in frame["text"]]
            rows = []
            for doc, ids in zip(frame["doc_id"], map(encode, texts), strict=True):
                ids += end
                total = len(ids) // 4
                start, stop = 0, (total - 1) % capacity + 1
                piece = 0
                while start < total:
                    crc = zlib.crc32(ids[4 * start : 4 * stop])
                    rows.append((doc, piece, start, stop - start, crc))
                    start, stop, piece = stop, stop + capacity, piece + 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype(frame["doc_id"].dtype)
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Texts come a few at a time: a batch of long ones must fit in memory next to its ids.
    return docs.select("doc_id", "text").mapInPandas(
        pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


# -- the plan ----------------------------------------------------------------------------------


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, with equal bins filled at once: (filling, times)."""
    open_bins: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []

    def put(room: int, filling: Filling, times: int) -> None:
        if times:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append((filling, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filling, times = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            else:
                room, filling, times = capacity, (), left
            each = room // length
            full = min(times, left // each)
            put(room - each * length, (*filling, (length, each)), full)
            left -= full * each
            times -= full
            if times and left:
                put(room - left * length, (*filling, (length, left)), 1)
                left, times = 0, times - 1
            if filling:
                put(room, filling, times)
    return [(f, n) for room in rooms for f, n in open_bins[room]]


def fillings(counts: dict[int, int], capacity: int, most: int = 3) -> list[Filling]:
    """Fillings around the largest length, least waste first, one for each of the ``most`` best sums.

    Each takes the longest lengths that still reach its sum, and none leaves room for another
    length, so no listed filling is dominated by one with the same sum.
    """
    largest = max(counts)
    room = capacity - largest
    mask = (1 << (room + 1)) - 1
    usable = [s for s in sorted(counts) if s <= room and counts[s] > (s == largest)]
    reach = [1]
    for s in usable:
        copies, bits, step = min(counts[s] - (s == largest), room // s), reach[-1], 1
        while copies:
            take = min(step, copies)
            bits |= (bits << (take * s)) & mask
            copies, step = copies - take, step * 2
        reach.append(bits)
    sums, bits = [], reach[-1]
    while bits and len(sums) < most:
        best = bits.bit_length() - 1
        sums.append(best)
        bits &= ~(1 << best)
    smallest = usable[0] if usable else room + 1
    found = []
    for total in sums:
        if found and room - total >= smallest:
            break
        chosen, rest = {largest: 1}, total
        for i in range(len(usable) - 1, -1, -1):
            s = usable[i]
            limit = min(counts[s] - (s == largest), rest // s) if rest else 0
            for k in range(limit, -1, -1):
                if reach[i] >> (rest - k * s) & 1:
                    if k:
                        chosen[s] = chosen.get(s, 0) + k
                    rest -= k * s
                    break
        found.append(tuple(sorted(chosen.items(), reverse=True)))
    return found


def bin_completion(
    counts: dict[int, int], capacity: int, nodes: int = NODES
) -> list[tuple[Filling, int]]:
    """As few bins as branch-and-bound finds: (filling, times).

    Best fit is the first incumbent. A node takes the largest length left and completes its bin by
    one of its undominated fillings, as often as the counts allow. A branch is cut when its waste
    exceeds what one bin less than the incumbent leaves. The search ends at the lower bound (total
    over capacity) or after ``nodes`` nodes, of which those up to the first leaf or cut are free.
    """
    counts = {s: n for s, n in counts.items() if n}
    total = sum(s * n for s, n in counts.items())
    bound = -(-total // capacity)
    best = best_fit(counts, capacity)
    bins = sum(n for _, n in best)
    if not counts or bins == bound:
        return best
    path: list[tuple[Filling, int]] = []
    # A frame: what was left, the bins so far, its waste, and the fillings not tried.
    frames = [(counts, 0, 0, fillings(counts, capacity))]
    descended = False
    while frames and bins > bound and (nodes or not descended):
        left, used, waste, choices = frames[-1]
        if not choices:
            frames.pop()
            if path:
                path.pop()
            continue
        filling = choices.pop(0)
        times = min(left[s] // k for s, k in filling)
        lost = waste + times * (capacity - sum(s * k for s, k in filling))
        nodes -= descended and nodes > 0
        after = dict(left)
        for s, k in filling:
            after[s] -= k * times
            if not after[s]:
                del after[s]
        if after and lost > (bins - 1) * capacity - total:
            descended = True
            continue
        path.append((filling, times))
        if after:
            frames.append((after, used + times, lost, fillings(after, capacity)))
            continue
        descended = True
        if used + times < bins:
            bins, best = used + times, list(path)
        path.pop()
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``pieces`` with sequence_id and offset, in as few sequences as the plan finds.

    ``pieces`` needs doc_id, piece and length (1 to ``capacity``). Only the histogram of lengths
    reaches the driver, at most ``capacity`` rows at any input size; the plan says how many bins get
    which lengths, and pieces of one length take its places in order. That order is by hash slice,
    whose counts are added up first, so a length that a third of all pieces have is no hot group.
    Rows that repeat a document are packed like any others; an empty table gives no rows.
    """
    placed = ["doc_id", "piece", "length"]
    rows = pieces.withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)).cast("int")
    )
    counts = rows.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = bin_completion(histogram, capacity, nodes)
    taken = dict.fromkeys(histogram, 0)
    table, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for length, copies in filling:
            table.append((length, taken[length], sequence, copies, offset))
            taken[length] += times * copies
            offset += length * copies
        sequence += times
    table.sort()
    spark = pieces.sparkSession
    places = spark.sparkContext.broadcast(table)  # a few rows for each of at most `capacity` lengths

    def look_up(frames: Iterable) -> Iterator:
        import numpy as np

        # First by length and rank, as one sortable number each.
        lengths, firsts, sequences, copies, offsets = (
            np.array(c, dtype=np.int64) for c in zip(*places.value, strict=True)
        )
        spans = {s: (np.searchsorted(lengths, s), np.searchsorted(lengths, s, "right")) for s in set(lengths.tolist())}
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            at = np.zeros(len(frame), dtype=np.int64)
            for s in np.unique(length).tolist():
                low, high = spans[s]
                here = length == s
                at[here] = low + np.searchsorted(firsts[low:high], rank[here], "right") - 1
            past = rank - firsts[at]
            frame["sequence_id"] = sequences[at] + past // copies[at]
            frame["offset"] = offsets[at] + past % copies[at] * length
            yield frame.drop(columns="rank")

    in_length = Window.partitionBy("length").orderBy("slice")
    starts = counts.select(
        "length", "slice", (F.sum("n").over(in_length) - F.col("n")).alias("before")
    )
    in_slice = Window.partitionBy("length", "slice").orderBy(
        *placed[:2], *[c for c in pieces.columns if c not in placed]
    )
    ranked = (
        rows.withColumn("place", F.row_number().over(in_slice) - 1)
        .join(starts, ["length", "slice"])
        .select(*pieces.columns, (F.col("before") + F.col("place")).cast("long").alias("rank"))
    )
    kinds = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return ranked.mapInPandas(look_up, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents tokenized, cut and packed; see :func:`cut_pieces` and :func:`pack`."""
    return pack(stage(cut_pieces(docs, tokenizer, capacity), "pieces"), capacity)
