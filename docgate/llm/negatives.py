"""Hard negatives of anchor vectors by a secondary sort of their scored pairs."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docgate.llm.common import parts, stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score
BLOCK_ANCHORS = 2_048
GROUP_ROWS = 131_072
AT_ONCE = 1_024
_EXACT = 2**50  # sums below this are exact in doubles, with room for ties


def whole_components(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label (long) and the vector as whole numbers floor(scale * x), in ``parts``.

    Rows with a null id, label or vector, or with any null or non-finite component, are left out. Rows
    that repeat an id count once: the one with the smallest label, then vector.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~bad
    rows = vectors.where(fit).select(
        "vec_id",
        F.struct(
            F.col("label").cast("long").alias("label"),
            F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("parts"),
        ).alias("held"),
    )
    return rows.groupBy("vec_id").agg(F.min("held").alias("held")).select("vec_id", "held.*")


def _tiles(rows: DataFrame, anchors: DataFrame, groups: int, blocks: int) -> DataFrame:
    """One partition for each block of anchors and group of rows: anchors first, then rows by id.

    Anchors are copied to all groups and rows to all blocks, so each pair meets in one tile.
    """
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select(block.alias("block"), "*", F.lit(False).alias("is_row"))
    left = left.select(every(groups).alias("group"), "*")
    right = rows.select(group.alias("group"), "*", F.lit(True).alias("is_row"))
    right = right.select(every(blocks).alias("block"), "*")
    both = left.unionByName(right, allowMissingColumns=True)
    if "positive_scores" not in both.columns:
        both = both.withColumn("positive_scores", F.lit(None).cast("array<bigint>"))
    tile = F.col("group") * blocks + F.col("block")
    return (
        both.select("group", "block", "is_row", "vec_id", "label", "parts", "positive_scores")
        .repartitionById(groups * blocks, tile)
        .sortWithinPartitions("is_row", "vec_id")
    )


def _best_of_tiles(tiles: DataFrame, most: int, low: int, high: int) -> DataFrame:
    """anchor_id, vec_id and score of what each tile can contribute.

    Without ``positive_scores``: the ``most`` best other rows of the anchor's label. With them: for each,
    the ``most`` best rows of another label in its window. Ties go to the smaller id. A tile's
    pairs are scored by products of matrices, a few rows at a time, and only the best are kept.
    """

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def matrix(batch) -> np.ndarray:
            lists = batch.column("parts")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if len(sizes) and (sizes == sizes[0]).all():
                made = flat.reshape(len(sizes), -1)
            else:
                made = np.zeros((len(sizes), sizes.max(initial=0)), dtype=np.int64)
                made[np.arange(made.shape[1]) < sizes[:, None]] = flat
            return made

        class Tile:
            """The anchors of a tile and the best pairs so far."""

            def __init__(self) -> None:
                self.given: list = []
                self.ready = False

            def begin(self) -> None:
                batch = pa.Table.from_batches(self.given).combine_chunks().to_batches()[0]
                self.ids = batch.column("vec_id").to_numpy()
                self.labels = batch.column("label").to_numpy()
                self.vectors = matrix(batch)
                scores = batch.column("positive_scores").to_pylist()
                n, least = len(self.ids), np.iinfo(np.int64).min
                if all(s is None for s in scores):
                    self.windows = [(np.full(n, least + 1), np.full(n, -least - 1))]
                    self.same = True
                else:
                    slots = max(len(s or []) for s in scores)
                    self.windows, self.same = [], False
                    for j in range(slots):
                        at = [s[j] if s and j < len(s) else None for s in scores]
                        # Anchors with fewer positives have no window here.
                        lows = [1 if v is None else -(-low * v // 100) for v in at]
                        highs = [0 if v is None else high * v // 100 for v in at]
                        self.windows.append((np.array(lows), np.array(highs)))
                empty = np.zeros(0, dtype=np.int64)
                self.best = [(empty, empty, empty)] * len(self.windows)
                # A later row has a larger id, so it must score more than the last of the best.
                self.floors = [lows.copy() for lows, _ in self.windows]
                self.ready = True

            def scores(self, vectors: np.ndarray) -> np.ndarray:
                width = max(vectors.shape[1], self.vectors.shape[1])
                a = np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1])))
                b = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
                peak = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
                bound = width * peak(a) * peak(b)
                if bound < _EXACT:
                    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
                if bound >= 2**62:
                    raise OverflowError("a score may not fit in 64 bits; use a smaller scale")
                return a @ b.T

            def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
                found = self.scores(vectors)
                fit = (self.labels[:, None] == labels) == self.same
                fit &= self.ids[:, None] != ids
                every, none = np.arange(len(found)), np.iinfo(np.int64).min
                for j, (_, highs) in enumerate(self.windows):
                    hit = fit & (found >= self.floors[j][:, None]) & (found <= highs[:, None])
                    some = np.where(hit, found, none)
                    parts_ = [self.best[j]]
                    for _ in range(most):
                        at = some.argmax(axis=1)  # the first, so the smallest id, of equal scores
                        held = np.flatnonzero(some[every, at] != none)
                        if not len(held):
                            break
                        parts_.append((held, some[held, at[held]], ids[at[held]]))
                        some[every, at] = none
                    if len(parts_) == 1:
                        continue
                    anchor, score, of = (np.concatenate(c) for c in zip(*parts_, strict=True))
                    order = np.lexsort((of, -score, anchor))
                    anchor, score, of = anchor[order], score[order], of[order]
                    first = np.searchsorted(anchor, anchor)
                    keep = np.arange(len(anchor)) - first < most
                    self.best[j] = anchor, score, of = anchor[keep], score[keep], of[keep]
                    last = np.arange(len(anchor)) - np.searchsorted(anchor, anchor) == most - 1
                    self.floors[j][anchor[last]] = score[last] + 1

            def results(self) -> Iterator:
                if not self.ready:
                    return
                anchor, score, of = (np.concatenate(c) for c in zip(*self.best, strict=True))
                # Windows overlap: a pair is given once.
                pairs = np.unique(np.stack([self.ids[anchor], of, score]), axis=1)
                if pairs.shape[1]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in pairs], ["anchor_id", "vec_id", "score"]
                    )

        tile = Tile()
        for batch in batches:
            begun = int(np.searchsorted(np.asarray(batch.column("is_row")), True))
            if begun:
                tile.given.append(batch.slice(0, begun))
            if not tile.given or begun == batch.num_rows:
                continue
            if not tile.ready:
                tile.begin()
            for at in range(begun, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                tile.add(ids, labels, matrix(part))
        yield from tile.results()

    return tiles.mapInArrow(scan, "anchor_id long, vec_id long, score long")


def _sortable(number: Column) -> Column:
    """A long as 8 bytes that sort like it."""
    flipped = number.bitwiseXOR(F.lit(-(2**63)).cast("long"))
    return F.unhex(F.lpad(F.hex(flipped), 16, "0"))


def mine_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block_anchors: int = BLOCK_ANCHORS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The first ``negatives`` hard negatives of each positive of each anchor.

    ``vectors`` needs vec_id (long), label (whole number) and embedding (list of numbers); ``anchors`` is a
    condition on them. A score is the whole-number inner product of floor(scale * x); higher
    scores come first, ties by smaller vec_id. An anchor's positives are its first ``positives`` other
    rows of its label; a positive's negatives are the first rows of other labels that score from
    ``low`` to ``high`` percent of it. Gives anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score. The result is exact: all anchors meet all rows, in tiles.

    Two rounds of tiles keep what is shuffled small: the first finds each anchor's positives, the second
    what each tile can contribute to their windows, a bounded number of pairs. These are shuffled
    by anchor and sorted by one packed key of anchor, falling score, kind and id; a reader opens a
    window at each positive and gives negatives out as they come by, so no anchor is ever held in memory.

    Rows with nulls or non-finite components take no part (see :func:`whole_components`); a shorter
    vector counts as filled up with zeros. Empty tables, and anchors without positives or negatives,
    give no rows; other columns are left out. A common label is no hot group: tiles are cut by
    hash of the id.
    """
    rows = stage(whole_components(vectors.select("vec_id", "label", "embedding"), scale), "vectors")
    queries = rows.where(anchors)
    size, asked = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(anchors.cast("long")), F.lit(0))
    ).first()
    blocks = max(1, -(-asked // block_anchors))
    groups = max(-(-parts(vectors) // blocks), -(-size // group_rows))

    near = _best_of_tiles(_tiles(rows, queries, groups, blocks), positives, low, high)
    best_first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = stage(
        near.withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") <= positives)
        .drop("place"),
        "positives",
    )
    scores = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("positive_scores")
    )  # at most `positives` each
    tiles = _tiles(rows, queries.join(scores, "vec_id"), groups, blocks)
    far = _best_of_tiles(tiles, negatives, low, high)

    pairs = near.withColumn("kind", F.lit(0)).unionByName(far.withColumn("kind", F.lit(1)))
    key = F.concat(
        _sortable(F.col("anchor_id")),
        _sortable(F.bitwise_not("score")),
        F.when(F.col("kind") == 0, F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit("01"))),
        _sortable(F.col("vec_id")),
    )
    # The DataFrame form of repartitionAndSortWithinPartitions.
    sorted_pairs = (
        pairs.select("anchor_id", "vec_id", "score", "kind", key.alias("key"))
        .repartition("anchor_id")
        .sortWithinPartitions("key")
        .drop("key")
    )

    def emit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        anchor, windows = None, []
        for batch in batches:
            given = []
            for of, other, score, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != anchor:
                    anchor, windows = of, []
                if kind == 0:
                    windows.append([other, score, 0])
                    continue
                for window in windows:
                    positive, best, n = window
                    if n < negatives and low * best <= 100 * score <= high * best:
                        window[2] = n + 1
                        given.append((of, positive, n + 1, other, best, score))
                windows = [w for w in windows if w[2] < negatives]
            columns = zip(*given, strict=True) if given else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return sorted_pairs.mapInArrow(
        emit,
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
