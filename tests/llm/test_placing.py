"""Mixing, packing and sharding against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgate.llm import mixing, packing, sharding
from docgate.llm.queries import tokenizer_path
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.tricky_docs(), brute.SCHEMA).repartition(5).cache()


def test_mix_meets_its_targets(docs):
    rows = brute.tricky_docs()
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(brute.words(r[1]))
    expected = brute.targets(sizes)
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (r[0], r[3], len(brute.words(r[1]))) for r in rows
    )
    for source, some in brute.group_by(got, lambda r: r.source).items():
        assert {r.source_size for r in some} == {sizes[source]}
        assert all(r.target == pytest.approx(expected[source]) for r in some)
        assert abs(sum(r.taken for r in some) - expected[source]) <= 1
        whole = int(expected[source] // sizes[source]) if sizes[source] else 0
        assert all(whole * r.size <= r.taken <= min(3, whole + 1) * r.size for r in some)
    assert Counter(got) == Counter(mixing.mix(docs.repartition(3)).collect())


def test_mix_with_own_weights_and_budget(spark):
    docs = spark.createDataFrame(
        [(i, "w " * 10, "ab"[i % 2]) for i in range(40)], "doc_id long, text string, source string"
    )
    weights = spark.createDataFrame([("a", 9), ("b", 1)], "source string, weight long")
    got = mixing.mix(docs, weights, budget=300, epochs=1).collect()
    taken = {s: sum(r.taken for r in some) for s, some in brute.group_by(got, lambda r: r.source).items()}
    assert taken == {"a": 200, "b": 100}


def test_drawn_rows_are_what_the_mix_takes(docs):
    drawn = mixing.draw_mix(docs)
    assert drawn.dtypes == docs.dtypes
    got = Counter()
    for r in drawn.collect():
        got[(r.doc_id, r.source)] += len(brute.words(r.text))
    expected = Counter()
    for r in mixing.mix(docs).collect():
        expected[(r.doc_id, r.source)] += r.taken
    assert got == +expected


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_length_once(seed):
    rng = np.random.default_rng(seed)
    drawn = np.clip(rng.lognormal(5 + seed / 2, 1, 800), 1, 2048).astype(int)
    counts = dict(zip(*(x.tolist() for x in np.unique(drawn, return_counts=True)), strict=True))
    for plan in (packing.best_fit(counts, 2048), packing.bin_completion(counts, 2048)):
        used: Counter = Counter()
        for filling, times in plan:
            assert sum(s * k for s, k in filling) <= 2048
            for s, k in filling:
                used[s] += k * times
        assert used == counts
    bins = sum(n for _, n in packing.bin_completion(counts, 2048, nodes=200))
    assert -(-int(drawn.sum()) // 2048) <= bins <= sum(n for _, n in packing.best_fit(counts, 2048))


def test_search_beats_best_fit():
    """Best fit puts 6 with 4 first; three bins of 10 hold 6 4, 5 3 2 and 5 3 2."""
    counts = {6: 1, 5: 2, 4: 1, 3: 2, 2: 2}
    assert sum(n for _, n in packing.bin_completion(counts, 10)) == 3
    counts = {7: 1, 6: 1, 4: 1, 3: 3, 2: 1}  # 28 in bins of 14: 7 4 3 and 6 3 3 2
    assert sum(n for _, n in packing.bin_completion(counts, 14)) == 2
    assert packing.bin_completion({}, 10) == []


def test_packed_documents(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = Counter()
    for r in brute.tricky_docs():
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 512 + 1
        ends = [first, *range(first + 512, len(ids) + 1, 512)]
        for piece, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            expected[(r[0], piece, a, b - a, crc)] += 1
    got = packing.pack_documents(docs, tokenizer_path(), capacity=512).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    for some in brute.group_by(got, lambda r: r.sequence_id).values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    bound = -(-sum(r.length for r in got) // 512)
    assert bound <= len({r.sequence_id for r in got}) <= bound + 1


def test_shards(docs):
    got = sharding.assign_shards(docs, sharding.even_tree(8), sharding.even_tree(9)).collect()
    texts = Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
        for r in brute.tricky_docs()
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == texts
    for some in brute.group_by(got, lambda r: r.shard).values():
        assert sorted(r.slot for r in some) == list(range(len(some)))
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert all(len({r.shard for r in some}) == 1 for some in brute.group_by(got, lambda r: r.doc_id).values())


def test_weights_move_rows_only_in_their_subtrees(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "key")
    tree = {"a": {"r1": {0: 1, 1: 1}, "r2": {2: 2}}, "b": {"r3": {3: 1, 4: 3}}}
    moved = {"a": {"r1": {0: 1, 1: 1}, "r2": {2: 2}}, "b": {"r3": {3: 3, 4: 1}}}
    rows = keys.select(
        sharding.shard_of(F.col("key"), tree).alias("x"), sharding.shard_of(F.col("key"), moved).alias("y")
    ).collect()
    counts = Counter(r.x for r in rows)
    total = sum(counts.values())
    for shard, weight in {0: 1, 1: 1, 2: 2, 3: 1, 4: 3}.items():
        assert counts[shard] / total == pytest.approx(weight / 8, abs=0.012)
    assert all(r.x == r.y for r in rows if r.x in (0, 1, 2))
    assert all(r.y in (3, 4) for r in rows if r.x in (3, 4))
    assert {r.y for r in rows if r.x == 3} == {3}


def test_empty_tables(docs):
    empty = docs.limit(0)
    assert mixing.mix(empty).count() == 0
    assert mixing.draw_mix(empty).count() == 0
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0
    assert sharding.assign_shards(empty, sharding.even_tree(8)).count() == 0


def test_ids_like_the_tokenizer():
    """Random odd texts, and every character that the faster library may see, next to others."""
    from tokenizers import Tokenizer

    path = tokenizer_path()
    tokenizer, encode = Tokenizer.from_file(path), packing._encoder(path)
    rng = random.Random(1)
    some = [" ", "\n", "a", "B", "é", ".", ",", "1", "'s", "<|endoftext|>", "\t", "  ", "北", "x", " the", "\r", "\u2028", "\x1c", "ǆ", "١"]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 14))) for _ in range(5_000)] + ["y" * 3_000]
    safe = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and not packing._ODD.search(chr(c))]
    texts += ["".join(f"{c}a {c}1{c}, {c}{c}\n{c}" for c in safe[k : k + 50]) for k in range(0, len(safe), 50)]
    assert len(safe) > 20_000
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encode(text), "<u4").tolist() == found.ids, text
