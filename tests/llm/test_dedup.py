"""Exact copies, near copies and repeated passages against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docgate.llm import naming, repeats, simhash
from docgate.llm.common import named
from docgate.llm.components import components
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.tricky_docs(), brute.SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_names_are_dense_ranks(spark):
    values = [None, "", "b", "a", "ab"] + ["hot"] * 50 + [f"v{i % 7}" for i in range(60)]
    rows = spark.createDataFrame(list(enumerate(values)), "i long, v string")
    got = {r.i: r.n for r in named(rows, ["v"], ["i"], "n").collect()}
    order = sorted(set(values), key=lambda v: (v is not None, v or ""))
    assert got == {i: order.index(v) for i, v in enumerate(values)}


@pytest.mark.parametrize("coarse", ["1", "hash(v) % 2", "substring(v, 1, 1)"])
def test_names_survive_collisions_of_the_short_key(spark, coarse):
    values = [None] + ["hot"] * 80 + [f"v{i % 9}" for i in range(90)] + [f"h{i}" for i in range(30)]
    rows = spark.createDataFrame(list(enumerate(values)), "i long, v string")
    rows = rows.withColumn("c", F.expr(coarse).cast("string"))
    names = brute.group_by(named(rows, ["v"], ["i"], "n", coarse=["c"]).collect(), lambda r: values[r.i])
    assert all(len({r.n for r in some}) == 1 for some in names.values())
    assert len({some[0].n for some in names.values()}) == len(names) == len(set(values))


@pytest.mark.parametrize("block", [900, 4096])
def test_exact_copies(docs, block):
    expected = Counter()
    rows = [(r[0], brute.one_spaced(r[1])) for r in brute.tricky_docs()]
    groups = brute.group_by(rows, lambda r: r[1])
    for i, text in rows:
        keep = min((x[0] for x in groups[text]), key=lambda i: (i is None, i))
        expected[(i, keep, len(groups[text]), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = naming.exact_copies(docs, block_chars=block).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(
        hashlib.sha256(t.encode()).hexdigest() for t in groups
    )
    assert all(r.doc_id == r.keep_id for r in kept)


def test_dropping_exact_copies_keeps_one_whole_row(docs):
    got = naming.drop_exact_copies(docs)
    assert got.dtypes == docs.dtypes
    texts = [brute.one_spaced(r.text) for r in got.collect()]
    assert sorted(texts) == sorted({brute.one_spaced(r[1]) for r in brute.tricky_docs()})


def test_fingerprints_and_classes(docs):
    rows = brute.tricky_docs()
    fps = [brute.simhash(r[1]) for r in rows]
    roots = brute.classes(fps)
    ids = brute.group_by(range(len(rows)), lambda k: roots[k])
    expected = Counter()
    for k, row in enumerate(rows):
        known = [rows[j][0] for j in ids[roots[k]] if rows[j][0] is not None]
        near = {f for f in fps if 0 < (f ^ fps[k]).bit_count() <= 4}
        expected[(row[0], f"{fps[k]:016x}", min(known, default=None), len(near))] += 1
    got = simhash.near_copies(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id, r.n_links) for r in got) == expected


def test_dropping_near_copies_keeps_one_row_of_each_class(docs):
    got = simhash.drop_near_copies(docs)
    assert got.dtypes == docs.dtypes
    assert len(set(brute.classes([brute.simhash(r[1]) for r in brute.tricky_docs()]))) == got.count()


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 5])
def test_links_find_every_place_of_the_bits(spark, bits):
    import random

    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(80)]
    flipped = [f ^ sum(1 << b for b in rng.sample(range(64), bits)) for f in base]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in base + flipped})
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {(r.a, r.b) for r in simhash.links(rows).collect()}
    full = (1 << 64) - 1
    expected = {
        (a, b) for a in fps for b in fps if a < b and ((a ^ b) & full).bit_count() <= 4
    }
    assert got == expected


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    cycle = [(900 + i, 900 + (i + 1) % 7) for i in range(7)]
    links = spark.createDataFrame(chain + star + cycle, "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == (
        {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {900 + i: 900 for i in range(7)}
    )
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize(("size", "seeds"), [(35, 6), (4, 3)])
def test_repeated_passages(docs, size, seeds):
    rows = brute.tricky_docs()
    left = brute.without_repeats([r[1] for r in rows], size)
    expected = Counter((r[0], *x) for r, x in zip(rows, left, strict=True))
    got = repeats.drop_repeats(docs, size, seeds, keep_text=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected
    for r in got:
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
        assert sum(s.length for s in r.spans) == r.n_removed


def test_empty_tables(empty):
    assert naming.exact_copies(empty).count() == 0
    assert naming.drop_exact_copies(empty).count() == 0
    assert simhash.near_copies(empty).count() == 0
    assert simhash.drop_near_copies(empty).count() == 0
    assert repeats.drop_repeats(empty).count() == 0
