"""The corpus pipeline against plain Python, and what stands without it."""

from __future__ import annotations

import os
from collections import Counter

import pytest

import corpus_pipeline
from docgate.llm import queries
from docgate.llm.common import stage
from tests.llm import brute
from tests.llm.test_similar import classes

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_stages_over_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kinds = docs.dtypes
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(function(spark, docs, SF_DIR), name)
        seen[name] = (before, docs.collect())
        assert name == "packing" or docs.dtypes == kinds
    before, after = seen["language_id"]
    assert {r.doc_id for r in before if len(r.text) > 100} <= {r.doc_id for r in after}
    before, after = seen["exact_dedup"]
    groups = brute.group_by(before, lambda r: brute.one_spaced(r.text))
    assert {r.doc_id for r in after} == {min(r.doc_id for r in some) for some in groups.values()}
    before, after = seen["near_dedup"]
    before = sorted(before, key=lambda r: r.doc_id)
    assert {r.doc_id for r in after} == {before[k].doc_id for k in set(classes([r.text for r in before]))}
    before, after = seen["source_mix"]
    sizes: Counter = Counter()
    taken: Counter = Counter()
    for r in before:
        sizes[r.source] += len(brute.words(r.text))
    for r in after:
        taken[r.source] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    for source, target in brute.targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= 1
    before, after = seen["packing"]
    assert sum(r.piece == 0 for r in after) == len(before)
    bound = -(-sum(r.length for r in after) // 2048)
    assert bound <= len({r.sequence_id for r in after}) <= bound + 1


def test_stages_take_tricky_rows(spark):
    docs = spark.createDataFrame(brute.tricky_docs(), brute.SCHEMA)
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, SF_DIR), name)
        assert [n for n, _ in docs.dtypes] == brute.SCHEMA.replace("`", "").replace(" long", "").replace(" string", "").split(", ")
        assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], brute.SCHEMA)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, SF_DIR).count() == 0


def test_every_operator_has_its_query():
    assert [name.partition("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.ORACLES) <= set(queries.QUERIES)
