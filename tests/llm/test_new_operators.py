"""Piece ids, periodic runs and hard negatives against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docgate.llm import negatives, periods, pieces
from docgate.llm.queries import (
    op11_sentencepiece,
    op12_periods,
    op13_negatives,
    tokenizer_path,
    with_planted_periods,
)
from tests.llm import brute

MODEL = tokenizer_path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.tricky_docs(), brute.SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def sf_dir(docs, tmp_path_factory):
    """A folder with the tricky documents and a small table of vectors."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{folder}/documents.parquet")
    vectors = docs.sparkSession.createDataFrame(
        small_vectors(), "vec_id long, label int, embedding array<double>, block string, `key` string"
    )
    vectors.write.parquet(f"{folder}/embeddings.parquet")
    return folder


def small_vectors() -> list[tuple]:
    rng = random.Random(3)
    rows = []
    for i in range(240):
        label = 1 if i % 3 == 0 else rng.randrange(10)
        vector = [rng.choice([0.0, 0.25, 0.5, -0.25, 0.123]) + 0.3 * (k % 10 == label) for k in range(12)]
        rows.append((i, label, vector, "clash", "clash"))
    rows += [rows[50], rows[51], (7, 2, rows[7][2], None, None)]  # repeated ids
    rows += [(None, 1, rows[0][2], None, None), (300, None, rows[0][2], None, None), (350, 1, None, None, None)]
    rows += [(400, 1, [math.nan] * 12, None, None), (401, 1, [math.inf] + [0.0] * 11, None, None)]
    rows += [(402, 1, [None] + [0.5] * 11, None, None), (450, 2, [], None, None), (451, 2, [0.5] * 20, None, None)]
    rows += [(500, 77, [1.0] * 12, None, None)]  # the only row of its label
    return rows


# -- op11 --------------------------------------------------------------------------------------

ODD_TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "  a  b  ", "\n", "\n\n a\n b \n", "\u2581", "x\u2581\u2581y z", "<s> </s> <unk> <0x0A>",
    "\x00 a\x00", "\ufb01\u2460\u3000 \u00e9\u200b", "\U0001f600\U0001f600 \u5317\u4eac", "don't\tstop\r\nnow", ".", ". .", "a" * 5_000,
]


def test_ids_like_the_library(spark, docs):
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    odd = spark.createDataFrame([(1_000 + k, t) for k, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    both = docs.select("doc_id", "text", F.col("row").alias("block")).unionByName(odd, allowMissingColumns=True)
    for block_chars in (500, 32_000_000):
        got = pieces.encode_texts(both, MODEL, ("doc_id", "text", "block"), block_chars=block_chars)
        rows = pieces.decode_ids(got, MODEL).collect()
        assert sorted(map(repr, [(r.doc_id, r.text, r.block) for r in rows])) == sorted(
            map(repr, [tuple(r) for r in both.collect()])
        )
        for r in rows:
            ids = made.encode(r.text or "", add_bos=True, add_eos=True)
            assert np.frombuffer(r.ids, "<u4").tolist() == ids, r.text
            assert r.decoded == made.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\u2581\u00e9\u3000.\x00\U0001f600<s>"), max_size=40))
def test_chunks_never_cut_a_piece(text):
    made = pieces._processor(MODEL)
    skip = len(made.encode("."))
    ids = [k for c in pieces.chunks(text) for k in made.encode("." + c)[skip:]]
    assert ids == made.encode(text)


def test_pieces_without_rows_and_refused_models(spark, docs):
    assert pieces.encode_texts(docs.limit(0), MODEL).count() == 0
    with pytest.raises(Exception, match="Not found|No such|not"):
        pieces._processor("/nowhere.model")


def test_op11_digests(spark, sf_dir):
    made = pieces._processor(MODEL)
    wanted = []
    for doc_id, text, *_ in brute.tricky_docs():
        ids = made.encode(text or "", add_bos=True, add_eos=True)
        wanted.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(made.decode(ids))))
    assert sorted(map(repr, map(tuple, op11_sentencepiece(spark, sf_dir).collect()))) == sorted(map(repr, wanted))


# -- op12 --------------------------------------------------------------------------------------


def repetitive(rng: random.Random) -> list[str]:
    """Words of a few letters with periodic stretches, nested ones too."""
    words: list[str] = []
    letters = "ab" if rng.random() < 0.5 else "abcdefghijklmnop"
    for _ in range(rng.randint(1, 6)):
        root = rng.choices(letters, k=rng.choice([1, 2, 3, 5, 8, 13, 21, 34, 60]))
        if rng.random() < 0.4:
            root = root * rng.randint(1, 5) + rng.choices(letters, k=rng.randint(0, 3))
        whole = root * rng.randint(1, 9)
        words += whole[: rng.randint(1, len(whole))]
        words += rng.choices(letters, k=rng.randint(0, 10))
    return words


def listed(rows: list[list[str]], least: int = 3) -> list[list[tuple[int, int, int]]]:
    """Runs of three periods or more of each text by :func:`periods.cubic_runs`, all texts at once."""
    order = sorted(range(len(rows)), key=lambda k: -len(rows[k]))
    numbers: dict[str, int] = {}
    coded, sizes = [], []
    for k in order:
        coded += [numbers.setdefault(w, len(numbers)) for w in rows[k]] + [10**6 + k]
        sizes.append(len(rows[k]) + 1)
    ends = np.cumsum(sizes)
    out: list[list] = [[] for _ in rows]
    for a, b, p in periods.cubic_runs(np.array(coded), sizes):
        at = int(np.searchsorted(ends, a, "right"))
        out[order[at]].append((a - int(ends[at]) + sizes[at], b - a, p))
    return [sorted(some) for some in out]


@pytest.mark.parametrize("seed", range(40))
def test_all_cubic_runs(seed):
    rng = random.Random(seed)
    rows = [repetitive(rng) for _ in range(12)] + [[]]
    for words, got in zip(rows, listed(rows), strict=True):
        assert got == brute.runs(words, 0, 3)


def test_runs_of_long_periods_and_words():
    rng = random.Random(1)
    root = rng.choices("abc", k=1_357)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 3_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    rows = [["x"] + root * 4 + ["y"], list(fibonacci[-1]), list(fibonacci[12] * 4), ["w"] * 5_000]
    for words, got in zip(rows, listed(rows), strict=True):
        assert got == brute.runs(words, 0, 3)


def test_op12_digests(spark, docs, sf_dir):
    planted = {(r.doc_id, r.text) for r in with_planted_periods(docs).collect()}
    wanted = []
    for doc_id, text, *_ in brute.tricky_docs():
        words = brute.planted(doc_id, text)
        assert (doc_id, text) in planted or (doc_id, " ".join(words)) in planted
        some = brute.runs(words)
        best = max(some, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        wanted.append((
            doc_id, len(some), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{a},{n},{p}\n" for a, n, p in sorted(some, key=lambda r: (r[0], r[2])))),
            sha(brute.collapsed(words, some)),
        ))
    got = op12_periods(spark, sf_dir)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))
    assert periods.periodic_runs(docs.limit(0)).count() == 0


# -- op13 --------------------------------------------------------------------------------------


def test_op13_pairs(spark, sf_dir):
    rows = [
        (i, (label + 1) % 10 if None not in (i, label) and i % 7 == 0 else label, vector)
        for i, label, vector, *_ in small_vectors()
    ]
    wanted = brute.hard_negatives(rows, lambda i: i % 50 == 0)
    got = op13_negatives(spark, sf_dir).collect()
    assert len(got) == len({tuple(r) for r in got}) == len(wanted) > 20
    assert {tuple(r) for r in got} == wanted


def test_tiles_of_any_size_and_large_sums(spark):
    rng = random.Random(5)
    rows = [(i, i % 4, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(5)]) for i in range(-30, 150)]
    for scale, factor in ((2, 1), (2**28, 1)):
        vectors = spark.createDataFrame(rows, "vec_id long, label long, embedding array<float>")
        got = negatives.mine_negatives(
            vectors, F.col("vec_id") % 10 == 0, scale=scale * factor, block_anchors=5, group_rows=40
        )
        wanted = brute.hard_negatives(rows, lambda i: i % 10 == 0, scale)
        assert {tuple(r) for r in got.collect()} == wanted and len(wanted) > 20


def test_negatives_without_rows(spark):
    vectors = spark.createDataFrame(small_vectors()[:20], "vec_id long, label int, embedding array<double>, b string, c string")
    assert negatives.mine_negatives(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert negatives.mine_negatives(vectors, F.col("vec_id") < -5).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        negatives.mine_negatives(vectors, F.col("vec_id") == 0, scale=2**40).collect()
