"""Language, extraction and sharding queries against plain Python on small tables."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from docgate.llm import extract, language, queries, sharding
from tests.llm import brute

WRAP = (1 << 64) - 1


def slots(text: str) -> frozenset[int]:
    """The slots of the text's runs of one, two and three characters."""
    some, text = set(), text.lower()
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            mixed = 0
            for k in range(n):
                mixed = (mixed * 0x100000001B3 + ord(text[i + k]) + k + 1) & WRAP
            some.add((mixed * 0x9E3779B97F4A7C15 & WRAP) >> 48)
    return frozenset(some)


def kernel(a: frozenset, b: frozenset) -> float:
    return len(a & b) / math.sqrt(len(a) * len(b)) if a and b else 0.0


def languages(rows: list[tuple], ridge: float = language.RIDGE) -> dict:
    """Kernel ridge regression in its dual form: with every row a landmark nothing is approximated."""

    def lettered(text):
        return text is not None and any(c.isalpha() for c in text)

    def held(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2

    learnt = [(slots(t), lang) for i, t, lang in rows if lang is not None and lettered(t) and not held(i)]
    names = sorted({lang for _, lang in learnt})
    gram = np.array([[kernel(a, b) + 1 for b, _ in learnt] for a, _ in learnt])
    answers = np.array([[1.0 if lang == name else -1.0 for name in names] for _, lang in learnt])
    duals = np.linalg.solve(gram + ridge * np.eye(len(gram)), answers)
    out = defaultdict(list)
    for i, text, _ in rows:
        if not lettered(text):
            out[i].append((held(i), "und", 0.0, 1.0))
            continue
        own = slots(text)
        scores = np.array([kernel(own, b) + 1 for b, _ in learnt]) @ duals
        first, second = sorted(range(len(names)), key=lambda k: -scores[k])[:2]
        score = min(1.0, max(0.0, (scores[first] + 1) / 2))
        out[i].append((held(i), names[first], score, scores[first] - scores[second]))
    return out


def test_language_query(spark, tmp_path):
    rng = random.Random(3)
    letters = {"aa": "abcdehimno", "bb": "abdfgklort", "cc": "bcegijpqsu"}
    vocabulary = {
        lang: ["".join(rng.choices(some, k=rng.randint(2, 6))) for _ in range(40)] for lang, some in letters.items()
    }
    rows = []
    for i in range(150):
        lang = "abc"[i % 3] * 2
        words = rng.choices(vocabulary[lang], k=rng.randint(1, 30))
        rows.append((i, " ".join(words).title(), None if i % 10 == 9 else lang))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 34 !", "cc"), (203, "é", None), (None, "abc", None)]
    rows += [(7, rows[7][1], rows[7][2])] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    want = languages(rows)
    got = queries.op6_language(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    clear = 0
    for r in got:
        held, lang, score, lead = want[r.doc_id][0]
        assert r.held_out == held
        assert r.score == pytest.approx(score, abs=2e-3)
        if lead > 0.01:
            assert r.lang_pred == lang
            clear += 1
    assert clear > 140


def shard(key: int | None, tree: dict, path: str = "") -> int:
    """The shard of a key by its draws at each node."""

    def weight(node):
        return node if isinstance(node, int) else sum(weight(child) for child in node.values())

    best = None
    for name, child in tree.items():
        if weight(child) == 0:
            continue
        drawn = xxhash.xxh64_intdigest(f"{path}/{name}".encode(), 42)
        if key is not None:
            drawn = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), drawn)
        draw = math.log(((drawn >> 11) + 0.5) / 2.0**53) / weight(child)
        if best is None or draw >= best[0]:
            best = (draw, name, child)
    _, name, child = best
    return name if isinstance(child, int) else shard(key, child, f"{path}/{name}")


def test_sharding_query(spark, tmp_path):
    rows = brute.tricky_docs() + [(k, "t", None, None, 1, *["x"] * len(brute.CLASHES)) for k in range(-500, 3000, 7)]
    spark.createDataFrame(rows, brute.SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_sharding(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    eight, nine = sharding.even_tree(8), sharding.even_tree(9)
    assert {r.shard for r in got} == set(range(8)) and 8 in {r.grown_shard for r in got}
    for r in got:
        assert (r.shard, r.grown_shard) == (shard(r.doc_id, eight), shard(r.doc_id, nine))
    uneven = {"a": {"r": {0: 3, 1: 0, 2: 1}}, "b": {"s": {3: 2}, "t": {4: 0}, "u": {5: 5, 6: 1}}}
    keys = spark.createDataFrame([(r[0],) for r in rows], "key long")
    for r in keys.select("key", sharding.shard_of(keys.key, uneven).alias("shard")).collect():
        assert r.shard == shard(r.key, uneven)


def kept_texts(pages: list[tuple[int, str, list[tuple[bool, str]]]]) -> dict[int, str]:
    """Main texts of pages that mark no article, given as (teaser in an aside, text) blocks.

    Every window and every short block is looked for in every page of its host, one by one.
    """

    def runs(blocks):
        found, run = [], []
        for teaser, text in [*blocks, (True, "")]:
            if teaser:
                found.append(run)
                run = []
            else:
                run = run + text.split()
        return found

    out = {}
    for page, host, blocks in pages:
        texts = {tuple(others): others for _, other, others in pages if other == host}
        least = max(extract.MIN_PAGES, extract.PAGE_SHARE * len(texts))
        kept, run, before = [], runs(blocks), [text.split() for teaser, text in blocks if not teaser]
        covered = []
        for words in run:
            marks = [False] * len(words)
            for i in range(len(words) - extract.LONG_WORDS + 1):
                window = words[i : i + extract.LONG_WORDS]
                having = sum(
                    any(
                        other[j : j + len(window)] == window
                        for other in runs(others)
                        for j in range(len(other) - len(window) + 1)
                    )
                    for others in texts.values()
                )
                if having >= least:
                    marks[i : i + extract.LONG_WORDS] = [True] * extract.LONG_WORDS
            covered += marks
        at = 0
        for words in before:
            having = sum(any(not t and text.split() == words for t, text in others) for others in texts.values())
            whole = extract.RUN_WORDS <= len(words) < extract.LONG_WORDS and having >= least
            left = [w for k, w in enumerate(words, at) if not (whole or covered[k])]
            at += len(words)
            if left:
                kept.append(" ".join(left))
        out[page] = "\n".join(kept)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_extraction_of_unmarked_pages(spark, tmp_path, seed):
    rng = random.Random(seed)
    sentences = [" ".join(rng.choices("abcdef", k=rng.choice([2, 5, 7, 9, 10, 12, 16]))) for _ in range(14)]
    pages = []
    for page in range(60):
        blocks = []
        for _ in range(rng.randint(1, 6)):
            text = rng.choice(sentences)
            if rng.random() < 0.5:
                text = f"{text} {' '.join(rng.choices('uvwxyz', k=rng.randint(1, 6)))}"
            blocks.append((rng.random() < 0.15, text))
        # So every page takes part among its host's texts.
        blocks.append((False, " ".join(f"n{page}x{k}" for k in range(12))))
        pages.append((page, rng.choice(["one", "one", "two", "three"]), blocks))
    pages += [(100 + k, pages[k][1], pages[k][2]) for k in range(5)]
    rows = [
        (
            page,
            f"http://{host}/p{page}",
            "".join(f"<aside><article>{t}</article></aside>" if teaser else f"<p>{t}</p>" for teaser, t in blocks),
        )
        for page, host, blocks in pages
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.text for r in queries.op8_extract(spark, str(tmp_path)).collect()}
    want = kept_texts(pages)
    assert got == want
    assert sum(len(t.split()) for t in want.values()) < sum(len(t.split()) for _, _, b in pages for _, t in b)
