"""Language, quality and extraction against plain Python and held-out rows."""

from __future__ import annotations

import math
import os
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docgate.llm import extract, language, quality
from docgate.llm.queries import op6_language
from tests.llm import brute

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.tricky_docs(), brute.SCHEMA).repartition(5).cache()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = op6_language(spark, SF_DIR).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and len(held) > 20
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_tricky_texts(docs):
    model = language.fit(docs.where("lang is not null"), sample=50, landmarks=20)
    assert model.languages == ["en", "fr"]
    got = language.identify(docs, model)
    assert [c for c in got.columns if c != "lang_pred"] == [
        c for c in [*docs.columns, "lang_score"] if c != "lang_pred"
    ]
    for r in got.collect():
        letters = r.text is not None and any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == (not letters)
        assert 0 <= r.lang_score <= 1
    again = language.fit(docs.where("lang is not null").repartition(2), sample=50, landmarks=20)
    assert (again.weights == model.weights).all()


def test_language_without_rows_or_labels(docs):
    none = language.fit(docs.limit(0))
    assert none.languages == []
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), none).count() == 0
    kept = language.keep_known(docs.withColumn("lang", F.lit(None).cast("string")))
    assert kept.count() == sum(
        1 for r in brute.tricky_docs() if r[1] is not None and any(map(str.isalpha, r[1]))
    )


def test_language_stage_keeps_columns_and_clean_rows(docs):
    kept = language.keep_known(docs)
    assert kept.dtypes == docs.dtypes
    assert {r.doc_id for r in kept.collect()} >= {r[0] for r in brute.tricky_docs() if (r[0] or 0) >= 100 and len(r[1]) > 40}


def histograms(text: str, lang: str | None):
    kinds = [unicodedata.category(c) for c in text]
    classes = [kinds.count("Ll"), kinds.count("Lu"), sum(k[0] == "N" for k in kinds)]
    classes += [len(re.findall(p, text)) for p in (r"[.,;:!?'\"()\-]", r"[#*$%&|<>@^_~=+/\\{}\[\]]")]
    common = quality.COMMON_WORDS.get(lang) or sorted({w for x in quality.COMMON_WORDS.values() for w in x})
    some = Counter(re.findall(r"[^\x20\x09-\x0D]+", text))
    listed = [some[w] for w in common]
    return classes, [*listed, sum(some.values()) - sum(listed)]


def distance(p, q):
    if not sum(p) or not sum(q):
        return 0.0
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    total = 0.0
    for x, y in zip(p, q, strict=True):
        m = (x + y) / 2
        total += (x * math.log2(x / m) if x else 0) / 2 + (y * math.log2(y / m) if y else 0) / 2
    return math.sqrt(max(0.0, total))


def test_quality_counts(docs):
    expected = Counter((r[0], *brute.quality_counts(r[1])) for r in brute.tricky_docs())
    got = quality.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_quality_verdicts(spark):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = {r.doc_id: r for r in frame.collect()}
    got = quality.judge(frame).collect()
    held = {i: histograms(d.text, d.lang) for i, d in docs.items()}

    def judged(trusted):
        sums = {}
        for r in got:
            if r.doc_id in trusted:
                for k in (0, 1):
                    own = sums.setdefault((r.reference, k), [0] * len(held[r.doc_id][k]))
                    own[:] = [a + b for a, b in zip(own, held[r.doc_id][k], strict=True)]
        return {
            r.doc_id: tuple(distance(held[r.doc_id][k], sums.get((r.reference, k), [])) for k in (0, 1))
            for r in got
        }

    def good(found):
        return {
            r.doc_id
            for r in got
            if not r.base_failed
            and found[r.doc_id][0] <= quality.MAX_CHAR_DISTANCE
            and (
                found[r.doc_id][1] <= quality.MAX_WORD_DISTANCE
                or r.n_words < quality.GUARD_WORDS
                or r.reference == quality.POOLED
            )
        }

    final = judged(good(judged({r.doc_id for r in got if not r.base_failed})))
    for r in got:
        assert r.char_distance == pytest.approx(final[r.doc_id][0], abs=1e-9)
        assert r.word_distance == pytest.approx(final[r.doc_id][1], abs=1e-9)
    assert {r.doc_id for r in got if r.kept} == good(final)


def test_quality_of_empty_table(docs):
    assert quality.judge(docs.limit(0)).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>No &amp;</title><style>p{}</style></head><body><header>Site</header>"
    "<div class='cookie-notice'>We use cookies</div><nav><ul><li>a<li>b</ul></nav><main><article class=post>"
    "<header><h1>T &amp; t</h1></header><p>One<br>two &nbsp; x<p>Three <script>var x='</p>'</script>four"
    "<aside>side</aside><div class='ad-slot'>buy<div>more</div></div><ul><li>i1<li>i2</ul>"
    "<form><button>go</button></form><!-- <p>no</p> --><section id=\"comments\"><p>nice</p></section>"
    "</article></main><footer>f</footer></body></html>"
)


def test_marked_articles(spark):
    plain = "<body><div id=menu>Home News About us all</div><p>{0} own text here</p><p>Sign up for our weekly letter now</p>"
    rows = [(1, "http://h/1", PAGE), (1, "http://h/1", PAGE), (2, None, None), (None, "http://h/x", ""), (3, "x", "no tags &lt; at all")]
    rows += [(10 + i, f"https://boiler.example/{i}", plain.format(f"alpha{i} beta{i}")) for i in range(4)]
    rows += [(20, "https://other.example/", plain.format("Alone"))]
    rows += [(30 + i, "http://copy/", f"<article><p>The very same words of text again</p></article><p>x{i}</p>") for i in range(5)]
    rows += [(40, "u", "<p>" + "w " * 100_000), (41, "u", "<article></article><p>Fallback"), (42, "u", "<script>open"), (43, "u", "a < b <i>c</i><"), (44, "u", "<p>x <a " + "y " * 20_000)]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, key string, text string")
    got = extract.main_text(frame.repartition(3)).collect()
    texts = brute.group_by(got, lambda r: r.page_id)
    assert len(got) == len(rows)
    assert [r.text for r in texts[1]] == ["T & t\nOne two x\nThree four\ni1\ni2"] * 2
    assert texts[2][0].text == texts[None][0].text == texts[42][0].text == ""
    assert texts[3][0].text == "no tags < at all"
    # "own text here" goes on into the repeated line, so both are one run.
    assert [texts[10 + i][0].text for i in range(4)] == [f"alpha{i} beta{i}" for i in range(4)]
    assert texts[20][0].text == "Alone own text here\nSign up for our weekly letter now"
    assert {texts[30 + i][0].text for i in range(5)} == {"The very same words of text again"}
    assert texts[40][0].n_chars == 199_999
    assert texts[41][0].text == "Fallback"
    assert texts[43][0].text == "a < b c<"
    assert texts[44][0].text.startswith("x <a y y")
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract.main_text(frame.limit(0)).count() == 0
