"""The language stage on planted texts of no known language."""

from __future__ import annotations

import base64
import os
import random

import pytest
from pyspark.sql import functions as F

from docgate.llm import language

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
JUNK = [
    "Это простой текст на русском языке, который не относится к известным языкам.",
    "これは日本語の簡単な文章です。知られている言語ではありません。",
    base64.b64encode(random.Random(1).randbytes(300)).decode(),
    "for (int i = 0; i < n; ++i) { sum += a[i] * b[i]; } /* fn */ std::vector<int> v{1,2,3};",
    "asdkjfh qwkejrh zxmcnbv lkjhasdf poiqwer mnbzxcv qpwoei rutyal skdjfh gzmxnc bvqwop",
]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_stage_rejects_foreign_and_junk_texts_and_keeps_short_ones(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    held = docs.where(language.in_holdout(F.col("doc_id")) & (F.length("text") > 200)).limit(40).collect()
    # The ids of planted rows are in the holdout or without a label, so nothing is learnt from them.
    short = [(-100 - i, r.text.partition(" ")[2][:50], None) for i, r in enumerate(held)]
    junk = [(-1 - i, text, None) for i, text in enumerate(JUNK)]
    planted = spark.createDataFrame(short + junk, docs.schema)
    learnt = docs.where(~language.in_holdout(F.col("doc_id")))
    got = {r.doc_id for r in language.keep_known(learnt.union(planted)).collect()}
    assert not got & {r[0] for r in junk}
    assert len(short) > 10 and {r[0] for r in short} <= got
