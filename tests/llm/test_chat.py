"""Reply trees and the chat template."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docgate.llm import chat

TREE = "conv_id long, msg_id long, parent_id long, role string, text string, score double"


def texts_of(frame):
    out = frame.select(
        "conv_id",
        "leaf_id",
        "branch",
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.learnt_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"),
    )
    return {(r.conv_id, r.branch): r for r in out.collect()}


def test_best_branches_of_a_tree(spark):
    rows = [
        (1, 1, None, "system", "s", 0.0),
        (1, 2, 1, "user", "u", 1.0),
        (1, 3, 2, "assistant", "good", 5.0),
        (1, 4, 2, "assistant", "bad", -1.0),
        (1, 5, 3, "user", "more", None),
        (1, 6, 4, "user", "same score", 6.0),
        (2, 1, 99, "user", "orphan", 0.0),
        (None, 1, None, "user", "no conversation", 0.0),
        (3, 1, 2, "user", "cycle", 0.0),
        (3, 2, 1, "user", "cycle", 0.0),
    ]
    got = texts_of(chat.format_paths(spark.createDataFrame(rows, TREE), branches=2))
    assert set(got) == {(1, 1), (1, 2), (2, 1), (None, 1)}
    assert [t.text for t in got[1, 1].turns] == ["s", "u", "good", "more"]
    assert [t.text for t in got[1, 2].turns] == ["s", "u", "bad", "same score"]
    assert (got[1, 1].leaf_id, got[1, 2].leaf_id) == (5, 6)
    assert [t.role for t in got[1, 1].turns] == ["system", "user", "assistant", "user"]
    assert got[1, 1].learnt == "good"


def test_long_chains_and_tricky_rows(spark):
    rows = [(7, t, ["user", "assistant"][t % 2], f"turn {t} </s>") for t in range(70)]
    rows += [(8, 5, None, None), (8, 5, "", "tie"), (8, -3, "tool [INST]\n%", "x" * 200_000), (8, None, "assistant", "")]
    rows += [(None, 1, "assistant", "a"), (9, 1, "assistant", "same"), (9, 1, "assistant", "same")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("msg_id", F.lit("clash")).withColumn("place", F.lit("clash"))
    got = texts_of(chat.format_paths(chat.chain(frame)))
    assert [(t.role, t.text) for t in got[7, 1].turns] == [(r[2], r[3]) for r in rows[:70]]
    assert got[7, 1].learnt == "".join(r[3] for r in rows[:70] if r[2] == "assistant")
    assert [(t.role, t.text) for t in got[8, 1].turns] == [
        ("assistant", ""), ("tool [INST]\n%", "x" * 200_000), ("", ""), ("", "tie"),
    ]
    assert len(got[9, 1].turns) == 2 and got[9, 1].learnt == "samesame"
    assert got[None, 1].learnt == "a"
    assert chat.format_paths(chat.chain(frame.limit(0))).count() == 0


pieces = st.lists(
    st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST] ", " [/INST]", "<s>", "\n", "a", "é", " ", "$1"]),
    max_size=12,
).map("".join)


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(pieces, min_size=30, max_size=30))
def test_any_text_reads_back(spark, texts):
    rows = [(i // 3, i % 3, ["user", "assistant", "a\n[/INST]"][i % 3], t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = texts_of(chat.format_paths(chat.chain(frame)))
    for (conv, _), r in got.items():
        mine = [x for x in rows if x[0] == conv]
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in mine]
        assert r.learnt == mine[1][3]
        assert r.formatted.count("[/INST]") == 2 and r.formatted.count("</s>") == 1


@pytest.mark.parametrize("text", ["</s>", "[INST] ok [/INST]", "<\\s>", "[\\\\/INST]", "<s", "plain"])
def test_escape_is_undone(spark, text):
    row = spark.range(1).select(chat.escape(F.lit(text)).alias("x")).select("x", chat.unescape(F.col("x")).alias("y"))
    out = row.first()
    assert out.y == text
    assert not any(c in out.x for c in ("<s>", "</s>", "[INST]", "[/INST]"))
