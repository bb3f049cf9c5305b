from __future__ import annotations

import base64
import json
import re
from datetime import date, datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docgate.plans.batch import batch_view
from docgate.schemas import RECORD_FIELDS
from docgate.sinks.ndjson import write_ndjson
from docgate.sources import ndjson
from docgate.sources.ndjson import (
    malformed_lines,
    parse_lines,
    read_ndjson,
    read_ndjson_day,
    store_lines,
    well_formed,
    with_line_ordinal,
)
from docgate.sources.payloads import decode_payloads
from docgate.sources.prompts import builtin_prompts, load_prompt, prompts_from_dir
from tests.helpers import lines, record, write_lines


def test_scan_is_recursive_and_skips_only_empty_lines(spark, tmp_path):
    write_lines(tmp_path / "b/2024/01/01", "a.ndjson", ['{"pages":1}', "", '{"pages":2}', "  "])
    write_lines(tmp_path / "b/2024/01/02", "b.ndjson", ['{"pages":3}'])
    rows = read_ndjson(spark, str(tmp_path / "b")).orderBy("source_key", "source_seq").collect()
    assert [r["value"] for r in rows] == ['{"pages":1}', '{"pages":2}', "  ", '{"pages":3}']
    assert {r["source_bucket"] for r in rows} == {"b"}
    assert rows[0]["source_key"] == "2024/01/01/a.ndjson"


def test_day_scan(spark, tmp_path):
    write_lines(tmp_path / "p/2024/01/01", "a.ndjson", ['{"pages":1}'])
    write_lines(tmp_path / "p/2024/01/02", "a.ndjson", ['{"pages":2}'])
    day = read_ndjson_day(spark, str(tmp_path), "p/", date(2024, 1, 2))
    assert [r["value"] for r in day.collect()] == ['{"pages":2}']
    assert read_ndjson_day(spark, str(tmp_path), "p", date(2024, 1, 3)).collect() == []


def test_ordinals_survive_other_splits(spark, tmp_path):
    """Numbered with many splits, read with few: no line is lost and none gets another number."""
    write_lines(tmp_path / "r", "big.ndjson", [json.dumps({"n": i, "pad": "x" * (i % 97)}) for i in range(5_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = with_line_ordinal(read_ndjson(spark, str(tmp_path / "r")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        rows = numbered.select(F.get_json_object("value", "$.n").cast("int").alias("n"), "line_ordinal")
        assert {tuple(r) for r in rows.collect()} == {(i, i + 1) for i in range(5_000)}
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_no_shuffle_carries_the_lines(spark, tmp_path):
    """Neither numbering nor the gate's rows nor a wave's share shuffles text; a wave reads its folder."""
    write_lines(tmp_path / "r", "a.ndjson", [json.dumps({"n": i}) for i in range(500)])
    lines = store_lines(read_ndjson(spark, str(tmp_path / "r")), waves=4)
    numbered = with_line_ordinal(lines, stored=True)
    share = numbered.where(F.col("wave") == 2)
    for frame in (numbered, batch_view(lines), parse_lines(share)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        # The running sum over splits is the only one.
        assert "SortMergeJoin" not in plan
        assert len(re.findall(r"\bExchange (?:hash|range|round)", plan)) <= plan.count("Window")
    assert {r.wave for r in share.collect()} == {2}
    plan = share._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*wave#\d+ = 2", plan)
    assert sum(numbered.where(F.col("wave") == k).count() for k in range(4)) == 500
    assert store_lines(lines.limit(0).drop("wave")).count() == 0


def test_line_ordinals_across_splits(spark, tmp_path):
    """One big file read in many splits next to a small one; empty lines have no number."""
    texts = []
    for i in range(5_000):
        texts.append(json.dumps({"n": i, "pad": "x" * (i % 97)}))
        if i % 7 == 0:
            texts.append("")
    write_lines(tmp_path / "r", "big.ndjson", texts)
    write_lines(tmp_path / "r", "small.ndjson", ['{"n":0}', '{"n":1}'])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = with_line_ordinal(read_ndjson(spark, str(tmp_path / "r")))
        assert numbered.select("source_block").distinct().count() > 5
        wrong = numbered.where(F.get_json_object("value", "$.n").cast("int") + 1 != F.col("line_ordinal"))
        assert wrong.count() == 0
        assert numbered.count() == 5_002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_splits_are_stored_in_few_files(spark, tmp_path):
    """Splits of 2,000 bytes: each has its own position, but no task and no file of its own."""
    write_lines(tmp_path / "r", "a.ndjson", [json.dumps({"n": i, "pad": "x" * 90}) for i in range(4_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        stored = store_lines(read_ndjson(spark, str(tmp_path / "r")), str(tmp_path / "stored"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert stored.select("source_block").distinct().count() > 100
    assert len(list((tmp_path / "stored").rglob("*.parquet"))) <= spark.sparkContext.defaultParallelism
    right = F.get_json_object("value", "$.n").cast("int") + 1 == F.col("line_ordinal")
    assert with_line_ordinal(stored, stored=True).where(right).count() == 4_000


BAD = [
    "not json",
    "   ",
    "[]",
    "3",
    "null",
    '"text"',
    '{"pages":1',
    '{"pages":1} x',
    '{"pages":1}{"pages":2}',
    '{"pages":1},',
    '{"pages":1},"agency":"x"',
    "{'pages':1}",
    '{"pages":NaN}',
    '{"pages":01}',
    '{"pages":1,}',
    '{"pages":"a\tb"}',
]
GOOD = ['{"pages":1}', ' {"pages":1} ', "{}", '{"a":{"b":[1,{"c":null}]}}', '{"pages":1,"pages":2}']


def test_malformed_lines_are_told_apart(spark):
    parsed = parse_lines(lines(spark, BAD + GOOD)).orderBy("source_seq")
    assert [r["malformed"] for r in parsed.collect()] == [True] * len(BAD) + [False] * len(GOOD)
    assert malformed_lines(parsed).count() == len(BAD)
    assert well_formed(parsed).count() == len(GOOD)


ODD = [
    '{"pages":1,"agency":"a","agency":"b"}',
    '{"record_id":{"a":1,"a":2}}',
    '{"x":{"a":1,"a":2},"pages":3}',
    '{"pages":1}]',
    '{"pages":1},"#end"]',
    '{"pages":1},"#end"] junk',
    '{"#end":1,"pages":2}',
    '{"pages":1e400}',
    '{"pages":1234567890123456789012345678901234567890123}',
    '{"pages":null,"agency":"\\ud83d\\ude00","":1,"$[0]":1,"a.b":2}',
    '{"flags":["a",null,{"b":1}],"Pages":1,"_corrupt":1}',
    '{"pages":' + "[" * 600 + "]" * 600 + "}",
    '{"pages":1 /* */}',
    '{"a":"b"}{',
    "",
    None,
]


def test_one_parse_reads_like_the_parse_by_field(spark):
    rows = lines(spark, BAD + GOOD).select("value").union(
        spark.createDataFrame([(text,) for text in ODD], "value string")
    )
    text = F.col("value")
    by_field = rows.withColumns(ndjson._by_field(text)).withColumn("malformed", ndjson._malformed(text))

    def seen(parsed):
        fields = [F.to_json(F.col(f"raw.{name}")).alias(name) for name in RECORD_FIELDS]
        row = F.when(~F.col("malformed"), F.struct(F.array_sort("keys").alias("keys"), *fields))
        return {r["value"]: r["row"] for r in parsed.select("value", row.alias("row")).collect()}

    got, want = seen(parse_lines(rows)), seen(by_field)
    assert got == want
    assert sum(row is not None for row in got.values()) > len(GOOD) + 4


def test_bytes_that_are_no_text_are_malformed(spark, tmp_path):
    (tmp_path / "a.ndjson").write_bytes(b'{"agency":"\xff"}\n{"pages":1}\n')
    parsed = parse_lines(read_ndjson(spark, str(tmp_path)))
    assert sorted(r["malformed"] for r in parsed.collect()) == [False, True]


def test_strict_read_names_the_file(spark):
    with pytest.raises(PySparkException, match="not a JSON object: line in a.ndjson"):
        well_formed(parse_lines(lines(spark, ["nope"])), strict=True).collect()


def test_payloads(spark):
    text = json.dumps(record())
    encoded = base64.b64encode(text.encode()).decode()
    rows = [(1, encoded), (2, "%%%"), (3, base64.b64encode(b"nope").decode()), (4, text), (5, None)]
    decoded = decode_payloads(spark.createDataFrame(rows, "sequence INT, data STRING"))
    got = {r["sequence"]: (r["malformed"], r["value"]) for r in decoded.collect()}
    assert got[1] == (False, text)
    assert [got[i] for i in (2, 3, 4, 5)] == [
        (True, "%%%"),
        (True, "nope"),
        (True, text),
        (True, None),
    ]
    raw = spark.createDataFrame([(1, bytearray(text.encode()))], "sequence INT, data BINARY")
    assert not decode_payloads(raw).head()["malformed"]


def test_written_ndjson_reads_back(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "b")], "n INT, s STRING")
    path = write_ndjson(rows, str(tmp_path), datetime(2024, 3, 5, 6, 7, 8, tzinfo=timezone.utc))
    assert path == f"{tmp_path}/2024/03/05/records_20240305T060708"
    back = read_ndjson_day(spark, str(tmp_path), "", date(2024, 3, 5))
    assert sorted(r["value"] for r in back.collect()) == ['{"n":1,"s":null}', '{"n":2,"s":"b"}']


def test_prompts(spark, tmp_path):
    import hashlib

    (tmp_path / "v1.txt").write_text(" \n　 Be strict.\nTwice. \n", encoding="utf-8")
    (tmp_path / "v2.txt").write_text("Be kind.", encoding="utf-8")
    table = prompts_from_dir(spark, str(tmp_path))
    text, digest = load_prompt(table, "v1")
    assert text == "Be strict.\nTwice."
    assert digest == hashlib.sha256(text.encode()).hexdigest()
    assert load_prompt(table, "v2")[1] != digest
    with pytest.raises(KeyError, match="v3"):
        load_prompt(table, "v3")
    assert len(load_prompt(builtin_prompts(spark))[1]) == 64


def test_prefixes_are_texts_and_odd_names_count(spark, tmp_path):
    for name in ("docs/2024-01/a", "docs/2024-01/_b", "docs/2024-02/.c", "docs/_d/e", "docs/2025/f", "docs2/g", "do[cs"):
        write_lines((tmp_path / name).parent, (tmp_path / name).name, ["{}", "{}"])
    root = str(tmp_path)

    def keys(prefix):
        return sorted({r["source_key"] for r in read_ndjson(spark, root, prefix).collect()})

    assert keys("docs/2024-0") == ["docs/2024-01/_b", "docs/2024-01/a", "docs/2024-02/.c"]
    assert keys("docs/") == ["docs/2024-01/_b", "docs/2024-01/a", "docs/2024-02/.c", "docs/2025/f", "docs/_d/e"]
    assert keys("docs") == [*keys("docs/"), "docs2/g"]
    assert keys("docs/_") == ["docs/_d/e"]
    assert keys("docs/2024-01/a") == ["docs/2024-01/a"]
    assert keys("do[") == ["do[cs"]
    assert len(keys("")) == 7
    assert keys("none") == []
    assert with_line_ordinal(read_ndjson(spark, root, "docs/2024-0")).count() == 6
