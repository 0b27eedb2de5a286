"""Golden cases of the text functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import licences, replies, text


def value(spark, column, **given):
    frame = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given))
    return frame.select(column.alias("x")).first().x


@pytest.mark.parametrize("name", ["react-hooks", "React Hooks", "react_hooks", "React.Hooks!!", "react/hooks", "REACT@HOOKS"])
def test_canonical_names(spark, name):
    assert value(spark, text.canonical_name("n"), n=name) == "react hooks"


@pytest.mark.parametrize(
    "given, tokens",
    [("季度进展", ["季度", "度进", "进展"]), ("做个 PPT 讲下季度进展", ["做个", "ppt", "讲下", "下季", "季度", "度进", "进展"]), ("图", ["图"]), ("a", []), ("ab", ["ab"]), (None, [])],
)
def test_bigram_tokens(spark, given, tokens):
    assert value(spark, text.bigram_tokens("t"), t=given) == tokens


def test_query_terms_and_guard(spark):
    assert value(spark, text.query_terms("q"), q="Please deploy this to K8s") == ["deploy", "kubernetes"]
    assert value(spark, text.query_terms("q"), q="kubernetes deployment") == ["kubernetes", "deployment"]
    guard = lambda q, t: value(spark, text.relevance("q", F.col("t")), q=q, t=t).passed
    assert not guard("zqxjkv no such task 93847", "get-task tasks")
    assert guard("帮我提取PDF表格", "PDF 表格提取")


@pytest.mark.parametrize("field, name", [("MIT License", "MIT"), ("apache 2", "Apache-2.0"), ("LGPL v3", "LGPL-3.0"), ("Unlicensed", "Unlicense"), ("BSD License", None), ("LICENSE.txt", None), (None, None)])
def test_licences(spark, field, name):
    assert value(spark, licences.licence_id(F.col("l")), l=field) == name


def test_directories(spark):
    for slug, made in (("pdf-tables", "hub__pdf-tables__987ad8e8"), ("中文技能", "hub________dc2b95ad"), ("../../etc", "hub__.._.._etc__58e5dd88")):
        assert value(spark, text.safe_dir(F.lit("hub"), "s"), s=slug) == made


def test_judgements(spark):
    unsafe = lambda raw: value(spark, replies.unsafe(F.col("r"), ["cmd_injection"]), r=raw)
    assert [unsafe(x) for x in ('{"safety": 9}', '{"safety": 1}', '{"safety": 9, "flags": ["cmd_injection"]}', '{"flags": ["placeholder"]}', '{"safety": true}', "{", None, "[1]")] == [
        False, True, True, False, False, False, False, False,
    ]
    sub = value(spark, replies.subscores(F.col("r")), r='{"utility": 12.7, "safety": true, "flags": ["a"]}')
    assert (sub.utility, sub.robustness, sub.safety, sub.flags) == (10, None, 1, ["a"])


def test_verdict_lines(spark):
    reply = "VERDICT[0]: 1\nverdict [1] 0\nVERDICT[1]: 1"
    assert value(spark, replies.verdict_map(F.col("r"), F.lit(2)), r=reply) == {0: 1, 1: 1}
    assert value(spark, replies.verdict_map(F.col("r"), F.lit(3)), r=reply) is None


def test_times_without_offset_are_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        made = [value(spark, F.unix_seconds(replies.utc(F.col("r"))), r=x) for x in ("2026-01-01T00:00:00", "2026-01-01T00:00:00Z", "2026-01-01T01:00:00+01:00", "no time")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert made == [1767225600] * 3 + [None]


def test_grams(spark):
    made = lambda t, n: value(spark, text.grams(F.filter(F.split(F.col("t"), " "), lambda x: x != ""), n), t=t)
    assert made("a b c d", 3) == ["a b c", "b c d"] and made("a b a b", 2) == ["a b", "b a"] and made("a b", 3) == [] and made("", 2) == []
