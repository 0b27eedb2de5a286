"""Caps against a plain ranking, with heaps of all sizes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.contributor_cap import beyond_cap

SCHEMA = "who string, score long, key string, _need string"


def expected(rows, cap):
    out, groups = [], {}
    for who, score, key, _ in rows:
        if key is not None:
            groups.setdefault(who, []).append((float("inf") if score is None else score, key))
    for own in groups.values():
        out += [k for _, k in sorted(own)[cap:]]
    return sorted(out)


@pytest.mark.parametrize("heap", [1_000_000, 4])
@pytest.mark.parametrize("cap", [7, 40])
def test_like_a_plain_ranking(spark, heap, cap):
    random.seed(3)
    # One contributor holds most rows, many of them tied; some have no contributor, score or key.
    rows = [(random.choice(["big", "big", "big", "a", None]), random.choice([None, 1, 2, 2, 2, -5, 1 << 40]), f"k{n:04d}", "x") for n in range(400)]
    rows += [("big", 1, None, "x")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = beyond_cap(frame, "who", [F.col("score")], "key", cap, heap=heap)
    assert got.columns == ["who", "score", "key", "_need"]
    assert sorted(r.key for r in got.collect()) == expected(rows, cap)


def test_empty_table_and_no_cap(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert beyond_cap(empty, "who", [F.col("score")], "key", 3).count() == 0
    one = spark.createDataFrame([("a", 1, "k", "x")], SCHEMA)
    assert beyond_cap(one, "who", [F.col("score")], "key", 0).count() == 1
    assert beyond_cap(one, "who", [F.col("score")], "key", 1).count() == 0
