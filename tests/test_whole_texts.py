"""Queries of search over whole texts: what only the end of a long body says is found."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import lexical
from corpusloom.plans.search_queries import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Sixty records; only the last words of a body of more than 8,000 characters (d55) answer q0."""
    at = tmp_path_factory.mktemp("tables")
    long = "filler words again " * 600 + "zebrafish genome"
    skills = [(f"d{i:02}", f"name{i:02}", "elsewhere" if i == 55 else f"about topic{i:02}", long if i == 55 else f"text of topic{i:02}", None, "c", "s", False, None) for i in range(60)]
    spark.createDataFrame(skills, "skill_id string, name string, description string, body string, tags string, category string, source string, deleted boolean, updated_at timestamp").write.parquet(f"{at}/skills.parquet")
    requests = [("q0", "d55", "c", "zebrafish genome"), *[(f"q{i:02}", f"d{i % 50:02}", "c", f"zebrafish topic{i % 50:02}") for i in range(1, 200)]]
    spark.createDataFrame(requests, "query_id string, skill_id string, category string, instruction_text string").write.parquet(f"{at}/match_queries.parquet")
    return str(at)


def test_hard_negatives(spark, folder):
    """The end of a body is a hit like any; every request has three others, among them every record."""
    rows = QUERIES["hard_negatives"](spark, folder).collect()
    assert QUERIES["hard_negatives"](spark, folder).exceptAll(spark.createDataFrame(rows)).count() == 0
    hard = {(r.query_id, r.skill_id) for r in rows if r.kind == "hard"}
    assert hard == {(f"q{i:02}", "d55") for i in range(1, 200)}
    drawn = [(r.query_id, r.skill_id) for r in rows if r.kind == "random"]
    assert len(drawn) == len(set(drawn)) == 3 * 200 and not hard & set(drawn)
    assert not {(f"q{i:02}", f"d{i % 50:02}") for i in range(1, 200)} & set(drawn) and ("q0", "d55") not in drawn
    assert {d for _, d in drawn} == {f"d{i:02}" for i in range(60)} - {"d55"}


@pytest.mark.parametrize("n,want", [(1, 0), (2, 1), (4, 3), (5, 4), (9, 4)])
def test_others_are_all_that_is_left_where_few_are(spark, n, want):
    docs = spark.range(n).select(F.format_string("d%02d", "id").alias("d"), F.when(F.col("id") == 0, "w").otherwise("v").alias("t"))
    words = F.array("t")
    rows = lexical.bm25(spark.createDataFrame([("q", "w")], "q string, t string"), "q", words, docs, "d", words, 3, others=4).collect()
    assert sorted(r.d for r in rows if r.other is None) == ["d00"]
    assert sorted(r.other for r in rows if r.other is not None) == list(range(1, want + 1)) and len({r.d for r in rows}) == want + 1


def test_bm25_lexical_top10(spark, folder):
    best = QUERIES["bm25_lexical_top10"](spark, folder).filter("query_id = 'q0' AND score > 0").collect()
    assert [(r.skill_id, r["rank"]) for r in best] == [("d55", 1)]


def test_ir_metrics(spark, folder):
    row = QUERIES["ir_metrics"](spark, folder).filter("query_id = 'q0'").first()
    assert (row.hit_1, row.mrr_10, row.recall_50) == (1.0, 1.0, 1.0)


def test_macro_mrr(spark, folder):
    """One category: the mean of the requests, the one that only the end of a body answers included."""
    asked = QUERIES["ir_metrics"](spark, folder).agg(F.round(100 * F.avg("recall_10"), 2), F.round(100 * F.avg("mrr_10"), 2), F.round(100 * F.avg("hit_1"), 2)).first()
    assert tuple(QUERIES["macro_mrr"](spark, folder).first()) == (1, *asked) and asked[0] == 100.0


def test_rank_fusion(spark, folder):
    assert QUERIES["rank_fusion"](spark, folder).filter("query_id = 'q0' AND rank = 1").first().skill_id == "d55"


def test_score_fusion(spark, folder):
    assert QUERIES["score_fusion"](spark, folder).filter("query_id = 'q0' AND rank = 1").first().skill_id == "d55"


def test_weighted_rrf(spark, folder):
    got = QUERIES["weighted_rrf"](spark, folder).filter("query_id = 'q0'").collect()
    assert [(r.item, r.sources, r["rank"]) for r in got] == [("d55", "local", 1)]


def test_reranker_candidates(spark, folder):
    """A record that answers by the end of its body is a candidate of the other requests."""
    got = QUERIES["reranker_candidates"](spark, folder).filter("query_id = 'q07'").collect()
    assert sorted((r.place, r.skill_id, r.positive) for r in got) == [(0, "d07", True), (1, "d55", False)]
