"""Golden cases of two-arm evaluation, grading, fusion and merging."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import scores
from corpusloom.operators import evaluation as ev
from corpusloom.operators import fusion, matching, rankings


def test_arm_scores_are_means_of_means(spark):
    items = spark.createDataFrame(
        [("t", "m", "u", 1, "a", 1.0, 1.0), ("t", "m", "u", 1, "b", 0.0, 1.0), ("t", "m", "u", 2, "a", 1.0, 1.0), ("t", "m", "u", 2, "b", 1.0, 1.0), ("t", "m", "a", 1, "z", 1.0, 1.0), ("t", "m", "a", 1, "c", 1.0, 0.0)],
        "task string, model string, arm string, run int, item string, score double, most double",
    )
    (row,) = ev.arm_scores(items, spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "b")], "task string, item string")).collect()
    assert (row.u, row.a) == (0.75, None)


@pytest.mark.parametrize("u, a, state", [(0.9, 0.95, "internalized"), (0.1, 0.9, "skill works"), (0.0, 0.0, "uncovered"), (0.8, 0.1, "skill hurts"), (0.5, 0.6, "between thresholds")])
def test_states(spark, u, a, state):
    assert spark.range(1).select(ev.state(F.lit(u), F.lit(a)).alias("x")).first().x == state


def test_decisions(spark):
    cases = [
        (1.0, 0.3, None, 3, False, "retire"), (1.0, 0.05, None, 3, False, "regenerate"), (1.0, None, None, 3, True, "keep_no_verdict"), (0.7, 0.3, None, 1, False, "extra_tasks"),
        (1.0, 0.3, None, 1, False, "extra_tasks"), (0.7, 0.3, None, 3, False, "keep"), (0.1, 0.3, None, 1, False, "measure_aided"), (0.1, 0.3, 0.2, 1, False, "keep_repair"), (0.1, 0.3, 0.9, 1, False, "keep"),
    ]
    rows = spark.createDataFrame(cases, "u double, gain double, a double, n int, again boolean, want string")
    got = rows.select("want", ev.verdict(F.col("u"), F.col("gain"), F.col("a"), F.col("n"), F.col("again")).alias("x")).collect()
    assert [r.x for r in got] == [r.want for r in got]


def test_audit_of_rules(spark):
    pairs = spark.createDataFrame([(0.0, 0.0), (0.05, 0.1), (1.0, 1.0), (0.9, 0.95), (0.1, 0.9)], "u double, a double")
    table = {r.rule: r for r in ev.audit(pairs).collect()}
    assert table["|gain| < 0.10"].uncovered_removed == 1.0
    assert (table["U >= 0.8"].uncovered_removed, table["U >= 0.8"].internalized_removed) == (0.0, 1.0)


def test_skill_names(spark):
    assert spark.range(1).select(ev.skill_of(F.lit("tessl-single-owner_repo_my-skill_12")).alias("x")).first().x == "owner_repo_my-skill"


def test_grades(spark):
    grade = lambda a, j: spark.range(1).select(ev.hybrid_grade(F.lit(a), F.lit(j), F.lit(0.5), F.lit(0.5)).alias("x")).first().x
    assert grade(0.74, 1.0).score == pytest.approx(0.37) and grade(0.75, 1.0).score == pytest.approx(0.875)
    rows = spark.createDataFrame(
        [(t, s, m) for t, met in (("a", [1, 1, 1, 0]), ("b", [1, 1, 1, 1]), ("c", [1, None, 1, 1])) for s, m in zip([2.0, 3.0, 1.0, -2.0], met)], "task string, score double, met int"
    )
    assert {r.task: r.reward for r in ev.rubric_reward(rows, "task").collect()} == {"a": 1.0, "b": pytest.approx(0.666666667), "c": None}
    one = spark.range(1).select(scores.pass_at_k(F.lit(3), F.lit(1), F.lit(2)).alias("x"), scores.pass_hat_k(F.lit(3), F.lit(1), F.lit(2)).alias("y")).first()
    assert (one.x, one.y) == (pytest.approx(2 / 3), 0.0)


def test_weighted_fusion(spark):
    hits = spark.createDataFrame(
        [("q", "local", 1, 1.0, 1, "x", "local/x"), ("q", "local", 1, 1.0, 3, "y", "local/y"), ("q", "hub", 2, 0.5, 1, "x", "hub/x"), ("q", "hub", 2, 2.0, 1, "y", "hub/y")],
        "query string, source string, source_order int, weight double, rank int, key string, item string",
    )
    got = {r.key: r for r in fusion.weighted_rrf(hits, "query", "key", "item", 5).collect()}
    assert got["x"].rrf == pytest.approx(1 / 61 + 0.5 / 61) and got["x"].sources == "local,hub" and got["x"].item == "local/x"
    assert got["y"].item == "hub/y"


def test_metrics_of_a_request_without_hits(spark):
    asked = spark.createDataFrame([("a",), ("b",)], "q string")
    ranked = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "q string, d int, rank int")
    gold = spark.createDataFrame([("a", 2, 1.0), ("a", 2, 1.0), ("b", 9, 1.0)], "q string, d int, gain double")
    got = {r.q: r for r in rankings.per_request(asked, ranked, gold, "q", "d").collect()}
    assert (got["a"].mrr_10, got["a"].recall_10, got["a"].hit_1, got["b"].mrr_10) == (0.5, 1.0, 0.0, 0.0)
    assert got["a"].ndcg_3 == pytest.approx(0.630929754)


def test_greedy_merge_like_a_loop(spark):
    import random

    random.seed(5)
    pairs = {}
    while len(pairs) < 120:
        a, b = sorted(random.sample(range(40), 2))
        pairs[a, b] = (round(random.random(), 2), random.choice([a, b]))
    dead, want = set(), set()
    for (a, b), (cos, winner) in sorted(pairs.items(), key=lambda x: (-x[1][0], x[0])):
        if a not in dead and b not in dead:
            loser = b if winner == a else a
            dead.add(loser)
            want.add((loser, winner))
    rows = spark.createDataFrame([(a, b, w, c) for (a, b), (c, w) in pairs.items()], "a int, b int, winner int, cos double")
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    assert {(r.loser, r.winner) for r in matching.greedy_merge(rows, [-F.col("cos")]).collect()} == want
    assert matching.greedy_merge(rows.limit(0), [-F.col("cos")]).count() == 0
