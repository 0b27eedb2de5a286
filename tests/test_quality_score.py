"""Quality score: front matter and the gate of blocked skills."""

from __future__ import annotations

from datetime import datetime

from corpusloom.plans.corpus_queries import quality_score


def test_front_matter_counts_and_blocked_gives_zero(spark, tmp_path):
    cases = [
        ("bare", "{}", "[]"),
        ("broken", "{", "not a list"),
        ("two", '{"license": "MIT", "tags": ["a"], "name": "x"}', '["network.call"]'),
        ("many", '{"license": 1, "tags": 1, "version": 1, "risk": 1, "emoji": 1}', None),
        ("blocked", '{"license": "MIT"}', '["network.call", "blocked.malware"]'),
    ]
    rows = [(i, "s", "b" * 2000, "d" * 100, fm, i, flags, False, False, datetime(2026, 1, 1)) for i, fm, flags in cases]
    columns = "skill_id string, source string, body string, description string, frontmatter_raw string, content_hash string, safety_flags string, has_scripts boolean, has_references boolean, updated_at timestamp"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/skills.parquet")
    spark.createDataFrame([], "source string, source_weight double").write.parquet(f"{tmp_path}/source_registry.parquet")
    spark.createDataFrame([], "content_hash string, score double, judged_at string, subscores string").write.parquet(f"{tmp_path}/quality_judgments.parquet")
    got = {r.skill_id: r.quality for r in quality_score(spark, str(tmp_path)).collect()}
    # 0.85 * (0.5 + 0.1 + 0.05 + 0.05 * richness) + 0.15 * 0.5
    assert got == {"bare": 0.628, "broken": 0.628, "two": 0.649, "many": 0.67, "blocked": 0.0}
