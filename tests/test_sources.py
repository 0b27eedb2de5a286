"""Reading documents and catalogues, writing the corpus, streams."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from corpusloom.sources import documents, sinks
from corpusloom.streaming import ingest


def test_skill_files(spark, tmp_path):
    for path in ("a/SKILL.md", "a/sub/SKILL.md", "b/skill.md", "b/SKILL.md", "workspaces/c/SKILL.md", "d/readme.md", "e/f/skill.md"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(b"x\xff")
    rows = documents.skill_files(spark, str(tmp_path)).collect()
    assert sorted(r.path.split(str(tmp_path))[1] for r in rows) == ["/a/SKILL.md", "/b/SKILL.md", "/e/f/skill.md"]
    assert rows[0].text == "x�"


def test_front_matter(spark):
    good = "---\nname: a\ntags: [x, y]\n---\nbody\n"
    texts = [good, "﻿" + good, good.replace("\n", "\r\n"), good.replace("\n", "\r"), "---\nname: [unclosed\n---\nb", "no mark", "---\nname: a\n", "---\n- a\n---\nb", None]
    rows = documents.front_matter(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t").orderBy("k").collect()
    assert all(json.loads(r.frontmatter) == {"name": "a", "tags": ["x", "y"]} and r.body == "body\n" and r.problem is None for r in rows[:4])
    assert [r.problem for r in rows[4:]] == ["invalid YAML", "no front matter", "front matter not closed", "front matter is no mapping", "no front matter"]


def test_naive_fields_and_links(spark):
    row = spark.range(1).select(
        documents.naive_fields(F.lit("a: 'x'\nb: \"y: z\"\nnothing\na: w")).alias("f"),
        documents.repository_links(F.lit("(https://github.com/o/r.) github.com/awesome/x github.com/o/r github.com/p/q.svg github.com/p/z")).alias("l"),
    ).first()
    assert row.f == {"a": "w", "b": "y: z"} and row.l == ["o/r"]


def test_agents(spark):
    rows = [("foo_bar", "foo_bar", "T", "d", ["x"], "role", None), ("foo.bar", "foo.bar", "T", None, None, "role", "hi"), ("foo_bar.de", "foo_bar", "D", "d", [], "rolle", None), ("empty", "empty", "T", "d", [], " ", None)]
    made = documents.agent_records(spark.createDataFrame(rows, "stem string, identifier string, title string, description string, tags array<string>, system_role string, opening_message string")).collect()
    names = sorted(r.name for r in made)
    assert len(names) == 2 and names[0] == "foo-bar" and names[1].startswith("foo-bar-") and len(names[1]) == 14
    assert all(r.text.startswith("---\nname: foo-bar") for r in made)


def test_archives_and_upserts(spark):
    entries = spark.createDataFrame([("a", 1, "x.md", 5), ("a", 2, "../up", 1), ("a", 3, "/abs", 1), ("b", 1, "big", 99), ("b", 2, "c", 2)], "archive string, position int, name string, size long")
    assert [r.name for r in sinks.safe_entries(entries, 50).collect()] == ["x.md"]
    old = spark.createDataFrame([("h", "d1", False)], "id string, dir string, enabled boolean")
    new = spark.createDataFrame([("h", "d2", True), ("i", "d3", True)], "id string, dir string, enabled boolean")
    assert {tuple(r) for r in sinks.upsert(old, new, "id", ["enabled"]).collect()} == {("h", "d2", False), ("i", "d3", True)}


def test_incremental_ingest_and_windows(spark, tmp_path):
    body = lambda c: c * 400
    feed, library = f"{tmp_path}/feed", f"{tmp_path}/library"
    put = lambda rows: spark.createDataFrame(rows, "skill_id string, body string").coalesce(1).write.mode("append").parquet(feed)
    run = lambda: ingest.ingest(ingest.read_stream(spark, feed, spark.read.parquet(feed).schema), library, f"{tmp_path}/state").awaitTermination()
    put([("b", body("x")), ("a", body("x")), ("c", "short"), ("d", body("y"))])
    run()
    put([("e", body("x") + " "), ("f", body("z"))])
    run()
    run()
    assert sorted(r.skill_id for r in spark.read.parquet(library).collect()) == ["a", "d", "f"]
    at = lambda m: datetime(2026, 1, 1, 0, m)
    left = spark.createDataFrame([(1, "u", at(5)), (2, "u", at(1)), (3, "v", at(5)), (4, "u", at(3))], "id int, k string, ts timestamp")
    right = spark.createDataFrame([("u", at(3), 1.0), ("u", at(4), 2.0), ("u", at(5), None)], "k string, ts timestamp, v double")
    assert {r.id: r.last_v for r in ingest.as_of(left, right, "k", "ts", "v").collect()} == {1: 2.0, 2: None, 3: None, 4: 1.0}
