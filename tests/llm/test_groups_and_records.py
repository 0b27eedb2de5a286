"""Groups of links, golden records, containers, cut texts: brute force and edge cases."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm.container_fill import fill_containers, pack
from corpusloom.llm.cut_texts import cut_texts, form_weights
from corpusloom.llm.golden_record import golden_record
from corpusloom.llm.link_groups import connected_groups, latest_verdicts


def test_groups_like_union_find(spark):
    random.seed(4)
    links = [(f"v{random.randrange(300):03d}", f"v{random.randrange(300):03d}") for _ in range(200)]
    links += [("hub", f"v{k:03d}") for k in range(0, 60)] + [("chain0", "chain1"), ("chain1", "chain2"), ("chain2", "chain3"), ("self", "self"), (None, "x"), ("hub", "v001")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a and a != b:
            root[find(a)] = find(b)
    groups = {}
    for v in root:
        groups.setdefault(find(v), []).append(v)
    want = {v: min(own) for own in groups.values() for v in own}
    frame = spark.createDataFrame(links, "a string, b string")
    assert {r.vertex: r.group_id for r in connected_groups(frame, "a", "b").collect()} == want
    assert connected_groups(frame.limit(0), "a", "b").count() == 0


def test_verdict_in_force(spark):
    x, y = "a" * 64, "b" * 64
    rows = [(f"{x}:{y}", 1, "2026-01-01T00:00:00"), (f" {y.upper()} : {x}", 0, "2026-01-01T02:00:00+01:00"), (f"{x}:{y}", None, "2027-01-01"), ("bad:key", 1, "2027-01-01"), (None, 1, None)]
    frame = spark.createDataFrame(rows, "pair_key string, is_duplicate int, judged_at string")
    (row,) = latest_verdicts(frame).collect()
    assert (row.hash_a, row.hash_b, row.is_duplicate) == (x, y, 0)


def test_votes_are_summed(spark):
    rows = [("g", "m1", "mit", 0.9), ("g", "m2", "apache", 0.5), ("g", "m3", "apache", 0.6), ("g", "m4", None, 5.0), ("h", "m5", None, 1.0), (None, "m6", "mit", 1.0), ("k", "m8", "b", 0.5), ("k", "m7", "a", 0.5)]
    frame = spark.createDataFrame(rows, "grp string, id string, lic string, vote double")
    got = {r.grp: r.lic for r in golden_record(frame, "grp", "id", {"lic": (F.col("lic"), [F.col("vote")])}).collect()}
    assert (got["g"].value, got["g"].member) == ("apache", "m3")
    assert "h" not in got and (got["k"].value, got["k"].member) == ("a", "m7")
    # Without votes another value wins: the smallest member's.
    none = {r.grp: r.lic for r in golden_record(frame, "grp", "id", {"lic": (F.col("lic"), [F.lit(0.0)])}).collect()}
    assert none["g"].value == "mit"


def test_packing_keeps_items_whole():
    rng = np.random.default_rng(2)
    for size in (rng.integers(1, 2049, 300), np.full(50, 1025), np.zeros(5, np.int64), np.zeros(0, np.int64)):
        number = pack(size.astype(np.int64), 2048)
        fill = np.bincount(number, weights=size, minlength=1) if len(size) else np.zeros(1)
        assert len(number) == len(size) and fill.max() <= 2048


def test_containers_hold_every_document(spark):
    docs = [(1, "word " * 5000), (2, None), (3, ""), (4, "a short one"), (4, "a short one"), (None, "no id")]
    rows = fill_containers(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", capacity=512).collect()
    fill = {}
    for r in rows:
        fill[r.container] = fill.get(r.container, 0) + r.tokens
    assert max(fill.values()) <= 512
    pieces = sorted((r.piece, r.tokens) for r in rows if r.doc_id == 1)
    assert [p for p, _ in pieces] == list(range(len(pieces))) and all(t == 512 for _, t in pieces[:-1])
    assert sum(1 for r in rows if r.doc_id == 4) == 2 and {None, 2, 3} <= {r.doc_id for r in rows}


def test_form_weights_follow_the_limits():
    """Forms seen at fitted limits come to speak for a cut; the same counts away from limits do not."""
    entire = [("whole", 0.0, 9000), ("link", 0.0, 400)]
    at = form_weights([*entire, ("item", 0.99, 200), ("item", 0.0, 100)])[0]
    away = form_weights([*entire, ("item", 0.0, 300)])[0]
    assert at["item"] > away["item"] + 1 and at["whole"] == -30.0


def test_cut_texts_edge_cases(spark):
    docs = [(1, "A whole sentence."), (2, "It ends inside a wor"), (3, "```\ncode without an end"), (4, None), (5, ""), (6, "It was shortened [...]"), (7, "- a list item"), (2, "It ends inside a wor")]
    frame = spark.createDataFrame([(k, t, None, 1.0) for k, t in docs], "doc_id long, text string, source string, log_odds double")
    got = {r.doc_id: r.is_cut for r in cut_texts(frame, "doc_id", "text", "source").collect()}
    assert got == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True, 7: False}
    assert cut_texts(frame.limit(0), "doc_id", "text", "source").count() == 0
