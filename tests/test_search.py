"""Rankings by blocks of documents: against brute force, and without a row for every pair that meets."""

from __future__ import annotations

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import fusion, lexical, ranker


def _tables(spark, seed: int = 3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    docs = [(f"d{i:03}", " ".join(draw.choices(words, weights=range(30, 0, -1), k=draw.randint(0, 25)))) for i in range(120)]
    docs += [(f"e{i:03}", docs[i][1]) for i in range(20)] + [(None, "w1 w2")]  # equal texts: ties
    requests = [(f"q{i:02}", " ".join(draw.choices(words + ["unknown"], k=draw.randint(0, 7)))) for i in range(40)] + [("q90", None), ("q91", "unknown"), (None, "w1")]
    return spark.createDataFrame(requests, "q string, t string"), spark.createDataFrame(docs, "d string, t string"), requests, docs


def _brute(requests, docs, k, repeated, stop, pad):
    rows = [(d, t.split()) for d, t in docs if d is not None]
    n, mean = len(rows), sum(len(t) for _, t in rows) / len(rows)
    df = {w: sum(w in t for _, t in rows) for _, t in rows for w in t}
    out = set()
    for q, text in requests:
        terms = (text or "").split()
        terms = [w for w in (terms if repeated else dict.fromkeys(terms)) if w in df and (stop is None or df[w] / n <= stop)]
        if q is None:
            continue
        found = []
        for d, t in rows:
            score = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / mean)) for w in terms)
            if score > 0:
                found.append((-round(score, 6), d))
        if pad:
            found += [(0.0, d) for d, _ in sorted(rows)[:k] if d not in {x for _, x in found}]
        out |= {(q, d, -s + 0.0, i + 1) for i, (s, d) in enumerate(sorted(found)[:k])}
    return out


def _tokens(column):
    return F.filter(F.split(F.coalesce(column, F.lit("")), " "), lambda w: w != "")


@pytest.mark.parametrize("k,repeated,stop,pad", [(5, False, None, True), (4, True, 0.5, False), (200, False, None, True), (60, True, 0.4, True)])
def test_bm25_against_brute_force(spark, monkeypatch, k, repeated, stop, pad):
    requests, docs, r, d = _tables(spark)
    got = lexical.bm25(requests, "q", _tokens(F.col("t")), docs, "d", _tokens(F.col("t")), k, repeated=repeated, stop_share=stop, pad=pad)
    assert {tuple(x) for x in got.collect()} == _brute(r, d, k, repeated, stop, pad)


def test_many_blocks_give_the_same(spark, tmp_path, monkeypatch):
    """Blocks of a few documents and postings, read by the kernel itself."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    draw = np.random.default_rng(5)
    ids = [sorted(draw.choice(12, draw.integers(0, 9), replace=False).tolist()) for _ in range(90)]
    table = pa.table({"_ids0": pa.array(ids, pa.list_(pa.int32())), "_tfs0": pa.array([[1] * len(x) for x in ids], pa.list_(pa.int32())), "_dl0": pa.array([len(x) for x in ids], pa.int32())})
    pq.write_table(table.slice(0, 50), tmp_path / "part-0.parquet")
    pq.write_table(table.slice(50), tmp_path / "part-1.parquet")
    queries = [sorted(draw.choice(12, draw.integers(0, 6)).tolist()) for _ in range(50)]
    ask = lambda: [[x.tolist() for x in pair] for pair in ranker._best(queries, str(tmp_path), 0, 7, np.linspace(0.1, 3, 12), 4.0, 6)]
    whole = ask()
    monkeypatch.setattr(ranker, "BLOCK", 7)
    monkeypatch.setattr(ranker, "POSTINGS", 9)
    assert ask() == whole and sum(len(x[0]) for x in whole) > 200


def test_no_documents_and_no_requests(spark):
    requests, docs, _, _ = _tables(spark)
    t = _tokens(F.col("t"))
    assert lexical.bm25(requests, "q", t, docs.filter("false"), "d", t, 3, pad=True).count() == 0
    assert lexical.bm25(requests.filter("false"), "q", t, docs, "d", t, 3, pad=True).count() == 0


@pytest.mark.parametrize("stop,pad", [(0.5, False), (None, True)])
def test_rankings_join_no_postings(spark, stop, pad):
    """A join of terms with postings made a row for every pair of request and document that meet."""
    requests, docs, _, _ = _tables(spark)
    t = _tokens(F.col("t"))
    plan = lexical.bm25(requests, "q", t, docs, "d", t, 3, stop_share=stop, pad=pad)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan

@pytest.mark.parametrize("way", ["by_score", "by_rank"])
def test_lists_fused_by_the_ranker_as_by_joins(spark, way):
    requests, docs, _, _ = _tables(spark)
    t = _tokens(F.col("t"))
    first, second = (lexical.bm25(requests, "q", t, docs, "d", t, k, repeated=r, pad=p) for k, r, p in ((30, True, False), (20, False, True)))
    join = {"by_score": fusion.score_fusion, "by_rank": fusion.rank_fusion}[way]
    want = {tuple(x) for x in join(first, second, "q", "d", k=8, digits=6).collect()}
    channels = [ranker.Channel(t, t, 30, repeated=True), ranker.Channel(t, t, 20, pad=True)]
    got = ranker.search(requests, "q", docs, "d", channels, fuse=ranker.Fuse(getattr(fusion, way), [1.0, 0.3], 8, 6))
    assert {tuple(x) for x in got.collect()} == want and len(want) > 200


SMALL = "/root/testdata/sf0.001"
#: Queries over ranked lists.
LISTS = ["ir_metrics", "macro_mrr", "rank_fusion", "score_fusion"]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
@pytest.mark.parametrize("name", LISTS)
def test_queries_over_lists_join_no_postings(spark, name):
    from corpusloom.plans.search_queries import QUERIES

    assert "explode(" not in QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_weighted_rrf_shuffles_its_hits_once(spark):
    """The groups by name and the ranks use the hits' one shuffle by request."""
    from corpusloom.plans.search_queries import QUERIES

    plan = QUERIES["weighted_rrf"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan and "explode(" not in plan


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_training_candidates_come_from_one_ranking(spark):
    """Hits meet names and trigrams without a join, and are ranked once."""
    from corpusloom.plans.search_queries import QUERIES

    plan = QUERIES["reranker_candidates"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("MapInArrow")
    assert len(above) == 3 and "Join" not in above[0] and "explode(" not in plan


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_hard_negatives_join_no_postings(spark):
    from corpusloom.plans.search_queries import QUERIES

    assert "explode(_tokens" not in QUERIES["hard_negatives"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def _written(folder, rows: int, terms: int, seed: int):
    """Documents of one channel as the kernel reads them, in three files."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    draw = np.random.default_rng(seed)
    ids = [sorted(draw.choice(terms, draw.integers(0, 12), replace=False).tolist()) for _ in range(rows)]
    tfs = [draw.integers(1, 6, len(x)).tolist() for x in ids]
    table = pa.table({"_ids0": pa.array(ids, pa.list_(pa.int32())), "_tfs0": pa.array(tfs, pa.list_(pa.int32())), "_dl0": pa.array([sum(x) for x in tfs], pa.int32())})
    for i in range(3):
        pq.write_table(table.slice(i * rows // 3, (i + 1) * rows // 3 - i * rows // 3), folder / f"part-{i}.parquet")
    return draw, ids, tfs


@pytest.mark.parametrize("k", [1, 7, 400])
def test_few_documents_are_scored_in_full_and_the_best_stay(tmp_path, monkeypatch, k):
    """Sums in 16-bit steps leave few documents to be scored; the lists are those of full scores, repeated terms and ties included."""
    import numpy as np

    draw, ids, tfs = _written(tmp_path, 3000, 40, 8)
    queries = [sorted(draw.choice(40, draw.integers(0, 9)).tolist()) for _ in range(60)]
    idf, scored, exact = np.linspace(0.01, 6, 40), [], ranker._exact
    monkeypatch.setattr(ranker, "BLOCK", 256)
    monkeypatch.setattr(ranker, "_exact", lambda times, held, found: scored.append(len(found)) or exact(times, held, found))
    got = ranker._best(queries, str(tmp_path), 0, k, idf, 20.0, 6)
    for q, (nos, scores) in zip(queries, got):
        full = []
        for i, (terms, times) in enumerate(zip(ids, tfs)):
            held, length = dict(zip(terms, times)), sum(times)
            score = sum(idf[t] * held[t] * 2.5 / (held[t] + 1.5 * (0.25 + 0.75 * length / 20.0)) for t in q if t in held)
            if round(score, 6) > 0:
                full.append((-round(score, 6), i))
        want = sorted(full)[:k]
        assert nos.tolist() == [i for _, i in want] and np.allclose(scores, [-s for s, _ in want], atol=2e-6)
    if k < 100:
        assert sum(scored) < 60 * 3000 / 10


def test_small_files_are_read_as_whole_blocks(tmp_path):
    _written(tmp_path, 90, 12, 1)
    assert [(base, len(batch)) for base, batch in ranker._batches(str(tmp_path), ["_dl0"], 50)] == [(0, 60), (60, 30)]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_metrics_reduce_the_records_once(spark):
    """Requests with a known gold record are found once, not again for every place that reads them."""
    from corpusloom.plans.search_queries import QUERIES

    assert "skills.parquet" not in QUERIES["macro_mrr"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
