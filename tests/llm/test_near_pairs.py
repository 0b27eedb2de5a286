"""Near-duplicate classes and pairs: recall at the threshold, brute force, edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest

from corpusloom.llm import near_pairs as N


@pytest.mark.parametrize("threshold", [0.5, 0.8])
@pytest.mark.parametrize("size, ratio", [(58, 1.0), (58, 1.2), (100, 1.0), (200, 1.2), (400, 1.0)])
def test_recall_exactly_at_the_threshold(threshold, size, ratio):
    rng = np.random.default_rng(size)
    other, pairs = int(size * ratio), 400
    shared = int(np.ceil(threshold * (size + other) / (1 + threshold)))
    gram, owner, sizes = [], [], []
    for k in range(pairs):
        common = rng.integers(0, 2**64, shared, dtype=np.uint64)
        for j, n in enumerate((size, other)):
            gram.append(np.sort(np.concatenate([common, rng.integers(0, 2**64, n - shared, dtype=np.uint64)])))
            owner.append(np.full(n, 2 * k + j))
            sizes.append(n)
    sig, who = N.segment_signatures(np.concatenate(gram), np.concatenate(owner), np.array(sizes), N.allocation(threshold, 5))
    held = {}
    for s, w in set(zip(sig.tolist(), who.tolist())):
        held.setdefault(s, set()).add(w)
    met = {min(x) // 2 for x in held.values() if len(x) == 2}
    # The allocation's own bound for pairs across a band's edge (the root of MISS) is 0.86; the task asks for 0.9.
    assert len(met) / pairs >= 0.9


def shingles(text, n):
    words = text.split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_like_brute_force(spark):
    random.seed(1)
    texts = {}
    for base in range(12):
        words = [f"b{base}w{k}" if random.random() < 0.6 else f"c{random.randrange(60)}" for k in range(random.randrange(70, 130))]
        for copy in range(5):
            edited = list(words)
            for _ in range(random.choice([0, 2, 5, 9, 14])):
                edited[random.randrange(len(edited))] = f"x{random.randrange(10**6)}"
            texts[f"n{base:02d}_{copy}"] = " ".join(edited)
    want, near = set(), set()
    for a in texts:
        for b in texts:
            if a < b:
                x, y = shingles(texts[a], 3), shingles(texts[b], 3)
                share = len(x & y) / len(x | y)
                (want if share >= 0.5 else near).add((a, b))
    rows = [(k, v, "x") for k, v in texts.items()] * 2 + [(None, "a b c", "x"), ("null", None, "x"), ("empty", "", "x"), ("short", "one two", "x")]
    frame = spark.createDataFrame(rows, "key string, text string, other string").repartition(3)
    got = {(r.a, r.b) for r in N.near_pairs(frame, "key", "text", shingle=3, threshold=0.5).collect()}
    assert got <= want and len(got) >= 0.98 * len(want)


def test_one_hot_class_and_a_hot_signature(spark, monkeypatch):
    """Copies of one text are one class; many different texts under one signature are dealt out in blocks."""
    monkeypatch.setattr(N, "BLOCK", 4)
    base = [f"w{k}" for k in range(120)]
    rows = [(f"copy{k:03d}", " ".join(base)) for k in range(40)] + [(f"edit{k:03d}", " ".join([*base[:100], f"e{k}", *base[101:]])) for k in range(20)]
    frame = spark.createDataFrame(rows, "key string, text string").repartition(4)
    links, members = N.near_classes(frame, "key", "text", shingle=3, threshold=0.5)
    assert links.count() == 21 * 20 // 2
    assert sorted(r["count"] for r in members.groupBy("id").count().collect()) == [1] * 20 + [40]
    assert N.near_pairs(frame.limit(0), "key", "text").count() == 0


def test_a_name_with_two_texts_vouches_for_neither(spark):
    """A class is verified by a text of its own, not by another text of one of its names."""
    base = [f"w{k}" for k in range(120)]
    one, two = " ".join(base), " ".join([*base[:79], *(f"v{k}" for k in range(41))])
    assert len(shingles(one, 3) & shingles(two, 3)) / len(shingles(one, 3) | shingles(two, 3)) < 0.5
    frame = spark.createDataFrame([("a", one), ("a", two), ("c", one), ("x", two)], "key string, text string")
    got = {(r.a, r.b) for r in N.near_pairs(frame, "key", "text", shingle=3, threshold=0.5).collect()}
    assert got == {("a", "c"), ("a", "x")}


def test_pairs_of_a_shared_signature_do_not_travel():
    """A signature of many classes sends each of them once; its pairs, 4.5 million here, are never rows."""
    ids = np.arange(1, 3001, dtype=np.uint64) * np.uint64(7919)
    blob = N._packed(np.full(len(ids), 5, np.uint64), ids)
    batch = N._batch(np.zeros(1), np.full(1, N.BLOB), N.pa.array([blob], N.pa.binary()))
    assert sum(x.num_rows for x in N._candidates(iter([batch]))) == len(ids)


def test_cells_list_what_pairs_one_by_one_would(monkeypatch):
    """Blocks of a few classes in many cells, and batches that end within a cell."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 120, dtype=np.uint64)
    gram = np.concatenate([np.sort(np.r_[base[: 118 - k], rng.integers(0, 2**64, k, dtype=np.uint64)]) for k in range(90)])
    owner, size = np.repeat(np.arange(90), 118), np.full(90, 118)
    ids = N.set_ids(gram, owner, size)
    maps = N._batch(ids.astype(np.int64), np.full(90, N.MAP), N._binary(N._bitmaps(gram, owner, size)))
    blob = N._batch(np.zeros(1), np.full(1, N.BLOB), N.pa.array([N._packed(np.full(90, 5, np.uint64), ids)], N.pa.binary()))

    def close(cut_at):
        def ordered(batches):
            whole = N.pa.Table.from_batches(batches).sort_by([("key", "ascending"), ("other", "ascending")])
            return iter(whole.to_batches(max_chunksize=cut_at))

        met = N._bounded(0.5)(ordered(list(N._attached(ordered([maps, *N._candidates(iter([blob]))])))))
        return {pair for x in met for pair in zip(x.column(0).to_pylist(), x.column(1).to_pylist())}

    monkeypatch.setattr(N, "BLOCK", 1000)
    single = close(100)
    for name, value in (("BLOCK", 2), ("CELL", 7), ("CELL_ROWS", 5), ("COMPARED", 20)):
        monkeypatch.setattr(N, name, value)
    assert close(3) == single and 500 < len(single) < 90 * 89 // 2


def test_packed_entries_come_back():
    rng = np.random.default_rng(2)
    sig, ids = rng.integers(0, 2**64, 1000, dtype=np.uint64), rng.integers(0, 2**63, 1000).astype(np.uint64)
    low, back = N._unpacked(N._packed(sig, ids))
    assert sorted(zip(low.tolist(), back.tolist())) == sorted(zip((sig & np.uint64(0xFFFFFFFF)).tolist(), ids.tolist()))
    assert len(N._packed(sig, ids)) < 11.5 * len(ids)
