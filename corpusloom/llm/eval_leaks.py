"""Problem 7: evaluation texts that leaked into a corpus.

Seeds are word n-grams of the items.  A first pass over the corpus counts every
item n-gram, per task and then in all; of every stretch of ``run`` words of an
item only the rarest n-gram that the corpus holds stays as its seed, so a copied
stretch always holds a seed and no seed hits nothing.  A second pass joins
passages to items by the seeds alone.  Around the hits, passages are aligned
with their item by Smith-Waterman, which scores copies, edited and paraphrased
ones too; the longest unbroken run of equal words is read off the same table.

Copies with many small edits hold no long n-gram.  For them, a second pass counts
word pairs: every edit costs the alignment at least as much as it breaks word
pairs, so a copy of given similarity must keep a share of the item's word pairs
in a stretch of bounded length.  Every stretch that does is aligned.

Items are the stated query set: they are shipped in blocks of bounded size, each
of which meets all documents.  Documents are never shuffled; only hits are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import Words, table

#: Characters of item text that one pass may ship to the workers.
BLOCK_CHARS = 8_000_000
SLACK = 8
MATCH, MISMATCH, GAP = 2, -1, -1
ALIGNED = "_item int, score int, longest_run int, similarity double"
BEST = ("score", "longest_run", "similarity")


class ItemIndex:
    """Words of a block of items as codes, and their n-grams sorted by hash."""

    def __init__(self, texts: pa.Array, n: int) -> None:
        words = Words(texts)
        self.n = n
        self.vocabulary = np.unique(words.hash)
        codes = np.searchsorted(self.vocabulary, words.hash).astype(np.int32)
        self.items = [codes[a:b] for a, b in zip(words.offset[:-1], words.offset[1:])]
        gram, owner, at = words.grams(n)
        order = np.argsort(gram, kind="stable")
        self.gram, self.item = gram[order], owner[order].astype(np.int32)
        self.place = (at[order] - words.offset[owner[order]]).astype(np.int32)
        self.length = np.array([len(x) for x in self.items], np.int32)

    def code(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), max(len(self.vocabulary) - 1, 0))
        return np.where(self.vocabulary[at] == hashes, at, -1).astype(np.int32) if len(self.vocabulary) else np.full(len(hashes), -1, np.int32)

    def seeds(self, frequency: np.ndarray, run: int) -> np.ndarray:
        """Marks, of every ``run`` consecutive words of an item, its rarest n-gram
        among those that occur in the corpus at all."""
        frequency = np.where(frequency > 0, frequency, np.iinfo(np.int64).max)
        chosen = np.zeros(len(self.gram), bool)
        by_item = np.lexsort((self.place, self.item))
        bounds = np.searchsorted(self.item[by_item], np.arange(len(self.items) + 1))
        width = run - self.n + 1
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = by_item[a:b]
            if len(own) <= width:
                chosen[own] = True
                continue
            windows = np.lib.stride_tricks.sliding_window_view(frequency[own], width)
            chosen[own[np.unique(np.arange(len(windows)) + windows.argmin(axis=1))]] = True
        return chosen & (frequency < np.iinfo(np.int64).max)


def _counted(index):
    """Texts of a task to the number of them that hold each n-gram of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: ItemIndex = index.value
        known = np.unique(ix.gram)
        count = np.zeros(len(known), np.int64)
        for batch in batches:
            gram, owner, _ = Words(batch.column(1)).grams(ix.n)
            at = np.minimum(np.searchsorted(known, gram), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[at] == gram) if len(known) else np.zeros(0, np.int64)
            if len(hit):
                pair = np.unique(owner[hit] * len(known) + at[hit])
                count += np.bincount(pair % len(known), minlength=len(known))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(count[some], pa.int64())], ["g", "n"])

    return run


def _hits(index, seeds):
    """Texts to rows (document, item, passage as word codes) around the seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: ItemIndex = index.value
        chosen = seeds.value
        seed_gram, seed_item, seed_place = ix.gram[chosen], ix.item[chosen], ix.place[chosen]
        for batch in batches:
            words = Words(batch.column(1))
            gram, owner, at = words.grams(ix.n)
            low, high = np.searchsorted(seed_gram, gram), np.searchsorted(seed_gram, gram, side="right")
            met = np.flatnonzero(high > low)
            if not len(met):
                continue
            times = (high - low)[met]
            place = np.repeat(met, times)
            entry = low[place] + np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
            doc, item = owner[place], seed_item[entry]
            start = at[place] - seed_place[entry]
            order = np.lexsort((start, item, doc))
            doc, item, start = doc[order], item[order], start[order]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (np.diff(start) > ix.length[item[1:]])]
            edges = np.r_[np.flatnonzero(new), len(doc)]
            rows_doc, rows_item, rows_passage = [], [], []
            for a, b in zip(edges[:-1], edges[1:]):
                d, i = doc[a], item[a]
                first = max(words.offset[d], start[a] - SLACK)
                last = min(words.offset[d + 1], start[b - 1] + ix.length[i] + SLACK)
                rows_doc.append(d)
                rows_item.append(i)
                rows_passage.append(ix.code(words.hash[first:last]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows_doc)), pa.array(rows_item, pa.int32()), pa.array(rows_passage, pa.binary())], ["_doc", "_item", "_passage"])

    return run


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score and longest run of equal words of each item and passage.

    All pairs are aligned together, one item word at a time; gaps inside a row
    follow from a running maximum."""
    count = len(items)
    wide, tall = max(map(len, passages), default=0), max(map(len, items), default=0)
    text = np.full((count, wide), -1, np.int32)
    want = np.full((count, tall), -2, np.int32)
    for k, (x, y) in enumerate(zip(items, passages)):
        want[k, : len(x)], text[k, : len(y)] = x, y
    score, run = np.zeros((count, wide + 1), np.int32), np.zeros((count, wide + 1), np.int32)
    best, longest = np.zeros(count, np.int32), np.zeros(count, np.int32)
    ramp = (-GAP * np.arange(wide + 1)).astype(np.int32)
    for r in range(tall):
        same = text == want[:, r : r + 1]
        step = np.zeros_like(score)
        step[:, 1:] = np.maximum(score[:, :-1] + np.where(same, MATCH, MISMATCH), score[:, 1:] + GAP)
        np.maximum(step, 0, out=step)
        score = np.maximum.accumulate(step + ramp, axis=1) - ramp
        here = np.zeros_like(run)
        here[:, 1:] = (run[:, :-1] + 1) * same
        run = here
        live = want[:, r] != -2
        if wide:
            best = np.where(live, np.maximum(best, score.max(axis=1)), best)
            longest = np.maximum(longest, run.max(axis=1))
    return best, longest


def _aligned(index, portion: int = 128):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: ItemIndex = index.value
        for batch in batches:
            which = batch.column("_item").to_numpy(zero_copy_only=False)
            passages = [np.frombuffer(p, np.int32) for p in batch.column("_passage").to_pylist()]
            size = np.array([len(p) for p in passages])
            score, longest = np.zeros(len(which), np.int32), np.zeros(len(which), np.int32)
            order = np.argsort(size * (1 << 20) + ix.length[which], kind="stable")
            s = 0
            while s < len(order):
                # Few at a time where texts are long, so that the table stays small.
                wide = max(1, int(size[order[s : s + portion]].max(initial=1)))
                at = order[s : s + max(1, min(portion, 2_000_000 // wide))]
                score[at], longest[at] = align([ix.items[which[i]] for i in at], [passages[i] for i in at])
                s += len(at)
            full = MATCH * np.maximum(ix.length[which], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), batch.column("_item"), pa.array(score, pa.int32()), pa.array(longest, pa.int32()), pa.array(np.round(score / full, 6), pa.float64())],
                ["_doc", "_item", "score", "longest_run", "similarity"],
            )

    return run


def eval_leaks(corpus: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, n: int = 8, run: int = 12, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item that share a seed: ``(doc_id, item_id,
    score, longest_run, similarity)``.

    ``score`` is that of the best local alignment, ``longest_run`` is the longest unbroken sequence of words of the item in the
    document (exact wherever it reaches ``run``), ``similarity`` the score's
    share of the item's full score.  Case, punctuation, emphasis and
    spacing do not matter.  Null texts and ids and items of fewer than ``n``
    words match nothing; of repeated items or documents each distinct id pair
    comes out once with its best values; an empty side gives an empty result.
    Texts are read whole; further columns are ignored.
    """
    spark = corpus.sparkSession
    docs = corpus.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).filter("_doc IS NOT NULL AND _text IS NOT NULL")
    asked = items.select(F.col(item_id).alias("_id"), F.col(item_text).alias("_words")).filter("_id IS NOT NULL AND _words IS NOT NULL")
    chars = asked.agg(F.sum(F.length("_words"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    doc_type, item_type = docs.schema["_doc"].dataType.simpleString(), asked.schema["_id"].dataType
    found = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == block).toArrow()
        index = ItemIndex(rows.column("_words").combine_chunks() if rows.num_rows else pa.array([], pa.string()), n)
        shared = spark.sparkContext.broadcast(index)
        known, entries = np.unique(index.gram, return_inverse=True)
        counts = np.zeros(len(known), np.int64)
        # At most one row per n-gram of the block.
        for r in docs.mapInArrow(_counted(shared), "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).toLocalIterator():
            counts[r.g] = r.n
        seeds = spark.sparkContext.broadcast(np.flatnonzero(index.seeds(counts[entries], run)))
        hits = docs.mapInArrow(_hits(shared, seeds), f"_doc {doc_type}, _item int, _passage binary")
        aligned = hits.mapInArrow(_aligned(shared), f"_doc {doc_type}, {ALIGNED}")
        ids = spark.createDataFrame(
            [(k, v) for k, v in enumerate(rows.column("_id").to_pylist())] if rows.num_rows else [],
            "_item int, _id " + item_type.simpleString(),
        )
        part = aligned.join(ids, "_item").groupBy("_doc", "_id").agg(*[F.max(c).alias(c) for c in BEST])
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("_doc", "_id").agg(*[F.max(c).alias(c) for c in BEST])
    return found.select(F.col("_doc").alias(doc_id), F.col("_id").alias(item_id), "score", "longest_run", "similarity")


def _edited(index, similarity: float, least_words: int, portion: int = 128):
    """Texts to aligned rows of the passages that hold enough word pairs of an item."""
    score = _aligned(index, portion)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: ItemIndex = index.value
        # A full copy scores MATCH a word; this much of it may be lost.
        loss = np.floor(MATCH * ix.length * (1 - similarity) + 1e-3 * ix.length).astype(np.int64)
        least = np.maximum(1, ix.length - 1 - loss)
        width = ix.length + loss
        # Few texts at a time, so that the hits of common word pairs stay few.
        for batch in (whole.slice(s, 1000) for whole in batches for s in range(0, whole.num_rows, 1000)):
            words = Words(batch.column(1))
            gram, owner, at = words.grams(ix.n)
            low, high = np.searchsorted(ix.gram, gram), np.searchsorted(ix.gram, gram, side="right")
            times = high - low
            met = np.repeat(np.arange(len(gram)), times)
            entry = low[met] + np.arange(len(met)) - np.repeat(np.cumsum(times) - times, times)
            doc, item, place = owner[met], ix.item[entry].astype(np.int64), at[met]
            keep = ix.length[item] >= least_words
            # Each word pair of the document counts once for an item.
            key = np.unique((doc[keep] * len(ix.items) + item[keep]) * (len(words.hash) + 1) + place[keep])
            pair, place = key // (len(words.hash) + 1), key % (len(words.hash) + 1)
            item = pair % max(len(ix.items), 1)
            # The stretch from a hit passes if the hit after the required number is still within it.
            last = np.arange(len(key)) + least[item] - 1
            inside = np.flatnonzero(last < len(key))
            inside = inside[(pair[last[inside]] == pair[inside]) & (place[last[inside]] - place[inside] <= width[item[inside]])]
            if not len(inside):
                continue
            pair, place, item = pair[inside], place[inside], item[inside]
            new = np.r_[True, (pair[1:] != pair[:-1]) | (np.diff(place) > 2 * width[item[1:]])]
            edges = np.r_[np.flatnonzero(new), len(pair)]
            doc = pair // len(ix.items)
            held = []
            for a, b in zip(edges[:-1], edges[1:]):
                first = max(words.offset[doc[a]], place[a] - width[item[a]])
                stop = min(words.offset[doc[a] + 1], place[b - 1] + width[item[a]] + ix.n)
                held.append(ix.code(words.hash[first:stop]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc[edges[:-1]])), pa.array(item[edges[:-1]], pa.int32()), pa.array(held, pa.binary())],
                ["_doc", "_item", "_passage"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in score(passages(batches)):
            yield batch.filter(pc.greater_equal(batch.column("similarity"), similarity))

    return run


def edited_copies(corpus: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, similarity: float = 0.6, least_words: int = 8, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every document and item whose local alignment reaches ``similarity``:
    ``(doc_id, item_id, score, longest_run, similarity)``, for a similarity above 0.5.

    Null texts and ids and items of fewer than ``least_words`` words match
    nothing; each pair of ids comes out once with its best values.
    """
    spark = corpus.sparkSession
    docs = corpus.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).filter("_doc IS NOT NULL AND _text IS NOT NULL")
    asked = items.select(F.col(item_id).alias("_id"), F.col(item_text).alias("_words")).filter("_id IS NOT NULL AND _words IS NOT NULL")
    chars = asked.agg(F.sum(F.length("_words"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    doc_type, item_type = docs.schema["_doc"].dataType.simpleString(), asked.schema["_id"].dataType.simpleString()
    found = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == block).toArrow()
        index = ItemIndex(rows.column("_words").combine_chunks() if rows.num_rows else pa.array([], pa.string()), 2)
        shared = spark.sparkContext.broadcast(index)
        aligned = docs.mapInArrow(_edited(shared, similarity, least_words), f"_doc {doc_type}, {ALIGNED}")
        ids = spark.createDataFrame(list(enumerate(rows.column("_id").to_pylist())) if rows.num_rows else [], "_item int, _id " + item_type)
        part = aligned.join(ids, "_item").drop("_item")
        found = part if found is None else found.unionByName(part)
    return found.groupBy(F.col("_doc").alias(doc_id), F.col("_id").alias(item_id)).agg(*[F.max(c).alias(c) for c in BEST])


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eval_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def leaked_items(spark: SparkSession, sf_dir: str, run: int = 12) -> DataFrame:
    """``(doc_id, item_id)`` where the document holds ``run`` consecutive words of the item.

    Pairs whose alignment scores at least what such a run scores, and then the
    exact check of the run."""
    return _leaks(spark, sf_dir).filter((F.col("score") >= MATCH * run) & (F.col("longest_run") >= run)).select("doc_id", "item_id")


def leak_report(spark: SparkSession, sf_dir: str, run: int = 12, similarity: float = 0.6) -> DataFrame:
    """Per item that leaked: documents with an unbroken run, and with an edited
    or paraphrased copy that aligns with ``similarity`` of the item."""
    leaks = _leaks(spark, sf_dir)
    copies = edited_copies(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text", similarity)
    leaks = leaks.unionByName(copies).groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in BEST])
    exact, edited = F.col("longest_run") >= run, F.col("similarity") >= similarity
    return (
        leaks.filter(exact | edited).groupBy("item_id")
        .agg(F.count_if(exact).alias("docs_with_run"), F.count_if(edited & ~exact).alias("docs_edited_only"), F.max("similarity").alias("best_similarity"))
    )
