"""Edited copies of evaluation items that keep no long run of words."""

from __future__ import annotations

from corpusloom.llm.eval_leaks import edited_copies, eval_leaks, leak_report


def test_copies_without_a_long_run_are_counted(spark, tmp_path):
    words = [f"w{k}" for k in range(60)]
    seventh = [w if k % 7 else "other" for k, w in enumerate(words)]  # similarity near 0.77, runs of 6
    inserted = [x for k, w in enumerate(words) for x in ([w, "more"] if k % 2 else [w])]  # similarity 0.75, runs of 2
    fourth = [w if k % 4 else "other" for k, w in enumerate(words)]  # similarity near 0.62, runs of 3
    third = [w if k % 3 else "other" for k, w in enumerate(words)]  # below 0.6
    pad = [f"p{k}" for k in range(300)]
    texts = [pad + seventh + pad, inserted + pad, pad + fourth, pad + third, pad + words, pad]
    spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(words)), (2, "one two three four five six seven eight nine ten eleven twelve")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    (row,) = leak_report(spark, str(tmp_path)).collect()
    assert (row.item_id, row.docs_with_run, row.docs_edited_only, row.best_similarity) == (1, 1, 3, 1.0)


def test_planted_edits_are_found(spark):
    """One word in 5, 8 or 12 replaced: recall of edited copies, and of those that keep a run by the seeds."""
    import random

    random.seed(7)
    items = [(i, " ".join(f"i{i}w{k}" if random.random() < 0.5 else f"c{random.randrange(400)}" for k in range(70))) for i in range(30)]
    noise = lambda: " ".join(f"c{random.randrange(400)}" for _ in range(200))
    docs = []
    for every in (5, 8, 12):
        for i, text in items:
            edited = [f"x{random.randrange(9999)}" if k % every == every - 1 else w for k, w in enumerate(text.split())]
            docs.append((every * 1000 + i, f"{noise()} {' '.join(edited)} {noise()}"))
    docs += [(k, noise()) for k in range(20)]
    corpus = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in edited_copies(corpus, "doc_id", "text", asked, "item_id", "text", 0.6).collect()}
    assert found == {(every * 1000 + i, i) for every in (5, 8, 12) for i, _ in items}
    seeded = {(r.doc_id, r.item_id) for r in eval_leaks(corpus, "doc_id", "text", asked, "item_id", "text").collect()}
    assert {(12000 + i, i) for i, _ in items} <= seeded


def test_empty_and_null_sides(spark):
    corpus = spark.createDataFrame([(1, None), (None, "a b c"), (2, "")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, None), (None, "a b c d e f g h i j k l m"), (2, "a")], "item_id long, text string")
    assert eval_leaks(corpus, "doc_id", "text", asked, "item_id", "text").count() == 0
    assert eval_leaks(corpus, "doc_id", "text", asked.limit(0), "item_id", "text").count() == 0
    assert eval_leaks(corpus.limit(0), "doc_id", "text", asked, "item_id", "text").count() == 0
