"""Candidate pairs for merging records: by name, by vector, merged, judged, applied."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import records


def name_pairs(rows: DataFrame, key: str, name: str, best: list[Column], most: int = 100) -> DataFrame:
    """Ordered pairs ``(a, b)``, ``a < b``, of records under one name, among the
    ``most`` best of each name (the cap is the operator's feature: it keeps a
    generic name from pairing everything).  Null names pair with nothing."""
    kept = records.top_per_key(rows.filter(F.col(name).isNotNull()).select(name, key, *[c.alias(f"_o{i}") for i, c in enumerate(best)]), [name], [*[F.col(f"_o{i}") for i in range(len(best))], F.col(key)], most)
    left = kept.select(name, F.col(key).alias("a"))
    right = kept.select(name, F.col(key).alias("b"))
    return left.join(right, name).filter("a < b")


def _packed(rows: DataFrame, key: str, vector: str) -> DataFrame:
    return rows.filter(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))


def nearest(queries: DataFrame, corpus: DataFrame, key: str, vector: str, k: int, least: float = -2.0, self_match: bool = False, block: int = 2048, digits: int = 6) -> DataFrame:
    """The ``k`` most similar vectors (dot product, rounded to ``digits``, ties by
    id) of every query: ``(query, id, score, rank)``, exact.

    The stated queries are held in blocks of at most ``block`` on each worker and
    multiplied with the corpus as it streams by, so the corpus is never shuffled;
    each task passes on only its ``k`` best per query, which then merge in a
    window.  Null vectors and ids are left out; a query without any candidate of
    at least ``least`` has no rows.
    """
    spark = corpus.sparkSession
    asked = _packed(queries, key, vector)
    total = asked.count()
    blocks = max(1, -(-total // block))
    kind = asked.schema["_id"].dataType.simpleString()
    found = None
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == b).toPandas()
        ids = part["_id"].to_numpy()
        matrix = np.array(part["_v"].tolist(), float) if len(part) else np.zeros((0, 1))
        shared = spark.sparkContext.broadcast((ids, matrix))

        def run(batches, shared=shared):
            own, q = shared.value
            hold_id, hold_score = None, None
            for rows in batches:
                if not len(rows) or not len(own):
                    continue
                x = np.array(rows["_v"].tolist(), float)
                score = np.round(q @ x.T, digits)
                cand = rows["_id"].to_numpy()
                if not self_match:
                    score[own[:, None] == cand[None, :]] = -np.inf
                score[score < least] = -np.inf
                cand = np.broadcast_to(cand, score.shape)
                if hold_id is not None:
                    score, cand = np.concatenate([hold_score, score], axis=1), np.concatenate([hold_id, cand], axis=1)
                # Larger scores first, smaller ids among equals.
                order = np.stack([np.lexsort((cand[r], -score[r]))[:k] for r in range(len(own))])
                hold_score, hold_id = np.take_along_axis(score, order, 1), np.take_along_axis(cand, order, 1)
            if hold_id is not None:
                good = np.isfinite(hold_score)
                r, c = np.nonzero(good)
                yield pd.DataFrame({"query": own[r], "id": hold_id[r, c], "score": hold_score[r, c]})

        part_found = _packed(corpus, key, vector).mapInPandas(run, f"query {kind}, id {kind}, score double")
        found = part_found if found is None else found.unionByName(part_found)
    return records.top_per_key(found, ["query"], [F.col("score").desc(), F.col("id")], k)


def merged_candidates(by_name: DataFrame, by_vector: DataFrame, least: float) -> DataFrame:
    """Full outer merge of name pairs ``(a, b)`` and vector pairs ``(a, b, cos)``;
    a name pair without a vector takes ``least``, so that it is judged but never
    merged unseen."""
    left = by_name.select("a", "b").distinct().withColumn("_n", F.lit(True))
    right = by_vector.groupBy("a", "b").agg(F.max("cos").alias("_c"))
    both = left.join(right, ["a", "b"], "full_outer")
    trigger = F.when(F.col("_n").isNotNull() & F.col("_c").isNotNull(), "both").when(F.col("_n").isNotNull(), "name").otherwise("vector")
    return both.select("a", "b", F.coalesce("_c", F.lit(least)).alias("cos"), trigger.alias("trigger"))


def pick_winner(a: Column, b: Column, tolerance: float = 1e-6) -> Column:
    """Whether the first of two records is kept: by quality (within ``tolerance``),
    then weight, then the later addition; in a full tie the second stays.

    ``a`` and ``b`` are structs ``(quality, weight, added_at)``; nulls count lowest."""
    q = lambda x: F.coalesce(x["quality"], F.lit(0.0))
    w = lambda x: F.coalesce(x["weight"], F.lit(0.5))
    later = F.coalesce(a["added_at"] > b["added_at"], a["added_at"].isNotNull())
    return (
        F.when(q(a) > q(b) + tolerance, True).when(q(b) > q(a) + tolerance, False)
        .when(w(a) > w(b), True).when(w(b) > w(a), False).otherwise(later)
    )


def greedy_merge(pairs: DataFrame, rank: list[Column]) -> DataFrame:
    """Which confirmed pairs ``(a, b, winner)`` apply when taken in ``rank`` order and
    a pair is skipped once one of its sides has lost: ``(loser, winner)``.

    Solved in rounds: a pair that is the best open one of both its sides is decided
    at once, and the open pairs of its loser go.  Every round decides at least the
    best open pair of each connected group.  Pairs are compared by their rank itself
    (ties by ``a`` and ``b``), so nothing is ever sorted as a whole; every round is
    written to the checkpoint folder.  Pairs with a null side are dropped.
    """
    key = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)], "a", "b")
    open_ = pairs.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b", "winner", key.alias("_r")).checkpoint()
    rounds: list[DataFrame] = []
    while not open_.isEmpty():
        ends = open_.select(F.col("a").alias("x"), "_r").union(open_.select("b", "_r"))
        first = ends.groupBy("x").agg(F.min("_r").alias("_first"))
        best = open_.join(first.withColumnsRenamed({"x": "a", "_first": "_fa"}), "a").join(first.withColumnsRenamed({"x": "b", "_first": "_fb"}), "b")
        now = best.filter((F.col("_fa") == F.col("_r")) & (F.col("_fb") == F.col("_r")))
        now = now.select("winner", F.when(F.col("winner") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("loser")).distinct().checkpoint()
        rounds.append(now)
        dead = now.select("loser")
        open_ = open_.join(dead.withColumnRenamed("loser", "a"), "a", "left_anti").join(dead.withColumnRenamed("loser", "b"), "b", "left_anti").select("a", "b", "winner", "_r").checkpoint()
    done = pairs.select(F.col("a").alias("loser"), "winner").limit(0)
    for part in rounds:
        done = done.unionByName(part)
    return done
