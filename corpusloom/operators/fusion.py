"""Fusing ranked lists of one request: by standardised scores, by ranks, by weighted sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import records

RRF_K = 60


def standardised(hits: DataFrame, request: str) -> DataFrame:
    """Hits with ``z``: the score's distance from the list's mean in population deviations."""
    per = Window.partitionBy(request)
    return hits.withColumn("z", (F.col("score") - F.avg("score").over(per)) / (F.stddev_pop("score").over(per) + 1e-9))


def by_score(score, rank, mean, deviation):
    """For ``ranker.Fuse``: what ``score_fusion`` sums."""
    return (score - mean) / (deviation + 1e-9)


def by_rank(score, rank, mean, deviation):
    """For ``ranker.Fuse``: what ``rank_fusion`` sums."""
    return 1.0 / (RRF_K + rank)


def _merged(first: DataFrame, second: DataFrame, request: str, key: str, value: str, alpha: float, k: int, digits: int) -> DataFrame:
    """Sum of the first list's value and ``alpha`` times the second's; what a list lacks adds nothing."""
    left = first.select(request, key, F.col(value).alias("_a"), F.col("rank").alias("_ra"))
    right = second.select(request, key, F.col(value).alias("_b"), F.col("rank").alias("_rb"))
    both = left.join(right, [request, key], "full_outer")
    fused = F.round(F.coalesce("_a", F.lit(0.0)) + alpha * F.coalesce("_b", F.lit(0.0)), digits)
    # Of equal sums the one listed earlier wins: the first list's hits, then the second's.
    order = [F.col("fused").desc(), F.col("_ra").asc_nulls_last(), F.col("_rb").asc_nulls_last()]
    return records.top_per_key(both.withColumn("fused", fused), [request], order, k).select(request, key, "fused", "rank")


def score_fusion(dense: DataFrame, lexical: DataFrame, request: str, key: str, alpha: float = 0.3, k: int = 50, digits: int = 6) -> DataFrame:
    """``(request, key, fused, rank)`` by standardised scores of ``(request, key, score, rank)`` lists."""
    return _merged(standardised(dense, request), standardised(lexical, request), request, key, "z", alpha, k, digits)


def rank_fusion(dense: DataFrame, lexical: DataFrame, request: str, key: str, alpha: float = 0.3, k: int = 50, rrf_k: int = RRF_K, digits: int = 9) -> DataFrame:
    """``(request, key, fused, rank)`` by reciprocal ranks."""
    share = 1.0 / (rrf_k + F.col("rank"))
    return _merged(dense.withColumn("_s", share), lexical.withColumn("_s", share), request, key, "_s", alpha, k, digits)


def weighted_rrf(hits: DataFrame, request: str, key: str, item: str, k: int, rrf_k: int = RRF_K, digits: int = 9) -> DataFrame:
    """Weighted reciprocal rank fusion over sources.

    ``hits(request, source, source_order, weight, rank, key, item)``: ``key`` is what
    sources are collapsed by, ``item`` the source's own record.  Returns
    ``(request, key, rrf, sources, item, rank)``: the sum of the claims weight /
    (rrf_k + rank), the sources in order, and the record with the largest claim;
    ties go to what comes first by source order and rank.  A null key takes its item.
    """
    claim = F.col("weight") / (rrf_k + F.col("rank"))
    rows = hits.withColumn("_key", F.coalesce(F.nullif(F.trim(key), F.lit("")), F.col(item))).withColumn("_claim", claim)
    place = F.struct("source_order", F.col("rank").alias("_r"))
    groups = rows.groupBy(request, "_key").agg(
        F.round(F.sum("_claim"), digits).alias("rrf"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_order", F.col("rank").alias("_r"), "source"))), lambda x: x["source"]), ",").alias("sources"),
        F.min_by(item, F.struct(-F.col("_claim"), place)).alias("item"), F.min(place).alias("_first"),
    )
    best = records.top_per_key(groups, [request], [F.col("rrf").desc(), F.col("_first")], k)
    return best.select(request, F.col("_key").alias("key"), "rrf", "sources", "item", "rank")
