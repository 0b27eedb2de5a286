"""Ranking metrics over ``(request, key, rank)`` lists and ``(request, key, gain)`` relevance.

Ranks start at 1; repeated judgements of a pair count once with the largest gain;
a request without relevant records scores 0 everywhere (1 in full coverage).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _dcg(gain: Column, rank: Column, k: int) -> Column:
    return F.sum(F.when(rank <= k, gain / F.log2(rank + 1)).otherwise(0.0))


def per_request(requests: DataFrame, ranked: DataFrame, relevance: DataFrame, request: str, key: str) -> DataFrame:
    """The twelve metrics of every request of ``requests``."""
    gold = relevance.groupBy(request, key).agg(F.max("gain").alias("gain")).filter("gain > 0")
    order = Window.partitionBy(request).orderBy(F.col("gain").desc(), key)
    ideal = gold.withColumn("_i", F.row_number().over(order)).groupBy(request).agg(
        F.count("*").alias("_gold"), *[_dcg(F.col("gain"), F.col("_i"), k).alias(f"_ideal{k}") for k in (1, 3, 10)]
    )
    hits = ranked.join(gold, [request, key])
    found = lambda k: F.count_if(F.col("rank") <= k)
    got = hits.groupBy(request).agg(
        *[_dcg(F.col("gain"), F.col("rank"), k).alias(f"_dcg{k}") for k in (1, 3, 10)],
        *[found(k).alias(f"_f{k}") for k in (1, 3, 5, 10, 20, 50)], F.min("rank").alias("_first"),
    )
    rows = requests.select(request).distinct().join(ideal, request, "left").join(got, request, "left").na.fill(0)
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return rows.select(
        request,
        *[F.round(share(f"_dcg{k}", f"_ideal{k}"), 9).alias(f"ndcg_{k}") for k in (1, 3, 10)],
        (F.col("_f1") > 0).cast("double").alias("hit_1"), (F.col("_f3") / 3.0).alias("precision_3"),
        F.when(F.col("_first").between(1, 10), 1.0 / F.col("_first")).otherwise(0.0).alias("mrr_10"),
        *[share(f"_f{k}", "_gold").alias(f"recall_{k}") for k in (10, 20, 50)],
        *[(F.col(f"_f{k}") >= F.col("_gold")).cast("double").alias(f"coverage_{k}") for k in (3, 5, 10)],
    )


METRICS = ["ndcg_1", "ndcg_3", "ndcg_10", "hit_1", "precision_3", "mrr_10", "recall_10", "recall_20", "recall_50", "coverage_3", "coverage_5", "coverage_10"]


def micro(metrics: DataFrame) -> DataFrame:
    """Means over all requests, and their number."""
    return metrics.agg(F.count("*").alias("requests"), *[F.round(F.avg(m), 6).alias(m) for m in METRICS])


def macro(metrics: DataFrame, group: str, names: list[str]) -> DataFrame:
    """Mean of the groups' means in percent, two digits."""
    means = metrics.groupBy(group).agg(*[F.avg(m).alias(m) for m in names])
    return means.agg(F.count("*").alias("groups"), *[F.round(100.0 * F.avg(m), 2).alias(m) for m in names])


def paired_bootstrap(metrics: DataFrame, a: str, b: str, group: str, draws: int = 1000, seed: int = 0) -> DataFrame:
    """Mean difference ``a - b`` and its 2.5 and 97.5 percentiles under resampling of
    requests within their group: ``(mean, low, high)``.

    Every request's weight in a draw is Poisson with mean 1, derived from a hash of
    request and draw, so a draw is one weighted aggregate over all rows with
    map-side combination, whatever their number; ``draws`` weights travel in one
    array per task, not as rows."""
    rows = metrics.select(F.hash(F.col(metrics.columns[0]).cast("string"), F.lit(seed)).alias("_h"), F.col(group).alias("_g"), (F.col(a) - F.col(b)).alias("_d"))

    def sums(batches):
        import numpy as np
        import pandas as pd

        table: dict = {}
        for rows_ in batches:
            for (g,), part in rows_.groupby(["_g"], dropna=False):
                weights = np.stack([np.random.default_rng(int(h) & 0xFFFFFFFF).poisson(1.0, draws) for h in part["_h"]])
                total = np.stack([weights.sum(axis=0), (weights * part["_d"].to_numpy()[:, None]).sum(axis=0)])
                table[g] = table.get(g, 0) + total
        for g, total in table.items():
            yield pd.DataFrame({"_g": [g] * draws, "draw": range(draws), "w": total[0], "s": total[1]})

    kind = rows.schema["_g"].dataType.simpleString()
    per = rows.mapInPandas(sums, f"_g {kind}, draw int, w double, s double").groupBy("_g", "draw").agg((F.sum("s") / F.greatest(F.sum("w"), F.lit(1.0))).alias("m"))
    drawn = per.groupBy("draw").agg(F.avg("m").alias("m"))
    mean = rows.groupBy("_g").agg(F.avg("_d").alias("m")).agg(F.avg("m").alias("mean"))
    return drawn.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high")).join(mean).select("mean", "low", "high")
