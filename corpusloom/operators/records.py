"""Row-level table operations: latest states, first wins, overwrite by key, path rules.

All of them are one aggregate, window or join on the key; none gathers a group.
Nulls: a null key never matches another key; where a result keeps rows with null
keys the docstring says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest(rows: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """Per key the row with the latest ``at`` (null is earliest; ties: largest other
    columns).  One aggregate with map-side combination; rows without a key go."""
    rest = [c for c in columns if c not in (key, at)]
    best = F.max(F.struct(at, *rest)).alias("_best")
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, f"_best.{at}", *[f"_best.{c}" for c in rest])


def first_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Per key the first row in ``order``; null keys form one group."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_per_key(rows: DataFrame, key: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """Per key the first ``k`` rows with their rank; Spark limits each task's groups before it shuffles."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col(rank) <= k)


def overwrite(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key; columns
    missing on a side are null."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def outermost(paths: DataFrame, path: str) -> DataFrame:
    """Files whose directory lies in no other listed file's directory: of nested
    records only the outermost stay.  Deterministic; repeated paths stay repeated."""
    own = F.regexp_replace(F.col(path), "/[^/]*$", "")
    parts = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(parts) - 1)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    rows = paths.withColumn("_dir", own)
    held = rows.select(F.col("_dir").alias("_above")).distinct()
    inside = rows.select("_dir").distinct().select("_dir", F.explode(above).alias("_above")).filter("_above <> _dir").join(held, "_above", "left_semi").select("_dir").distinct()
    return rows.join(inside, "_dir", "left_anti").drop("_dir")


def tallies(rows: DataFrame, column: Column, name: str) -> DataFrame:
    """Counts of a column's values, null as UNKNOWN, with their share in percent."""
    counts = rows.groupBy(F.coalesce(column, F.lit("UNKNOWN")).alias(name)).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(100.0 * F.col("n") / total, 6))
