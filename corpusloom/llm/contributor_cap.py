"""Problem 2: capping the records of dominant contributors.

The best ``cap`` records of each contributor stay.  Every record becomes an entry
of bytes that sort like its rank: score, time, identifier.  Every map task keeps
a bounded heap of the ``cap`` best entries per contributor; salted parts merge
the heaps, a second level merges the parts, and the last entry of the merged
heap is the contributor's threshold.  Merging reads sorted streams and counts,
so no heap is held in memory after the map side; the records behind the
threshold are found by a semi-join with it.

A heap larger than ``HEAP`` entries would be too big for a task.  Such a cap is
first split by quantiles: counts per contributor and next bytes of the
entry, combined on the map side, name the bucket in which the cap falls; better
buckets stay whole, worse ones go whole, and the bucket itself is split again
while more than ``HEAP`` entries are asked of it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import clean_source, current_rows, cut, table, usable_score

#: Entries that one heap may hold; beyond it the cap is split by quantiles.
HEAP = 1_000_000
#: Parts among which a contributor's heaps are merged first.
FAN = 8
#: Bytes of an entry by which one split tells its buckets apart.
DIGIT = 3

ENTRY = "_who string, _entry binary, _need long"


def sortable(number: Column) -> Column:
    """Eight bytes that sort like the (whole) number, ascending."""
    return F.unhex(F.lpad(F.hex(number.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def _rows(who: list, entry: list, need: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(who, pa.string()), pa.array(entry, pa.binary()), pa.array(need, pa.int64())], ["_who", "_entry", "_need"])


def _heaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best entries of each contributor in this task."""
    held: dict[str, list[bytes]] = {}
    need: dict[str, int] = {}
    for batch in batches:
        for who, entry, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            own = held.setdefault(who, [])
            need[who] = wanted
            own.append(entry)
            if len(own) >= 2 * wanted + 1024:
                held[who] = heapq.nsmallest(wanted, own)
    for who, own in held.items():
        kept = heapq.nsmallest(need[who], own)
        for s in range(0, len(kept), 10_000):
            part = kept[s : s + 10_000]
            yield _rows([who] * len(part), part, [need[who]] * len(part))


def _merged(last: bool):
    """Sorted entries to the best of each contributor, or to the last of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, place = None, 0
        for batch in batches:
            kept = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                place = place + 1 if row[0] == before else 1
                before = row[0]
                if place == row[2] if last else place <= row[2]:
                    kept.append(row)
            if kept:
                yield _rows(*zip(*kept))

    return run


def thresholds(entries: DataFrame, parts: int) -> DataFrame:
    """``(_who, _last)``: the entry of each contributor behind which its records go,
    from ``entries(_who, _entry, _need)`` with at least ``_need`` entries each."""
    leaves = entries.select("_who", "_entry", "_need").mapInArrow(_heaps, ENTRY)
    salted = leaves.withColumn("_who", F.concat(F.pmod(F.xxhash64("_entry"), F.lit(FAN)).cast("string"), F.lit("\u0001"), "_who"))
    level = salted.repartition(parts, "_who").sortWithinPartitions("_who", "_entry").mapInArrow(_merged(False), ENTRY)
    level = level.withColumn("_who", F.regexp_replace("_who", "(?s)^[0-9]+\u0001", ""))
    root = level.repartition(parts, "_who").sortWithinPartitions("_who", "_entry").mapInArrow(_merged(True), ENTRY)
    return root.select("_who", F.col("_entry").alias("_last"))


def beyond_cap(rows: DataFrame, contributor: str, order: list[Column], key: str, cap: int, heap: int = HEAP) -> DataFrame:
    """Rows ranked beyond ``cap`` within their contributor.

    ``order`` holds whole numbers, smallest first; ties are settled by ``key``,
    the smallest first, which must be unique.  Rows without a contributor form
    one contributor of their own; nulls in ``order`` rank last and rows without
    a key are dropped.  ``heap`` bounds a task's heap (see above) and changes no
    result.  Returns the columns of ``rows``; a cap of 0 or less returns all rows,
    an empty table gives an empty result.
    """
    if cap <= 0:
        return rows
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks = [sortable(F.coalesce(c.cast("long"), F.lit((1 << 63) - 1))) for c in order]
    entry = F.concat(*ranks, F.col(key).cast("string").cast("binary"))
    who = F.coalesce(F.col(contributor).cast("string"), F.lit("\u0000"))
    keyed = rows.filter(F.col(key).isNotNull()).select(F.struct("*").alias("_row"), who.alias("_who"), entry.alias("_entry"))
    # Contributors with more than the cap: at most rows / cap of them.
    over = keyed.groupBy("_who").agg(F.count("*").alias("_n")).filter(F.col("_n") > cap)
    over = cut(over.select("_who", F.lit(cap).cast("long").alias("_need"), F.lit(b"").alias("_head")))
    gone = []
    while not over.filter(F.col("_need") > heap).isEmpty():
        open_ = keyed.join(over, "_who").filter(F.expr("substring(_entry, 1, length(_head)) = _head"))
        digit = F.expr(f"rpad(substring(_entry, length(_head) + 1, {DIGIT}), {DIGIT}, X'00')")
        counts = open_.groupBy("_who", "_head", "_need", digit.alias("_digit")).agg(F.count("*").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy("_who").orderBy("_digit"))
        edge = counts.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
        edge = cut(edge.select("_who", (F.col("_need") - (F.col("_upto") - F.col("_n"))).alias("_need"), F.concat("_head", "_digit").alias("_head")))
        over = edge
    if cap > heap:
        met = keyed.join(over, "_who")
        head = F.expr("rpad(substring(_entry, 1, length(_head)), length(_head), X'00')")
        gone.append(met.filter(head > F.col("_head")).select("_row"))
        entries = met.filter(head == F.col("_head"))
    else:
        entries = keyed.join(over, "_who")
    last = cut(thresholds(entries, parts))
    at = last.select(F.col("_who").alias("_w"), "_last")
    out = entries.join(at, (F.col("_who") == F.col("_w")) & (F.col("_entry") > F.col("_last")), "left_semi").select("_row")
    for part in gone:
        out = out.union(part)
    return out.select("_row.*")


def skills_beyond_share(spark: SparkSession, sf_dir: str, share: float = 0.03) -> DataFrame:
    """Current live skills beyond ``share`` of all of them within their source."""
    now = current_rows(table(spark, sf_dir, "skills"), "skill_id", "source", "quality_score", "deleted", "updated_at")
    live = now.filter(F.col("deleted") == F.lit(False)).select(
        "skill_id", F.coalesce(clean_source("source"), F.lit("")).alias("source"), usable_score("quality_score").alias("score"),
        F.unix_micros("updated_at").alias("at"),
    )
    live = cut(live)
    cap = int(live.count() * round(share * 1_000_000) // 1_000_000)
    # A score from 0 to 1 as two whole numbers, which together hold all its bits.
    scaled = F.col("score") * 2.0**53
    high, low = F.floor(scaled), F.floor((scaled - F.floor(scaled)) * 2.0**53)
    return beyond_cap(live, "source", [-high, -low, -F.col("at")], "skill_id", cap).select("skill_id")
