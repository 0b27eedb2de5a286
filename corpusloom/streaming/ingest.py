"""Incremental work as Structured Streaming: ingest with state, event windows.

Streams read Parquet folders.  Every function also takes a batch table, on which
it gives the result a stream over the same rows ends with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions import text


def read_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str | None = None) -> DataFrame:
    """The Parquet files of a folder as a stream; ``pattern`` limits their names."""
    stream = spark.readStream.schema(schema)
    return (stream.option("pathGlobFilter", pattern) if pattern else stream).parquet(folder)


def _timed(events: DataFrame) -> DataFrame:
    """Times as instants: a watermark needs them; those without a zone are taken in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and mean value per window and type; a stream drops events later than ``late``."""
    return (
        _timed(events).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select(F.col("window.start").alias("start"), "event_type", "n", F.round("mean", 6).alias("mean"))
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Per user the sessions that a pause of ``gap`` ends: start, end of the last event and events."""
    grouped = _timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    return grouped.select("user_id", F.col("w.start").alias("start"), "last", "n")


def distinct_within(events: DataFrame, key: list[str], late: str = "10 minutes") -> DataFrame:
    """The first event of each key; repeats that arrive within the watermark go."""
    if events.isStreaming:
        return _timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark(key)
    return events.dropDuplicates(key)


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Every left row with the last ``value`` of the right rows of its key at or before its time.

    Both sides are laid into one order per key and the value is carried forward, so
    a key is sorted, never joined with itself; of equal times the right row comes
    first.  Rows without an earlier right row keep a null."""
    both = left.select(F.struct("*").alias("_row"), F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    other = right.filter(F.col(value).isNotNull()).select(F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    order = Window.partitionBy("_k").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.unionByName(other).withColumn("_last", F.last("_v", ignorenulls=True).over(order))
    return carried.filter("_side = 1").select("_row.*", F.col("_last").alias(f"last_{value}"))


def ingest(stream: DataFrame, library: str, checkpoint: str):
    """Adds new records to a library folder as they arrive.

    Of every batch the smallest id of each body that the library does not hold yet
    is appended with its hash; records shorter than 300 or longer than 50,000
    characters are refused.  A batch that is run again adds nothing, as its bodies
    are in the library by then.  Returns the started query, which ends when all
    files there are have been read."""

    def add(batch: DataFrame, number: int) -> None:
        rows = batch.filter(F.length("body").between(300, 50_000)).withColumn("content_hash", text.content_hash("body"))
        first = rows.groupBy("content_hash").agg(F.min_by(F.struct(*[F.col(c) for c in rows.columns]), "skill_id").alias("_r")).select("_r.*")
        spark = batch.sparkSession
        try:
            known = spark.read.parquet(library).select("content_hash")
            first = first.join(known, "content_hash", "left_anti")
        except Exception as problem:  # the library's folder does not exist before the first batch
            if "PATH_NOT_FOUND" not in str(problem) and "UNABLE_TO_INFER_SCHEMA" not in str(problem):
                raise
        first.write.mode("append").parquet(library)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changed(snapshots: DataFrame) -> DataFrame:
    """Which snapshots ``(folder, taken_at, path, modified)`` of a folder differ from the one before: ``(folder, taken_at, fingerprint, changed)``; a first one does not."""
    prints = snapshots.groupBy("folder", "taken_at").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "path", F.col("modified").cast("string")))), "\n"), 256).alias("fingerprint"))
    before = F.lag("fingerprint").over(Window.partitionBy("folder").orderBy("taken_at"))
    return prints.withColumn("changed", F.coalesce(F.col("fingerprint") != before, F.lit(False)))


def cached_verdicts(asked: DataFrame, cache: DataFrame, key: str, judge) -> tuple[DataFrame, DataFrame]:
    """Verdicts of all asked keys and the rows the cache gains: ``(verdicts, new)``.

    ``judge`` maps the missing keys (a DataFrame) to ``(key, verdict)``; it is called
    once, with each key once, and only for what the cache lacks."""
    missing = asked.select(key).filter(F.col(key).isNotNull()).distinct().join(cache.select(key), key, "left_anti")
    new = judge(missing)
    known = cache.select(key, "verdict").unionByName(new.select(key, "verdict"))
    return asked.join(known, key, "left"), new
