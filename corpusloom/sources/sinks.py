"""Writing the corpus: the nested table, its card, lists of training data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import replies

#: Columns of the exported corpus, in order (fixed values).
EXPORT = [
    "skill_id", "name", "description", "body", "frontmatter_raw", "source", "source_url", "source_path", "license", "category", "tags", "quality_score",
    "quality_subscores", "content_hash", "body_tokens", "has_scripts", "has_references", "added_at", "updated_at", "attachment_path",
]


def attachment_path(has_files: Column) -> Column:
    return F.when(has_files, F.replace("skill_id", F.lit("/"), F.lit("__")))


def corpus_table(skills: DataFrame, judgements: DataFrame) -> DataFrame:
    """Publishable skills in the export schema: tags as a list, the judgement as a
    struct (null where there is none or it is no JSON object).

    ``skills`` has one row per id, ``judgements(content_hash, subscores)`` one per hash."""
    sub = judgements.select("content_hash", replies.subscores(F.col("subscores")).alias("quality_subscores"))
    rows = skills.filter("NOT deleted AND active").join(sub, "content_hash", "left")
    rows = rows.withColumn("tags", replies.string_list(F.col("tags"))).withColumn("attachment_path", attachment_path(F.col("has_scripts") | F.col("has_references")))
    return rows.select(*EXPORT)


def write_corpus(table: DataFrame, folder: str, files: int | None = None) -> None:
    """Writes the corpus as Parquet, range-partitioned by id, so the files together are in order."""
    parts = files or int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table.repartitionByRange(parts, "skill_id").sortWithinPartitions("skill_id").write.mode("overwrite").parquet(folder)


def card(table: DataFrame) -> str:
    """A dataset card: number of rows, and tallies of sources and licences, most first, then by name."""
    counts = table.groupingSets([["source"], ["license"], []], "source", "license").agg(
        F.grouping("source").alias("_gs"), F.grouping("license").alias("_gl"), F.count("*").alias("n")
    )
    rows = counts.collect()  # one row per source and licence
    total = sum(r.n for r in rows if r._gs and r._gl)

    def tally(title: str, own: list[tuple[str, int]]) -> list[str]:
        return [f"## {title}", "", *[f"- {k}: {n}" for k, n in sorted(own, key=lambda x: (-x[1], x[0]))], ""]

    sources = [(r.source or "UNKNOWN", r.n) for r in rows if not r._gs]
    licences = [(r.license or "UNKNOWN", r.n) for r in rows if not r._gl]
    return "\n".join(["# Corpus", "", f"Rows: {total}", "", *tally("Sources", sources), *tally("Licences", licences)])


def triplets(requests: DataFrame, positives: DataFrame, negatives: DataFrame, request: str, document: str) -> DataFrame:
    """Training rows ``(request, positive, negatives)``; a request without a positive or a negative has none.

    ``positives`` and ``negatives`` are ``(request, document text)``; negatives come in
    the order of their text."""
    wrong = negatives.filter(F.col(document).isNotNull()).groupBy(request).agg(F.array_sort(F.collect_set(document)).alias("negatives"))
    right = positives.filter(F.col(document).isNotNull()).select(request, F.col(document).alias("positive"))
    return requests.join(right, request).join(wrong, request)


def upsert(old: DataFrame, new: DataFrame, key: str, kept: list[str] = ()) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same key; columns in ``kept`` keep the old row's value where there is one."""
    held = old.select(key, *[F.col(c).alias(f"_old_{c}") for c in kept])
    fresh = new.join(held, key, "left") if kept else new
    for c in kept:
        fresh = fresh.withColumn(c, F.coalesce(f"_old_{c}", c)).drop(f"_old_{c}")
    return old.join(new.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def safe_entries(entries: DataFrame, budget: int) -> DataFrame:
    """Archive entries ``(archive, position, name, size)`` that may be unpacked.

    Absolute names and names that climb out of the folder are refused, and so is
    every entry of an archive whose safe entries together exceed ``budget`` bytes."""
    climbs = F.exists(F.split(F.regexp_replace("name", r"\\", "/"), "/"), lambda p: p == "..") | F.col("name").rlike(r"^([/\\]|[A-Za-z]:)")
    safe = entries.filter(~climbs)
    total = safe.groupBy("archive").agg(F.sum("size").alias("_total"))
    return safe.join(total, "archive").filter(F.col("_total") <= budget).drop("_total")
