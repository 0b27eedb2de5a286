"""Problem 5: consolidating pairwise matches into groups.

Deterministic Boruvka hooking.  In every round each component selects its
smallest outgoing edge, the trees that the selected edges form collapse by
pointer doubling, the edges are relabelled with their components and
de-duplicated, and the rounds end when no edge is left.  The number of
components with edges at least halves in each round, so n vertices take at most
log2(n) rounds; hubs vanish in the first round in which they are selected.

Everything stays in DataFrames of two 64-bit columns.  A hub (a vertex with a
third of all edges) is met only by ``min`` aggregates, which combine on the map
side, and by look-ups against a table with one row per key, which the adaptive
skew join can split; no group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import current_rows, cut, table


def _collapse(hooks: DataFrame) -> DataFrame:
    """``hooks(u, p)``, a forest but for mutual pairs, as ``(u, root)``."""
    back = hooks.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
    mutual = (F.col("_p") == F.col("u")) & (F.col("u") < F.col("p"))
    tree = hooks.join(back, F.col("p") == F.col("_u")).select("u", F.when(mutual, F.col("u")).otherwise(F.col("p")).alias("p"))
    tree = cut(tree)
    while True:
        for _ in range(2):
            above = tree.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
            tree = tree.select("u", "p").join(above, F.col("p") == F.col("_u")).select(
                "u", F.col("_p").alias("p"), (F.col("_p") != F.col("p")).alias("moved")
            )
        tree = cut(tree)
        if tree.filter("moved").isEmpty():
            return tree.select("u", F.col("p").alias("root"))


def connected_groups(links: DataFrame, left: str, right: str) -> DataFrame:
    """Group identifiers of everything that ``links`` ties together.

    Returns one row ``(vertex, group_id)`` per value that occurs in a link;
    ``group_id`` is the smallest vertex of its group.  Links with a null end or
    from a vertex to itself tie nothing and are dropped; repeated and reversed
    links count once; an empty table gives an empty result.  Further columns
    are ignored.
    """
    pairs = links.select(F.col(left).alias("_a"), F.col(right).alias("_b")).filter("_a <> _b")
    names = pairs.select(F.col("_a").alias("vertex")).union(pairs.select(F.col("_b"))).distinct()
    # Dense exact numbers instead of hashes: 64-bit hashes of billions of names would collide.
    names = cut(names.select("vertex", F.monotonically_increasing_id().alias("id")))
    first = names.select(F.col("vertex").alias("_a"), F.col("id").alias("a"))
    second = names.select(F.col("vertex").alias("_b"), F.col("id").alias("b"))
    edges = pairs.join(first, "_a").join(second, "_b")
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        # The smallest edge at u, ordered by (smaller end, larger end), is the one to u's smallest neighbour.
        roots = _collapse(both.groupBy("u").agg(F.min("v").alias("p")))
        rounds.append(roots)
        ends_a = roots.select(F.col("u").alias("a"), F.col("root").alias("_ra"))
        ends_b = roots.select(F.col("u").alias("b"), F.col("root").alias("_rb"))
        edges = cut(
            edges.join(ends_a, "a").join(ends_b, "b").filter("_ra <> _rb")
            .select(F.least("_ra", "_rb").alias("a"), F.greatest("_ra", "_rb").alias("b")).distinct()
        )
    member = names.select("vertex", F.col("id").alias("comp"))
    for roots in rounds:
        step = roots.select(F.col("u").alias("comp"), "root")
        member = member.join(step, "comp", "left").select("vertex", F.coalesce("root", "comp").alias("comp"))
    member = cut(member)
    lowest = member.groupBy("comp").agg(F.min("vertex").alias("group_id"))
    return member.join(lowest, "comp").select("vertex", "group_id")


def latest_verdicts(judgments: DataFrame) -> DataFrame:
    """The verdict in force on each pair of hashes: ``(hash_a, hash_b, is_duplicate)``.

    Order, case and blanks in ``pair_key`` do not matter; keys that are not two
    full hashes and rows without a verdict are ignored.  ``judged_at`` is read
    with or without an offset (then UTC); unreadable times count as earliest.
    Of equal times the verdict 1 is kept.
    """
    key = F.regexp_replace(F.lower("pair_key"), r"\s+", "")
    said = F.regexp_replace(F.trim("judged_at"), " ", "T")
    at = F.try_to_timestamp(F.when(said.rlike(r"(?i)(z|[+-]\d\d:?\d\d)$"), said).otherwise(F.concat(said, F.lit("Z"))))
    full = r"^[0-9a-f]{64}:[0-9a-f]{64}$"
    rows = judgments.select(key.alias("_k"), "is_duplicate", at.alias("_at")).filter(
        F.col("_k").rlike(full) & F.col("is_duplicate").isNotNull()
    )
    left, right = F.substring("_k", 1, 64), F.substring("_k", 66, 64)
    return (
        rows.groupBy(F.least(left, right).alias("hash_a"), F.greatest(left, right).alias("hash_b"))
        .agg(F.max(F.struct(F.col("_at"), F.col("is_duplicate"))).alias("_v"))
        .select("hash_a", "hash_b", F.col("_v.is_duplicate").alias("is_duplicate"))
    )


def links_of(now: DataFrame, judgments: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the current rows of skills: equal bodies (as a star
    around the smallest id of each hash), pointers to a known skill, and verdicts of 1."""
    by_hash = now.filter(F.col("content_hash").isNotNull())
    star = cut(by_hash.groupBy("content_hash").agg(F.min("skill_id").alias("rep")))
    same = by_hash.join(star, "content_hash").select(F.col("skill_id").alias("a"), F.col("rep").alias("b")).filter("a <> b")
    known = now.select(F.col("skill_id").alias("b"))
    point = now.select(F.col("skill_id").alias("a"), F.trim("superseded_by").alias("b")).filter("b <> '' AND a <> b")
    point = point.join(known, "b", "left_semi").select("a", "b")
    agreed = latest_verdicts(judgments).filter("is_duplicate = 1 AND hash_a <> hash_b")
    judged = (
        agreed.join(star.select(F.col("content_hash").alias("hash_a"), F.col("rep").alias("a")), "hash_a")
        .join(star.select(F.col("content_hash").alias("hash_b"), F.col("rep").alias("b")), "hash_b")
        .select("a", "b")
    )
    return same.union(point).union(judged)


def skill_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(skill_id, group_id)`` of every skill that is linked to another one."""
    now = cut(current_rows(table(spark, sf_dir, "skills"), "skill_id", "content_hash", "superseded_by"))
    links = links_of(now, table(spark, sf_dir, "dedup_judgments"))
    return connected_groups(links, "a", "b").withColumnRenamed("vertex", "skill_id").select("skill_id", "group_id")
