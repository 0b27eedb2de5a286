"""Problem 4: the best representative of each duplicate group, field by field.

Fields are unpivoted to long rows, one per member and field.  Per group, field
and normalised value the votes are summed, ``max_by`` takes the value with most
votes, and the winners are pivoted back to one row per group.  A vote is a number
(source trust times recency decay, say) or several of decreasing rank, of which
the sums compare in turn.  All steps are aggregates with map-side combination,
so a group with a third of all rows is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import clean_source, current_rows, cut, table, trust_table, usable_score
from corpusloom.llm.link_groups import connected_groups, links_of

#: Licence fields that name no licence.
NO_LICENCE = (
    "", "unknown", "unspecified", "undefined", "none", "null", "nil", "nan", "n/a", "na", "n.a.", "tbd", "tba", "todo",
    "noassertion", "no assertion", "not specified", "not stated", "not available", "unlicensed?", "other", "?", "??", "...",
)
#: Forms of a licence field that only point to a file or are dashes.
POINTER = r"^(?:(?:please )?(?:see|refer to|check|cf\.?|in|read)\b.*|(?:.*/)?(?:licen[cs]e|copying|notice)(?:[-_.]?\w*)?\.(?:txt|md|rst|html?)|(?:licen[cs]e|copying)(?: file)?|file:.*|[-‐-―_.*/\s]+)$"


def names_licence(column: Column) -> Column:
    """Whether the field names a licence: not null, blank, unknown-like, a dash or a pointer to a file."""
    text = F.lower(F.trim(F.regexp_replace(column, r"\s+", " ")))
    return F.coalesce(~text.isin(*NO_LICENCE) & ~text.rlike(POINTER), F.lit(False))


def backwards(text: Column) -> Column:
    """Text that sorts the other way round than ``text``."""
    return F.concat(F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def golden_record(members: DataFrame, group: str, member: str, fields: dict[str, tuple[Column, list[Column]]]) -> DataFrame:
    """One row per group with the winner of each field.

    ``fields`` gives each field its value, in normal form (a null claims nothing),
    and its member's votes.  Per group and value the votes are summed (null votes
    count as 0); the value with the largest sums wins, of equal sums the value
    with the smallest member.  Result: ``group`` and per field a struct column
    ``(value, member, votes)``, where ``member`` is the value's member with the
    largest votes of its own, the smallest of several; a field without any claim
    is null.  Values are compared as strings; rows without group or member are
    dropped; repeated rows vote again.
    """
    rows = members.filter(F.col(group).isNotNull() & F.col(member).isNotNull())
    widest = max(len(votes) for _, votes in fields.values())
    claims = []
    for name, (value, votes) in fields.items():
        full = [F.coalesce(v.cast("double"), F.lit(0.0)) for v in votes] + [F.lit(0.0)] * (widest - len(votes))
        claims.append(F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"), F.struct(*[v.alias(f"v{i}") for i, v in enumerate(full)]).alias("votes")))
    # The unpivot: every member's row is read once and gives one long row per claim.
    long = rows.select(F.col(group).alias("_group"), F.col(member).cast("string").alias("_member"), F.explode(F.array(*claims)).alias("_c")).filter("_c.value IS NOT NULL")
    own = F.struct(*[F.col(f"_c.votes.v{i}").alias(f"v{i}") for i in range(widest)], backwards(F.col("_member")).alias("rank"))
    summed = [F.sum(f"_c.votes.v{i}").alias(f"_s{i}") for i in range(widest)]
    values = long.groupBy("_group", F.col("_c.field").alias("_field"), F.col("_c.value").alias("_value")).agg(*summed, F.max_by("_member", own).alias("_best"), F.min("_member").alias("_least"))
    sums = [F.col(f"_s{i}").alias(f"v{i}") for i in range(widest)]
    winner = F.struct(F.col("_value").alias("value"), F.col("_best").alias("member"), F.struct(*sums).alias("votes"))
    best = F.max_by(winner, F.struct(*sums, backwards(F.col("_least")).alias("rank")))
    return values.groupBy(F.col("_group").alias(group)).pivot("_field", list(fields)).agg(best)


def _members(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Current rows of all linked skills with their group, trust and age in days before the newest of them."""
    now = cut(current_rows(table(spark, sf_dir, "skills"), "skill_id", "content_hash", "superseded_by", "source", "license", "quality_score", "updated_at", *columns))
    groups = connected_groups(links_of(now, table(spark, sf_dir, "dedup_judgments")), "a", "b").withColumnRenamed("vertex", "skill_id")
    newest = now.agg(F.max(F.unix_micros("updated_at"))).first()[0]
    rows = now.join(groups, "skill_id").withColumn("_src", clean_source("source")).withColumn("age", (F.lit(newest) - F.unix_micros("updated_at")) / 86_400e6)
    return rows.join(trust_table(table(spark, sf_dir, "source_registry")), "_src", "left")


def _votes(half_life_days: float = 365.0) -> tuple[Column, Column, Column]:
    """Votes of score, trust and recency; what is unknown votes below all that is known."""
    decay = F.coalesce(F.pow(F.lit(0.5), F.col("age") / half_life_days), F.lit(-1.0))
    return F.coalesce(usable_score("quality_score"), F.lit(-1.0)), F.coalesce("trust", F.lit(-1e300)), decay


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(group_id, survivor_id, license_from)`` of each group of linked skills.

    Two fields are voted on.  The survivor: each member is a value of its own, with
    votes of score, trust and recency decay in this order of rank.  The licence: the
    members that name one, with the votes of trust first."""
    score, trust, decay = _votes()
    named = F.when(names_licence(F.col("license")), F.col("skill_id"))
    record = golden_record(_members(spark, sf_dir), "group_id", "skill_id", {"survivor": (F.col("skill_id"), [score, trust, decay]), "license": (named, [trust, score, decay])})
    return record.select("group_id", F.col("survivor.value").alias("survivor_id"), F.coalesce("license.value", F.lit("")).alias("license_from"))


def voted_record(spark: SparkSession, sf_dir: str, half_life_days: float = 365.0) -> DataFrame:
    """Per group the licence, category, name and description with the largest sum
    of trust times recency decay over the values' normalised forms."""
    members = _members(spark, sf_dir, "category", "name", "description")
    vote = F.round(F.coalesce("trust", F.lit(0.1)) * F.coalesce(F.pow(F.lit(0.5), F.col("age") / half_life_days), F.lit(0.0)), 12)
    tidy = lambda c: F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))
    fields = {
        "license": F.when(names_licence(F.col("license")), F.lower(tidy("license"))),
        "category": F.upper(tidy("category")), "name": F.lower(tidy("name")), "description": tidy("description"),
    }
    record = golden_record(members, "group_id", "skill_id", {f: (value, [vote]) for f, value in fields.items()})
    return record.select("group_id", *[F.col(f"{f}.value").alias(f) for f in fields], *[F.col(f"{f}.member").alias(f"{f}_from") for f in fields])
