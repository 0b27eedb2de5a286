"""Queries of curation: duplicate candidates, winners, merges, licences, listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import licences, replies
from corpusloom.operators import matching, records
from corpusloom.operators.records import read
from corpusloom.plans.corpus_queries import NOW_SQL, now

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


_SCORE = "CASE WHEN NOT isnan(quality_score) AND quality_score BETWEEN 0 AND 1 THEN quality_score ELSE 0 END"
NAMES_SQL = f"""{NOW_SQL}, live AS (SELECT skill_id, name_hash, {_SCORE} AS quality, added_at, lower(trim(source)) AS src FROM now WHERE NOT deleted),
 capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name_hash ORDER BY quality DESC, skill_id) AS r FROM live WHERE name_hash IS NOT NULL) WHERE r <= 100),
 pairs AS (SELECT a.skill_id AS a, b.skill_id AS b FROM capped a JOIN capped b USING (name_hash) WHERE a.skill_id < b.skill_id)"""


def live(spark, sf_dir):
    rows = now(spark, sf_dir, "name_hash", "quality_score", "added_at", "source", "deleted").filter("NOT deleted")
    score = F.col("quality_score")
    return rows.select("skill_id", "name_hash", F.when(~F.isnan(score) & score.between(0, 1), score).otherwise(0.0).alias("quality"), "added_at", F.lower(F.trim("source")).alias("src"))


@query(f"WITH {NAMES_SQL} SELECT a, b FROM pairs")
def name_pairs_capped(spark, sf_dir):
    """Pairs of live skills under one name, among the hundred best of each name."""
    return matching.name_pairs(live(spark, sf_dir), "skill_id", "name_hash", [-F.col("quality")]).select("a", "b")


VECTOR_SQL = """near AS (SELECT query, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS r FROM (
  SELECT q.vec_id AS query, e.vec_id AS id, round(list_dot_product(q.embedding::double[], e.embedding::double[]), 6) AS score FROM embeddings q JOIN embeddings e ON e.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
  WHERE score >= 0.3) WHERE r <= 5), vec AS (SELECT least(query, id) AS a, greatest(query, id) AS b, max(score) AS cos FROM near GROUP BY ALL)"""


def _near(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    found = matching.nearest(rows.filter("vec_id % 20 = 0"), rows, "vec_id", "embedding", 5, least=0.3)
    return found.groupBy(F.least("query", "id").alias("a"), F.greatest("query", "id").alias("b")).agg(F.max("score").alias("cos"))


@query(f"WITH {VECTOR_SQL} SELECT a, b, cos FROM vec")
def near_dup_pairs(spark, sf_dir):
    """Pairs of vectors with a cosine of 0.3 or more, among the five nearest of every twentieth vector."""
    return _near(spark, sf_dir)


CANDIDATE_SQL = f"""{VECTOR_SQL}, top AS (SELECT * FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 10),
 nam AS (SELECT x.vec_id AS a, y.vec_id AS b FROM top x JOIN top y USING (label) WHERE x.vec_id < y.vec_id),
 cand AS (SELECT coalesce(n.a, v.a) AS a, coalesce(n.b, v.b) AS b, coalesce(v.cos, 0.3) AS cos, CASE WHEN n.a IS NOT NULL AND v.a IS NOT NULL THEN 'both' WHEN n.a IS NOT NULL THEN 'name' ELSE 'vector' END AS "trigger" FROM nam n FULL JOIN vec v ON n.a = v.a AND n.b = v.b)"""


def _candidates(spark, sf_dir):
    names = matching.name_pairs(read(spark, sf_dir, "embeddings").withColumn("label", F.col("label").cast("string")), "vec_id", "label", [], most=10)
    return matching.merged_candidates(names, _near(spark, sf_dir), 0.3)


@query(f'WITH {CANDIDATE_SQL} SELECT a, b, cos, "trigger" FROM cand')
def candidate_pairs(spark, sf_dir):
    """Name and vector candidates merged: largest cosine, and what triggered the pair."""
    return _candidates(spark, sf_dir)


@query(f"""WITH {CANDIDATE_SQL} SELECT a, b, cos >= 0.45 OR (a + b) % 3 = 0 AS duplicate, CASE WHEN cos >= 0.45 THEN 'auto' WHEN (a + b) % 3 = 0 THEN 'judged' ELSE 'kept' END AS reason FROM cand""")
def duplicate_decisions(spark, sf_dir):
    """Candidates decided by cosine alone, or by a verdict table where it is lower; without a verdict they stay apart."""
    rows = _candidates(spark, sf_dir)
    verdicts = rows.filter((F.col("a") + F.col("b")) % 3 == 0).select("a", "b", F.lit(True).alias("verdict"))
    judged = rows.join(verdicts, ["a", "b"], "left")
    auto = F.col("cos") >= 0.45
    said = F.coalesce("verdict", F.lit(False))
    return judged.select("a", "b", (auto | said).alias("duplicate"), F.when(auto, "auto").when(said, "judged").otherwise("kept").alias("reason"))


@query(f"""WITH {NAMES_SQL}, w AS (SELECT lower(trim(source)) AS src, max(source_weight) AS weight FROM source_registry GROUP BY 1), x AS (SELECT l.skill_id, quality, coalesce(weight, 0.5) AS weight, added_at FROM live l LEFT JOIN w USING (src))
SELECT p.a, p.b, CASE WHEN s.quality > t.quality + 1e-6 THEN p.a WHEN t.quality > s.quality + 1e-6 THEN p.b WHEN s.weight > t.weight THEN p.a WHEN t.weight > s.weight THEN p.b
 WHEN coalesce(s.added_at > t.added_at, s.added_at IS NOT NULL) THEN p.a ELSE p.b END AS winner FROM pairs p JOIN x s ON s.skill_id = p.a JOIN x t ON t.skill_id = p.b""")
def pick_winner(spark, sf_dir):
    """The record to keep of every pair under one name."""
    return _won(spark, sf_dir).select("a", "b", "winner")


def _won(spark, sf_dir):
    rows = live(spark, sf_dir)
    weights = read(spark, sf_dir, "source_registry").groupBy(F.lower(F.trim("source")).alias("src")).agg(F.max("source_weight").alias("weight"))
    rows = rows.join(weights, "src", "left").select("skill_id", "src", F.struct("quality", "weight", "added_at").alias("s"))
    pairs = name_pairs_capped(spark, sf_dir)
    pairs = pairs.join(rows.select(F.col("skill_id").alias("a"), F.col("s").alias("_sa"), F.col("src").alias("_xa")), "a").join(rows.select(F.col("skill_id").alias("b"), F.col("s").alias("_sb"), F.col("src").alias("_xb")), "b")
    first = matching.pick_winner(F.col("_sa"), F.col("_sb"))
    return pairs.withColumn("winner", F.when(first, F.col("a")).otherwise(F.col("b"))).withColumn("_first", first)


@query(f"""WITH {NAMES_SQL}, w AS (SELECT lower(trim(source)) AS src, max(source_weight) AS weight FROM source_registry GROUP BY 1), x AS (SELECT l.skill_id, src, quality, coalesce(weight, 0.5) AS weight, added_at FROM live l LEFT JOIN w USING (src)),
 y AS (SELECT s.src AS xa, t.src AS xb, CASE WHEN s.quality > t.quality + 1e-6 THEN true WHEN t.quality > s.quality + 1e-6 THEN false WHEN s.weight > t.weight THEN true WHEN t.weight > s.weight THEN false
 ELSE coalesce(s.added_at > t.added_at, s.added_at IS NOT NULL) END AS f FROM pairs p JOIN x s ON s.skill_id = p.a JOIN x t ON t.skill_id = p.b)
SELECT CASE WHEN f THEN xa ELSE xb END AS winner_source, CASE WHEN f THEN xb ELSE xa END AS loser_source, count(*) AS n FROM y GROUP BY ALL""")
def merge_counts(spark, sf_dir):
    """How often each source wins against each other one."""
    rows = _won(spark, sf_dir)
    return rows.groupBy(F.when(F.col("_first"), F.col("_xa")).otherwise(F.col("_xb")).alias("winner_source"), F.when(F.col("_first"), F.col("_xb")).otherwise(F.col("_xa")).alias("loser_source")).agg(F.count("*").alias("n"))


@query()
def greedy_merges(spark, sf_dir):
    """Merges of the candidate vectors in order of cosine, each record losing at most once; the smaller id wins."""
    pairs = _candidates(spark, sf_dir).filter(F.col("cos") >= 0.3).select("a", "b", F.col("a").alias("winner"), "cos")
    return matching.greedy_merge(pairs, [-F.col("cos")])


@query("SELECT count(*) AS n, sum(is_duplicate)::bigint AS duplicates FROM dedup_judgments")
def dup_judge_stats(spark, sf_dir):
    return read(spark, sf_dir, "dedup_judgments").agg(F.count("*").alias("n"), F.sum(F.col("is_duplicate").cast("long")).alias("duplicates"))


_GREEN = ", ".join(f"'{x}'" for x in ("Apache-2.0", "BSD", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "CC0-1.0", "ISC", "MIT", "MIT-0", "MPL-2.0", "Mulan-PSL-2.0", "Unlicense", "WTFPL"))


@query(f"""WITH {NOW_SQL}, green AS (SELECT DISTINCT lower(trim(source)) AS src FROM source_registry WHERE license_category IN ({_GREEN}))
SELECT n.skill_id, n.active AS was_active, n.active OR (NOT n.deleted AND g.src IS NOT NULL) AS active FROM now n LEFT JOIN green g ON g.src = lower(trim(n.source))""")
def activate_green(spark, sf_dir):
    """Activation by licence: live skills of green sources become active, none is ever switched off."""
    green = read(spark, sf_dir, "source_registry").filter(F.col("license_category").isin(licences.GREEN)).select(F.lower(F.trim("source")).alias("src")).distinct().withColumn("_green", F.lit(True))
    rows = now(spark, sf_dir, "source", "active", "deleted").withColumn("src", F.lower(F.trim("source"))).join(green, "src", "left")
    return rows.select("skill_id", F.col("active").alias("was_active"), (F.col("active") | (~F.col("deleted") & F.coalesce("_green", F.lit(False)))).alias("active"))


@query(f"""WITH {NOW_SQL}, reg AS (SELECT lower(trim(source)) AS src, max(license_category) AS category FROM source_registry GROUP BY 1), used AS (SELECT lower(trim(source)) AS src, count(*) AS rows, count_if(active)::bigint AS active FROM now WHERE NOT deleted AND source IS NOT NULL GROUP BY 1),
 j AS (SELECT coalesce(r.src, u.src) AS source, r.category, r.src IS NOT NULL AS listed, coalesce(u.rows, 0) AS rows, coalesce(u.active, 0) AS active FROM reg r FULL JOIN used u ON r.src = u.src)
SELECT source, unnest(list_filter([CASE WHEN NOT listed THEN 'unmapped' END, CASE WHEN listed AND rows = 0 THEN 'unused' END, CASE WHEN listed AND (category IS NULL OR category = 'UNKNOWN') THEN 'no category' END,
 CASE WHEN category IN ({_GREEN}) AND active < rows THEN 'green not active' END, CASE WHEN active > 0 AND NOT coalesce(category IN ({_GREEN}), false) THEN 'active not green' END], lambda x: x IS NOT NULL)) AS issue FROM j""")
def license_validate(spark, sf_dir):
    """Five consistency checks between registry, green list and skills, one row per source and issue."""
    reg = read(spark, sf_dir, "source_registry").groupBy(F.lower(F.trim("source")).alias("source")).agg(F.max("license_category").alias("category")).withColumn("_listed", F.lit(True))
    used = now(spark, sf_dir, "source", "active", "deleted").filter("NOT deleted AND source IS NOT NULL").groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count("*").alias("rows"), F.count_if("active").alias("active"))
    both = reg.join(used, "source", "full_outer").na.fill(0, ["rows", "active"])
    listed, green = F.col("_listed").isNotNull(), F.coalesce(F.col("category").isin(licences.GREEN), F.lit(False))
    checks = [
        (~listed, "unmapped"), (listed & (F.col("rows") == 0), "unused"), (listed & (F.col("category").isNull() | (F.col("category") == "UNKNOWN")), "no category"),
        (green & (F.col("active") < F.col("rows")), "green not active"), ((F.col("active") > 0) & ~green, "active not green"),
    ]
    issues = F.filter(F.array(*[F.when(c, F.lit(name)) for c, name in checks]), lambda x: x.isNotNull())
    return both.select("source", F.explode(issues).alias("issue"))


@query(f"""WITH t AS (SELECT coalesce(license_category, '(null)') AS category, count(*) AS n FROM source_registry GROUP BY 1)
SELECT category, n, round(100.0 * n / sum(n) OVER (), 6) AS percent, CASE WHEN category IN ({_GREEN}) THEN 'GREEN' WHEN category IN ('AGPL-3.0', 'GPL-3.0', 'GPL-2.0', 'Proprietary', 'BUSL-1.1', 'FSL-1.1', 'CC-BY-NC-4.0', 'CC-BY-ND-4.0', 'PolyForm-NC-1.0') THEN 'RED'
 WHEN category IN ('LGPL-2.1', 'LGPL-3.0', 'CC-BY-SA-4.0', 'CC-BY-4.0', 'EPL-2.0') THEN 'YELLOW' WHEN category IN ('NO_LICENSE', 'SOURCE_NOT_FETCHED', 'Custom', 'NOASSERTION') THEN 'MISSING' ELSE 'OTHER' END AS tier FROM t""")
def license_tiers(spark, sf_dir):
    """Licence categories of the sources with shares and tiers."""
    counts = records.tallies(read(spark, sf_dir, "source_registry"), F.coalesce("license_category", F.lit("(null)")), "category")
    return counts.select("category", "n", "percent", licences.licence_tier(F.col("category")).alias("tier"))


@query(f"""WITH {NOW_SQL} SELECT skill_id, {_SCORE} AS quality, row_number() OVER (ORDER BY {_SCORE} DESC, added_at DESC NULLS LAST, skill_id)::int AS place FROM now WHERE NOT deleted AND category = 'DEV' AND {_SCORE} >= 0.5 AND lower(tags) LIKE '%%' ORDER BY place LIMIT 20 OFFSET 5""")
def filtered_listing(spark, sf_dir):
    """A page of the listing: category and least quality given, best first, then latest (a limit is its feature)."""
    rows = now(spark, sf_dir, "category", "quality_score", "added_at", "tags", "deleted").filter("NOT deleted AND category = 'DEV' AND tags IS NOT NULL")
    score = F.col("quality_score")
    rows = rows.withColumn("quality", F.when(~F.isnan(score) & score.between(0, 1), score).otherwise(0.0)).filter("quality >= 0.5")
    page = rows.orderBy(F.desc("quality"), F.desc_nulls_last("added_at"), "skill_id").offset(5).limit(20)
    collected = page.agg(F.array_sort(F.collect_list(F.struct((-F.col("quality")).alias("q"), (-F.coalesce(F.unix_micros("added_at"), F.lit(-(2**62)))).alias("t"), "skill_id"))).alias("x"))  # one page
    return collected.select(F.posexplode("x").alias("p", "r")).select(F.col("r.skill_id").alias("skill_id"), (0.0 - F.col("r.q")).alias("quality"), (F.col("p") + 6).cast("int").alias("place"))


@query(f"""WITH {NOW_SQL}, f AS (SELECT skill_id, safety_flags, coalesce(try_cast(CASE WHEN json_valid(safety_flags) THEN safety_flags END AS varchar[]), []) AS flags FROM now)
SELECT skill_id, array_to_string(flags, ',') AS flags, len(list_filter(flags, lambda x: starts_with(x, 'blocked.'))) > 0 AS blocked FROM f""")
def safety_flags(spark, sf_dir):
    """Each skill's stored safety flags, and whether one of them blocks."""
    flags = replies.string_list(F.col("safety_flags"))
    return now(spark, sf_dir, "safety_flags").select("skill_id", F.array_join(flags, ",").alias("flags"), F.exists(flags, lambda x: x.startswith("blocked.")).alias("blocked"))


@query(f"""WITH {NOW_SQL}, r AS (SELECT skill_id, source, name, content_hash, added_at, row_number() OVER (PARTITION BY lower(trim(source)), name_hash ORDER BY added_at NULLS FIRST, skill_id) AS k, first_value(skill_id) OVER (PARTITION BY lower(trim(source)), name_hash ORDER BY added_at NULLS FIRST, skill_id) AS stable FROM now WHERE source IS NOT NULL AND name_hash IS NOT NULL)
SELECT skill_id, stable AS stable_id, k > 1 AS overwrites FROM r""")
def overwritten_ids(spark, sf_dir):
    """Same source and canonical name: later records take the id of the first one."""
    rows = now(spark, sf_dir, "source", "name_hash", "added_at").filter("source IS NOT NULL AND name_hash IS NOT NULL").withColumn("src", F.lower(F.trim("source")))
    first = rows.groupBy("src", "name_hash").agg(F.min(F.struct("added_at", "skill_id")).alias("_f"))
    return rows.join(first, ["src", "name_hash"]).select("skill_id", F.col("_f.skill_id").alias("stable_id"), (F.col("skill_id") != F.col("_f.skill_id")).alias("overwrites"))
