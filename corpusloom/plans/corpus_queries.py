"""Queries over the corpus tables: parsing, normal forms, gates, statistics, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import licences, replies, scores, text
from corpusloom.operators import records
from corpusloom.operators.records import read

NOW_SQL = "now AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY skill_id ORDER BY updated_at DESC NULLS LAST) AS _rn FROM skills WHERE skill_id IS NOT NULL) WHERE _rn = 1)"
NORM_SQL = """array_to_string(list_filter(list_transform(regexp_split_to_array(body, '\\r\\n|[\\n\\r]'),
    lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), chr(10))"""
COLUMNS = [
    "skill_id", "name", "description", "body", "frontmatter_raw", "source", "source_url", "source_path", "license", "content_hash", "name_hash", "category",
    "tags", "quality_score", "safety_flags", "body_tokens", "has_scripts", "has_references", "deleted", "superseded_by", "added_at", "updated_at", "stored_path", "active",
]

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def now(spark, sf_dir: str, *columns: str) -> DataFrame:
    """Current state of each skill, only the columns asked for."""
    wanted = [c for c in COLUMNS if c in columns or c in ("skill_id", "updated_at")]
    return records.latest(read(spark, sf_dir, "skills"), "skill_id", "updated_at", wanted)


def readable_object(column: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(column)).startswith("OBJECT"), F.lit(False))


def meaningful_fields(column: str) -> Column:
    """Number of the front matter's fields that say something about the skill."""
    keys = F.when(readable_object(column), F.json_object_keys(column)).otherwise(F.array().cast("array<string>"))
    known = text.words_array(["license", "version", "tags", "metadata", "allowed-tools", "compatibility", "homepage", "emoji", "category", "source", "risk"])
    return F.size(F.filter(keys, lambda k: F.array_contains(known, k)))


def judged(spark, sf_dir: str) -> DataFrame:
    """The latest judgement of each content hash, with its parsed scores."""
    rows = read(spark, sf_dir, "quality_judgments").withColumn("at", replies.utc(F.col("judged_at")))
    rows = records.latest(rows, "content_hash", "at", ["content_hash", "at", "score", "subscores"])
    return rows.select("content_hash", "at", "score", "subscores", replies.subscores(F.col("subscores")).alias("sub"))


def _score_sql(name: str) -> str:
    return f"""CASE json_type(subscores, '$.{name}') WHEN 'BOOLEAN' THEN CASE WHEN json_extract_string(subscores, '$.{name}') = 'true' THEN 1 ELSE 0 END
      WHEN 'UBIGINT' THEN greatest(0, least(10, trunc(json_extract_string(subscores, '$.{name}')::double)))::int WHEN 'BIGINT' THEN greatest(0, least(10, trunc(json_extract_string(subscores, '$.{name}')::double)))::int
      WHEN 'DOUBLE' THEN greatest(0, least(10, trunc(json_extract_string(subscores, '$.{name}')::double)))::int
      WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match(trim(json_extract_string(subscores, '$.{name}')), '[+-]?[0-9]+') THEN greatest(0, least(10, json_extract_string(subscores, '$.{name}')::bigint))::int END END"""


JUDGED_SQL = f"""judged AS (
  SELECT content_hash, seen, score, subscores, CASE WHEN json_valid(subscores) AND json_type(subscores) = 'OBJECT' THEN {{
    'utility': {_score_sql('utility')}, 'robustness': {_score_sql('robustness')}, 'safety': {_score_sql('safety')},
    'flags': coalesce(try_cast(json_extract(subscores, '$.flags') AS varchar[]), []::varchar[])}} END AS sub
  FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY seen DESC NULLS LAST, score DESC NULLS LAST, subscores DESC NULLS LAST) AS _rn FROM (
    SELECT *, try_cast(CASE WHEN regexp_matches(trim(judged_at), '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') THEN trim(judged_at) ELSE trim(judged_at) || '+00:00' END AS timestamptz) AS seen
    FROM quality_judgments WHERE content_hash IS NOT NULL)) WHERE _rn = 1)"""


@query(f"SELECT skill_id, sha256({NORM_SQL}) AS computed_hash, sha256({NORM_SQL}) = content_hash AS agrees FROM (SELECT DISTINCT skill_id, body, content_hash FROM skills)")
def content_hashes(spark, sf_dir):
    """Content hash recomputed from every distinct state's body."""
    rows = read(spark, sf_dir, "skills").select("skill_id", "content_hash", F.sha2("body", 256).alias("state"), text.content_hash("body").alias("computed_hash")).distinct()
    return rows.select("skill_id", "computed_hash", (F.col("computed_hash") == F.col("content_hash")).alias("agrees"))


@query(f"""WITH {NOW_SQL}, h AS (SELECT skill_id, source, sha256({NORM_SQL}) AS hash FROM now)
SELECT hash, min(skill_id) AS keeper, count(*) AS copies, count(DISTINCT lower(trim(source))) AS sources FROM h GROUP BY hash""")
def content_hash_dedup(spark, sf_dir):
    """One keeper per normalised body, the smallest id."""
    rows = now(spark, sf_dir, "body", "source").select("skill_id", F.lower(F.trim("source")).alias("src"), text.content_hash("body").alias("hash"))
    return rows.groupBy("hash").agg(F.min("skill_id").alias("keeper"), F.count("*").alias("copies"), F.countDistinct("src").alias("sources"))


@query("""SELECT DISTINCT skill_id, trim(regexp_replace(lower(trim(name)), '[^a-z0-9]+', ' ', 'g')) AS canonical,
  sha256(trim(regexp_replace(lower(trim(name)), '[^a-z0-9]+', ' ', 'g'))) AS own_name_hash,
  coalesce(nullif(trim(lower(regexp_replace(name, '[^A-Za-z0-9]+', '-', 'g')), '-'), ''), 'unnamed') AS slug,
  source || '__' || coalesce(nullif(trim(lower(regexp_replace(name, '[^A-Za-z0-9]+', '-', 'g')), '-'), ''), 'unnamed') || '__' || content_hash[1:8] AS made_id,
  regexp_replace(source || '__' || name, '[^A-Za-z0-9_.@-]', '_', 'g') || '__' || sha256(source || '/' || name)[1:8] AS directory,
  content_hash[1:8] AS short_hash FROM skills""")
def slug_ids_names(spark, sf_dir):
    """Canonical names, hashes, slugs, identifiers and directory names."""
    rows = read(spark, sf_dir, "skills")
    return rows.select(
        "skill_id", text.canonical_name("name").alias("canonical"), text.name_hash("name").alias("own_name_hash"), text.slug("name").alias("slug"),
        text.record_id("source", "name", "content_hash").alias("made_id"), text.safe_dir("source", "name").alias("directory"),
        F.substring("content_hash", 1, 8).alias("short_hash"),
    ).distinct()


GATES = """CASE WHEN name IS NULL OR description IS NULL OR trim(description) = '' OR NOT regexp_full_match(trim(name), '[a-z0-9][a-z0-9-]{0,63}') THEN 'rejected_parse'
 WHEN regexp_matches(lower(concat_ws(chr(10), name, description, body)), 'clawdauthenticatortool') THEN 'rejected_safety'
 WHEN length(body) < 300 OR length(body) > 50000 OR length(trim(description)) < 20 THEN 'rejected_quality' END"""
STATUS_SQL = f"""gated AS (SELECT *, {GATES} AS gate FROM now),
 kept AS (SELECT content_hash, min(skill_id) AS first_id FROM gated WHERE gate IS NULL GROUP BY content_hash),
 s AS (SELECT g.skill_id, g.source, g.body, g.description, coalesce(gate, CASE WHEN g.skill_id <> first_id THEN 'duplicate' ELSE 'accepted' END) AS status FROM gated g LEFT JOIN kept USING (content_hash))"""


def ingest_status_rows(rows: DataFrame) -> DataFrame:
    """The first gate that each record fails, in order, and whether it repeats the
    body of a record that passed them (of one body the smallest id is stored).

    Every row is reduced to gate, lengths and hash before anything is shuffled."""
    body = F.col("body")
    named = F.col("name").isNotNull() & F.trim("name").rlike(r"^[a-z0-9][a-z0-9\-]{0,63}\z") & (F.trim("description") != "")
    blocked = F.concat_ws("\n", "name", "description", "body").rlike("(?i)ClawdAuthenticatorTool")
    size = (F.length(body) < 300) | (F.length(body) > 50000) | (F.length(F.trim("description")) < 20)
    reason = (
        F.when(F.length(body) < 300, F.format_string("body too short (%d)", F.length(body)))
        .when(F.length(body) > 50000, F.format_string("body too long (%d)", F.length(body)))
        .when(F.length(F.trim("description")) < 20, F.format_string("description too short (%d)", F.length(F.trim("description"))))
    )
    gate = F.when(~F.coalesce(named, F.lit(False)), "rejected_parse").when(blocked, "rejected_safety").when(size, "rejected_quality")
    narrow = rows.select("skill_id", "updated_at", "source", "content_hash", gate.alias("gate"), F.when(gate == "rejected_quality", reason).alias("reason"))
    return records.latest(narrow, "skill_id", "updated_at", ["source", "content_hash", "gate", "reason"])


def with_duplicates(gated: DataFrame) -> DataFrame:
    first = gated.filter("gate IS NULL").groupBy("content_hash").agg(F.min("skill_id").alias("first_id"))
    status = F.coalesce("gate", F.when(F.col("skill_id") != F.col("first_id"), "duplicate").otherwise("accepted"))
    return gated.join(first, "content_hash", "left").select("skill_id", "source", status.alias("status"), "reason")


@query(f"""WITH {NOW_SQL}, {STATUS_SQL}
SELECT skill_id, source, status, CASE WHEN status = 'rejected_quality' THEN CASE WHEN length(body) < 300 THEN format('body too short ({{}})', length(body))
 WHEN length(body) > 50000 THEN format('body too long ({{}})', length(body)) ELSE format('description too short ({{}})', length(trim(description))) END END AS reason FROM s""")
def ingest_status(spark, sf_dir):
    """Outcome of the ingest gates for every current skill."""
    return with_duplicates(ingest_status_rows(read(spark, sf_dir, "skills")))


@query(f"""WITH {NOW_SQL}, {STATUS_SQL}, spine AS (SELECT unnest(['accepted','duplicate','rejected_parse','rejected_safety','rejected_quality']) AS status)
SELECT spine.status, count(s.status) AS n FROM spine LEFT JOIN s USING (status) GROUP BY spine.status""")
def ingest_counts(spark, sf_dir):
    """Counts of the ingest outcomes, zeros included."""
    names = ["accepted", "duplicate", "rejected_parse", "rejected_safety", "rejected_quality"]
    spine = spark.createDataFrame([(n,) for n in names], "status string")
    counts = ingest_status(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))
    return spine.join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""WITH {NOW_SQL} SELECT CASE WHEN grouping(src) = 0 THEN 'source' WHEN grouping(cat) = 0 THEN 'category' WHEN grouping(lic) = 0 THEN 'license' ELSE 'all' END AS dimension,
 coalesce(src, cat, lic, '') AS value, count(*) AS n, count_if(superseded_by IS NOT NULL)::bigint AS superseded, count_if(length(description) > 1024)::bigint AS long_descriptions,
 round(avg(CASE WHEN NOT isnan(quality_score) AND quality_score BETWEEN 0 AND 1 THEN quality_score END), 6) AS mean_quality
FROM (SELECT *, lower(trim(source)) AS src, coalesce(category, 'UNKNOWN') AS cat, coalesce(license, 'UNKNOWN') AS lic FROM now WHERE NOT deleted)
GROUP BY GROUPING SETS ((src), (cat), (lic), ())""")
def library_stats(spark, sf_dir):
    """Counts and mean quality by source, category and licence, and in all, in one pass.

    Scores are added up as decimals: a mean halfway between two roundings must not
    depend on the order of rows."""
    rows = now(spark, sf_dir, "source", "category", "license", "quality_score", "superseded_by", "description", "deleted").filter("NOT deleted")
    score = F.col("quality_score")
    rows = rows.select(
        F.lower(F.trim("source")).alias("src"), F.coalesce("category", F.lit("UNKNOWN")).alias("cat"), F.coalesce("license", F.lit("UNKNOWN")).alias("lic"),
        F.when(~F.isnan(score) & score.between(0, 1), score).cast("decimal(20,18)").alias("score"), "superseded_by", F.length("description").alias("dl"),
    )
    kind = F.when(F.grouping("src") == 0, "source").when(F.grouping("cat") == 0, "category").when(F.grouping("lic") == 0, "license").otherwise("all")
    out = rows.groupingSets([["src"], ["cat"], ["lic"], []], "src", "cat", "lic").agg(
        kind.alias("dimension"), F.count("*").alias("n"), F.count_if(F.col("superseded_by").isNotNull()).alias("superseded"),
        F.count_if(F.col("dl") > 1024).alias("long_descriptions"), F.round(F.avg("score"), 6).cast("double").alias("mean_quality"),
    )
    return out.select("dimension", F.coalesce("src", "cat", "lic", F.lit("")).alias("value"), "n", "superseded", "long_descriptions", "mean_quality")


LICENCE_SQL = """CASE WHEN license IS NULL OR trim(license) IN ('', 'Unknown', 'unknown', 'LICENSE', 'LICENSE.txt', 'LICENSE.md', 'License', 'License.txt', 'License.md', 'license', 'license.txt') OR starts_with(l, 'complete terms in') THEN NULL
 WHEN contains(l, 'mit-0') THEN 'MIT-0' WHEN l = 'mit' OR regexp_matches(l, '^mit[\\s.,;]') THEN 'MIT' WHEN l = 'apache2' OR regexp_matches(l, 'apache.*2') OR regexp_matches(l, '2.*apache') THEN 'Apache-2.0'
 WHEN contains(l, 'bsd-3-clause') OR contains(l, '3-clause bsd') OR contains(l, '3 clause bsd') THEN 'BSD-3-Clause' WHEN contains(l, 'bsd-2-clause') OR contains(l, '2-clause bsd') THEN 'BSD-2-Clause'
 WHEN l = '0bsd' THEN '0BSD' WHEN l = 'bsd' THEN 'BSD' WHEN l = 'isc' THEN 'ISC' WHEN contains(l, 'mpl-2.0') OR l = 'mpl' THEN 'MPL-2.0' WHEN contains(l, 'cc0') OR contains(l, 'cc-0') THEN 'CC0-1.0'
 WHEN contains(l, 'unlicense') THEN 'Unlicense' WHEN contains(l, 'wtfpl') THEN 'WTFPL' WHEN contains(l, 'mulan') THEN 'Mulan-PSL-2.0' WHEN contains(l, 'agpl') THEN 'AGPL-3.0' WHEN contains(l, 'lgpl') THEN 'LGPL-3.0' WHEN contains(l, 'gpl') THEN 'GPL-3.0'
 WHEN regexp_matches(l, 'cc[- ]by-nc') THEN 'CC-BY-NC-4.0' WHEN regexp_matches(l, 'cc[- ]by-nd') THEN 'CC-BY-ND-4.0' WHEN regexp_matches(l, 'cc[- ]by-sa') THEN 'CC-BY-SA-4.0' WHEN regexp_matches(l, 'cc[- ]by') THEN 'CC-BY-4.0'
 WHEN contains(l, 'proprietary') OR contains(l, 'private') THEN 'Proprietary' WHEN contains(l, 'fsl') THEN 'FSL-1.1' WHEN contains(l, 'polyform') THEN 'PolyForm-NC-1.0' WHEN contains(l, 'busl') THEN 'BUSL-1.1' END"""


@query(f"""WITH {NOW_SQL}, t AS (SELECT coalesce({LICENCE_SQL}, 'UNKNOWN') AS licence, count(*) AS n FROM (SELECT license, lower(trim(license)) AS l FROM now) GROUP BY 1)
SELECT licence, n, round(100.0 * n / sum(n) OVER (), 6) AS percent FROM t""")
def license_tally(spark, sf_dir):
    """Normalised licences with counts and shares."""
    return records.tallies(now(spark, sf_dir, "license"), licences.licence_id(F.col("license")), "licence")


@query(f"""WITH {NOW_SQL} SELECT 'source' AS field, coalesce(lower(trim(source)), 'UNKNOWN') AS value, count(*) AS n FROM now GROUP BY 2
UNION ALL SELECT 'license', coalesce(license, 'UNKNOWN'), count(*) FROM now GROUP BY 2""")
def card_tallies(spark, sf_dir):
    """Tallies for a dataset card."""
    rows = now(spark, sf_dir, "source", "license")
    both = rows.select(F.explode(F.array(F.struct(F.lit("source").alias("field"), F.lower(F.trim("source")).alias("value")), F.struct(F.lit("license").alias("field"), F.col("license").alias("value")))).alias("x"))
    return both.groupBy(F.col("x.field").alias("field"), F.coalesce("x.value", F.lit("UNKNOWN")).alias("value")).agg(F.count("*").alias("n"))


_STOP = ", ".join(f"'{w}'" for w in text.TAG_STOP)


@query(f"""WITH {NOW_SQL}, raw AS (SELECT skill_id, list_concat(coalesce(try_cast(CASE WHEN json_valid(tags) THEN tags END AS varchar[]), []), CASE WHEN category IS NULL THEN [] ELSE [category] END,
  regexp_split_to_array(coalesce(name, ''), '[-_\\s/.]+'), list_filter(regexp_extract_all(coalesce(description, ''), '[a-zA-Z][a-zA-Z0-9+#]{{1,}}'), lambda w: length(w) >= 4)) AS t FROM now),
 one AS (SELECT skill_id, unnest(list_transform(t, lambda x: lower(trim(x)))) AS tag, generate_subscripts(t, 1) AS k FROM raw),
 firsts AS (SELECT skill_id, tag, min(k) AS k FROM one WHERE length(tag) >= 2 AND tag NOT IN ({_STOP}) GROUP BY skill_id, tag),
 best AS (SELECT *, row_number() OVER (PARTITION BY skill_id ORDER BY k) AS r FROM firsts)
SELECT n.skill_id, coalesce(b.tags, '') AS made_tags FROM now n LEFT JOIN (SELECT skill_id, string_agg(tag, ',' ORDER BY k) AS tags FROM best WHERE r <= 5 GROUP BY skill_id) b USING (skill_id)""")
def tags_top5(spark, sf_dir):
    """Up to five tags of each skill."""
    rows = now(spark, sf_dir, "name", "description", "category", "tags")
    made = text.tags(replies.string_list(F.col("tags")), F.col("category"), "name", "description")
    return rows.select("skill_id", F.array_join(made, ",").alias("made_tags"))


@query(f"""WITH {NOW_SQL}, {JUDGED_SQL}, w AS (SELECT lower(trim(source)) AS src, max(source_weight) AS prior FROM source_registry GROUP BY 1),
 c AS (SELECT n.*, j.score AS js, coalesce(w.prior, 0.5) AS prior, length(body) AS bl, length(description) AS dl FROM now n LEFT JOIN judged j USING (content_hash) LEFT JOIN w ON w.src = lower(trim(n.source))),
 f AS (SELECT *, CASE WHEN js IS NOT NULL THEN greatest(0.0, least(1.0, js / 10)) ELSE 0.5
   + 0.1 * CASE WHEN bl < 300 THEN 0.0 WHEN bl < 1000 THEN 0.3 + (bl - 300)::double / 700 * 0.4 WHEN bl <= 10000 THEN 1.0 WHEN bl <= 30000 THEN 1.0 - (bl - 10000)::double / 20000 * 0.4 WHEN bl <= 50000 THEN 0.6 - (bl - 30000)::double / 20000 * 0.3 ELSE 0.0 END
   + 0.05 * CASE WHEN dl < 20 THEN 0.0 WHEN dl < 60 THEN 0.5 WHEN dl <= 1024 THEN 1.0 ELSE 0.8 END
   + 0.05 * least(1.0::double, len(list_filter(CASE WHEN json_valid(frontmatter_raw) AND json_type(frontmatter_raw) = 'OBJECT' THEN json_keys(frontmatter_raw) ELSE [] END,
      lambda k: k IN ('license','version','tags','metadata','allowed-tools','compatibility','homepage','emoji','category','source','risk'))) / 4.0::double) END AS content FROM c)
SELECT skill_id, CASE WHEN len(list_filter(coalesce(try_cast(CASE WHEN json_valid(safety_flags) THEN safety_flags END AS varchar[]), []), lambda f: starts_with(f, 'blocked.'))) > 0 THEN 0.0 ELSE floor(greatest(0.0, least(1.0, 0.85 * content + 0.15 * prior + (CASE WHEN has_scripts THEN 0.05::double ELSE 0::double END + CASE WHEN has_references THEN 0.02::double ELSE 0::double END))) * 1000.0 + 0.5) / 1000.0 END AS quality FROM f""")
def quality_score(spark, sf_dir):
    """Quality recomputed from judgement (or structure), source prior and extras; 0 where a safety flag blocks."""
    rows = now(spark, sf_dir, "source", "body", "description", "frontmatter_raw", "content_hash", "safety_flags", "has_scripts", "has_references")
    prior = read(spark, sf_dir, "source_registry").groupBy(F.lower(F.trim("source")).alias("src")).agg(F.max("source_weight").alias("prior"))
    rows = rows.withColumn("src", F.lower(F.trim("source"))).withColumn("bl", F.length("body")).withColumn("dl", F.length("description"))
    rows = rows.join(judged(spark, sf_dir).select("content_hash", "score"), "content_hash", "left").join(prior, "src", "left")
    content = F.when(F.col("score").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score") / 10)))
    content = content.otherwise(scores.structural_content(F.col("bl"), F.col("dl"), scores.front_matter_richness(meaningful_fields("frontmatter_raw"))))
    blocked = F.exists(replies.string_list(F.col("safety_flags")), lambda f: F.startswith(f, F.lit("blocked.")))
    quality = scores.composite(content, F.coalesce("prior", F.lit(0.5)), F.col("has_scripts"), F.col("has_references"))
    return rows.select("skill_id", F.when(blocked, 0.0).otherwise(quality).alias("quality"))


@query(f"""WITH {JUDGED_SQL}, b AS (SELECT least(floor(score / 2), 4)::int AS bin FROM judged WHERE score BETWEEN 0 AND 10 AND NOT isnan(score)), spine AS (SELECT unnest(range(0, 5))::int AS bin)
SELECT spine.bin, count(b.bin) AS n FROM spine LEFT JOIN b USING (bin) GROUP BY spine.bin""")
def quality_histogram(spark, sf_dir):
    """Five bins of the judged scores, empty ones included."""
    rows = judged(spark, sf_dir).filter(~F.isnan("score") & F.col("score").between(0, 10))
    bins = rows.groupBy(F.least(F.floor(F.col("score") / 2), F.lit(4)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return spark.range(5).select(F.col("id").cast("int").alias("bin")).join(bins, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""WITH {JUDGED_SQL} SELECT count(*) AS n, round(avg(score), 6) AS mean, round(min(score), 6) AS low, round(max(score), 6) AS high, count_if(sub IS NULL)::bigint AS unreadable FROM judged""")
def judgment_stats(spark, sf_dir):
    rows = judged(spark, sf_dir)
    return rows.agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.min("score"), 6).alias("low"), F.round(F.max("score"), 6).alias("high"), F.count_if(F.col("sub").isNull()).alias("unreadable"))


@query(f"""WITH {JUDGED_SQL} SELECT content_hash, CASE WHEN sub.safety < 3 OR list_has_any(sub.flags, ['prompt_injection','cmd_injection','unsafe_exec','auth_bypass','csam_risk']) THEN 0.0 ELSE
 floor(greatest(0.0, CASE WHEN sub.safety / 10.0::double < 0.7 THEN (0.5 * (sub.utility / 10.0::double) + 0.35 * (sub.robustness / 10.0::double) + 0.15 * (sub.safety / 10.0::double)) * (0.5 + 0.5 * ((sub.safety / 10.0::double - 0.3) / 0.4))
 ELSE 0.5 * (sub.utility / 10.0::double) + 0.35 * (sub.robustness / 10.0::double) + 0.15 * (sub.safety / 10.0::double) END) * 10.0 * 100.0 + 0.5) / 100.0 END AS content FROM judged WHERE sub.utility IS NOT NULL AND sub.robustness IS NOT NULL AND sub.safety IS NOT NULL""")
def judged_contents(spark, sf_dir):
    """Content score of each judgement from its three scores and flags."""
    sub = F.col("sub")
    return judged(spark, sf_dir).filter("sub.utility IS NOT NULL AND sub.robustness IS NOT NULL AND sub.safety IS NOT NULL").select("content_hash", scores.judged_content(sub["utility"], sub["robustness"], sub["safety"], sub["flags"]).alias("content"))


@query(f"""WITH {NOW_SQL}, {JUDGED_SQL} SELECT skill_id FROM now n JOIN judged j USING (content_hash)
 WHERE NOT n.deleted AND sub IS NOT NULL AND ((json_type(subscores, '$.safety') IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND json_extract_string(subscores, '$.safety')::double < 3)
 OR list_has_any(sub.flags, ['prompt_injection','cmd_injection','unsafe_exec','auth_bypass','csam_risk']))""")
def safety_gate(spark, sf_dir):
    """Live skills whose judgement has a safety number below 3 or a hard flag; a missing or boolean safety excludes nothing."""
    bad = judged(spark, sf_dir).filter(replies.unsafe(F.col("subscores"), scores.HARD_FLAGS))
    return now(spark, sf_dir, "content_hash", "deleted").filter("NOT deleted").join(bad.select("content_hash"), "content_hash", "left_semi").select("skill_id")


@query(f"WITH {NOW_SQL} SELECT lower(trim(source)) AS source, count(*) AS unjudged FROM now n WHERE NOT deleted AND active AND NOT EXISTS (SELECT 1 FROM quality_judgments q WHERE q.content_hash = n.content_hash) GROUP BY 1")
def unjudged_active(spark, sf_dir):
    """Live active skills without any judgement, by source."""
    rows = now(spark, sf_dir, "source", "content_hash", "deleted", "active").filter("NOT deleted AND active")
    gaps = rows.join(read(spark, sf_dir, "quality_judgments").select("content_hash"), "content_hash", "left_anti")
    return gaps.groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count("*").alias("unjudged"))


@query("""WITH used AS (SELECT DISTINCT lower(trim(source)) AS source FROM skills WHERE source IS NOT NULL), known AS (SELECT lower(trim(source)) AS source, max(license_category) AS category FROM source_registry GROUP BY 1)
SELECT coalesce(u.source, k.source) AS source, CASE WHEN k.source IS NULL THEN 'not registered' WHEN u.source IS NULL THEN 'not used' WHEN k.category IS NULL OR k.category = 'UNKNOWN' THEN 'no category' END AS issue
FROM used u FULL OUTER JOIN known k ON u.source = k.source WHERE k.source IS NULL OR u.source IS NULL OR k.category IS NULL OR k.category = 'UNKNOWN'""")
def source_consistency(spark, sf_dir):
    """Differences between the sources in use and the registry (a full outer join)."""
    used = read(spark, sf_dir, "skills").select(F.lower(F.trim("source")).alias("source")).filter("source IS NOT NULL").distinct().withColumn("_used", F.lit(True))
    known = read(spark, sf_dir, "source_registry").groupBy(F.lower(F.trim("source")).alias("source")).agg(F.max("license_category").alias("category")).withColumn("_known", F.lit(True))
    issue = F.when(F.col("_known").isNull(), "not registered").when(F.col("_used").isNull(), "not used").when(F.col("category").isNull() | (F.col("category") == "UNKNOWN"), "no category")
    return used.join(known, "source", "full_outer").select("source", issue.alias("issue")).filter("issue IS NOT NULL")


@query(f"""WITH {NOW_SQL}, {JUDGED_SQL} SELECT skill_id, name, lower(trim(source)) AS source, license, category, array_to_string(coalesce(try_cast(CASE WHEN json_valid(tags) THEN tags END AS varchar[]), []), ',') AS tags,
 sub.utility::double AS utility, sub.robustness::double AS robustness, sub.safety::double AS safety, array_to_string(sub.flags, ',') AS flags, content_hash, body_tokens, has_scripts, has_references,
 CASE WHEN has_scripts OR has_references THEN replace(skill_id, '/', '__') END AS attachment_path FROM now n LEFT JOIN judged j USING (content_hash) WHERE NOT deleted AND active""")
def corpus_export(spark, sf_dir):
    """Publishable skills with parsed tags and judgement (the nested export, flattened)."""
    rows = now(spark, sf_dir, "name", "source", "license", "category", "tags", "content_hash", "body_tokens", "has_scripts", "has_references", "deleted", "active").filter("NOT deleted AND active")
    out = rows.join(judged(spark, sf_dir).select("content_hash", "sub"), "content_hash", "left")
    return out.select(
        "skill_id", "name", F.lower(F.trim("source")).alias("source"), "license", "category", F.array_join(replies.string_list(F.col("tags")), ",").alias("tags"),
        F.col("sub.utility").cast("double").alias("utility"), F.col("sub.robustness").cast("double").alias("robustness"), F.col("sub.safety").cast("double").alias("safety"), F.array_join("sub.flags", ",").alias("flags"),
        "content_hash", "body_tokens", "has_scripts", "has_references", F.when(F.col("has_scripts") | F.col("has_references"), F.replace("skill_id", F.lit("/"), F.lit("__"))).alias("attachment_path"),
    )


@query(f"""WITH {NOW_SQL}, x AS (SELECT skill_id, CASE WHEN json_valid(frontmatter_raw) AND json_type(frontmatter_raw) = 'OBJECT' THEN frontmatter_raw END AS fm FROM now)
SELECT skill_id, fm IS NOT NULL AS readable, len(list_filter(coalesce(json_keys(fm), []), lambda k: k IN ('license','version','tags','metadata','allowed-tools','compatibility','homepage','emoji','category','source','risk'))) AS meaningful, json_extract_string(fm, '$.name') AS fm_name FROM x""")
def front_matter_fields(spark, sf_dir):
    """Which front matter is readable, and how many meaningful fields it has."""
    parsed = F.try_parse_json("frontmatter_raw")
    is_object = readable_object("frontmatter_raw")
    return now(spark, sf_dir, "frontmatter_raw").select(
        "skill_id", is_object.alias("readable"), meaningful_fields("frontmatter_raw").alias("meaningful"),
        F.when(is_object, F.try_variant_get(parsed, "$.name", "string")).alias("fm_name"),
    )


@query("""WITH d AS (SELECT DISTINCT path, regexp_replace(path, '/[^/]*$', '') AS dir FROM documents WHERE path IS NOT NULL)
SELECT path FROM d WHERE NOT EXISTS (SELECT 1 FROM d a WHERE a.dir <> d.dir AND starts_with(d.dir, a.dir || '/'))""")
def outermost_paths(spark, sf_dir):
    """Document paths that lie in no other document's directory."""
    return records.outermost(read(spark, sf_dir, "documents").select("path").filter("path IS NOT NULL").distinct(), "path")


@query("""SELECT doc_id, CASE WHEN starts_with(t, '---' || chr(10)) AND m <> '' THEN 'ok' WHEN starts_with(t, '---' || chr(10)) THEN 'unclosed' ELSE 'none' END AS front_matter,
 CASE WHEN m <> '' THEN trim(regexp_extract(m, '(?m)^name[ \\t]*:[ \\t]*(.*)$', 1)) ELSE '' END AS name, length(CASE WHEN m <> '' THEN t[length(m) + 1:] ELSE t END) AS body_chars
FROM (SELECT doc_id, t, regexp_extract(t, '(?s)^---\\n.*?\\n---[ \\t]*(\\n|$)') AS m FROM (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '^\\x{FEFF}', ''), '\\r\\n?', chr(10), 'g') AS t FROM documents))""")
def front_matter_split(spark, sf_dir):
    """Front matter and body of raw documents: byte-order mark and line ends are normalised first."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "^﻿", ""), r"\r\n?", "\n")
    rows = read(spark, sf_dir, "documents").select("doc_id", t.alias("t")).withColumn("m", F.regexp_extract("t", r"(?s)\A---\n.*?\n---[ \t]*(\n|\z)", 0))
    opened = F.startswith("t", F.lit("---\n"))
    return rows.select(
        "doc_id", F.when(opened & (F.col("m") != ""), "ok").when(opened, "unclosed").otherwise("none").alias("front_matter"),
        F.when(F.col("m") != "", F.trim(F.regexp_extract("m", r"(?m)^name[ \t]*:[ \t]*(.*)$", 1))).otherwise("").alias("name"),
        (F.length("t") - F.length("m")).alias("body_chars"),
    )
