"""Queries of sources, sinks and event streams (streams are run to their end and read back)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.operators import records
from corpusloom.operators.records import read
from corpusloom.plans.corpus_queries import COLUMNS, now
from corpusloom.sources import documents, sinks
from corpusloom.streaming import ingest

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY ALL")
def events_tumbling(spark, sf_dir):
    """Hourly counts and means by event type."""
    return ingest.tumbling(read(spark, sf_dir, "events"))


@query("""WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM o)
SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS n FROM s GROUP BY user_id, k""")
def events_session(spark, sf_dir):
    """Sessions of each user with pauses of half an hour."""
    return ingest.sessions(read(spark, sf_dir, "events"))


@query("""SELECT l.event_id, l.user_id, max_by(r.value, (r.ts, r.value)) AS last_value FROM (SELECT * FROM events WHERE event_type <> 'click') l LEFT JOIN (SELECT * FROM events WHERE event_type = 'click' AND value IS NOT NULL) r ON r.user_id = l.user_id AND r.ts <= l.ts GROUP BY ALL""")
def events_asof(spark, sf_dir):
    """Every other event with the value of its user's last click."""
    e = read(spark, sf_dir, "events")
    return ingest.as_of(e.filter("event_type <> 'click'").select("event_id", "user_id", "ts"), e.filter("event_type = 'click'"), "user_id", "ts", "value").select("event_id", "user_id", "last_value")


@query()
def events_stream(spark, sf_dir):
    """The hourly table again, from a stream run to its end into a table in memory."""
    name = f"events_{uuid.uuid4().hex}"
    stream = ingest.tumbling(ingest.read_stream(spark, sf_dir, read(spark, sf_dir, "events").schema, "events.parquet"))
    stream.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


@query("""SELECT doc_id, CASE WHEN NOT starts_with(t, '---') THEN 'no front matter' WHEN NOT regexp_matches(t, '(?s)^---\\s*\\n.*?\\n---\\s*\\n?') THEN 'front matter not closed' END AS problem FROM (
 SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '^\\x{FEFF}+', ''), '\\r\\n?', chr(10), 'g'), '^\\s+---', '---') AS t FROM documents)
 WHERE NOT starts_with(t, '---') OR NOT regexp_matches(t, '(?s)^---\\s*\\n.*?\\n---\\s*\\n?')""")
def front_matter_problems(spark, sf_dir):
    """Documents without front matter, or whose front matter is not closed."""
    rows = documents.front_matter(read(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.filter(F.col("problem").isin("no front matter", "front matter not closed")).select("doc_id", "problem")


@query()
def front_matter_yaml(spark, sf_dir):
    """Names and problems of all documents' front matter, read as YAML."""
    rows = documents.front_matter(read(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select("doc_id", "problem", F.get_json_object("frontmatter", "$.name").alias("name"), F.length("body").alias("body_chars"))


@query("""SELECT host, owner, count(*) AS n FROM (SELECT regexp_extract(source_url, '^https?://([^/]+)', 1) AS host, regexp_extract(source_url, '^https?://[^/]+/([^/]+)', 1) AS owner FROM skills WHERE source_url IS NOT NULL) GROUP BY ALL""")
def url_segments(spark, sf_dir):
    """Hosts and first path segments of the skills' addresses, with counts."""
    rows = read(spark, sf_dir, "skills").filter("source_url IS NOT NULL")
    return rows.groupBy(F.regexp_extract("source_url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("source_url", "^https?://[^/]+/([^/]+)", 1).alias("owner")).agg(F.count("*").alias("n"))


@query()
def corpus_nested(spark, sf_dir):
    """The export in its nested schema of twenty columns."""
    judged = read(spark, sf_dir, "quality_judgments").filter("content_hash IS NOT NULL")
    judged = records.latest(judged, "content_hash", "judged_at", ["subscores"])
    return sinks.corpus_table(now(spark, sf_dir, *COLUMNS), judged)
