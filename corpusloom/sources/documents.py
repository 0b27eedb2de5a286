"""Reading document trees, front matter, catalogues and shards into tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import records


def skill_files(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """``(path, text)`` of the outermost ``SKILL.md`` or ``skill.md`` files under a folder.

    Paths through ``/workspaces/`` are left out; of both spellings in one folder the
    capital one counts; a nested record's file gives way to the outermost one.
    Bytes that are no UTF-8 become replacement characters.  ``limit`` keeps the
    first paths by depth and name (the caller's option)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "[Ss][Kk][Ii][Ll][Ll].[Mm][Dd]").load(root)
    files = files.filter(F.regexp_extract("path", "[^/]*$", 0).isin("SKILL.md", "skill.md") & ~F.col("path").contains("/workspaces/"))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    one = records.first_wins(files.select("path", "content", folder.alias("_folder")), ["_folder"], [F.col("path")]).drop("_folder")
    kept = records.outermost(one, "path").select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    if limit is not None:
        kept = kept.orderBy(F.size(F.split("path", "/")), "path").limit(limit)
    return kept


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import json

    import yaml

    for rows in batches:
        out = []
        for raw in rows["_raw"]:
            if raw is None:
                out.append((None, None))
                continue
            try:
                made = yaml.safe_load(raw)
                made = {} if made is None or made == "" else made
            except yaml.YAMLError:
                out.append(("invalid YAML", None))
                continue
            out.append((None, json.dumps(made, default=str, ensure_ascii=False)) if isinstance(made, dict) else ("front matter is no mapping", None))
        yield rows.drop(columns="_raw").assign(_problem=[p for p, _ in out], frontmatter=[f for _, f in out])


def front_matter(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, frontmatter, body, problem)``: a document's YAML front matter as JSON and what follows it.

    A byte-order mark goes and line ends become ``\\n`` first.  ``problem`` tells why
    a document has no readable front matter (none, not closed, invalid YAML, no
    mapping); its front matter is null then.  Only the front matter itself, not the
    body, goes through Python."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "^﻿+", ""), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"\A\s+(?=---)", "")
    rows = documents.filter(F.col(key).isNotNull()).select(F.col(key), t.alias("_t"))
    pattern = r"(?s)\A---\s*\n(.*?)\n---\s*\n?(.*)"
    opened, closed = F.startswith("_t", F.lit("---")), F.rlike("_t", F.lit(pattern))
    split = rows.select(
        key, F.when(closed, F.regexp_extract("_t", pattern, 1)).alias("_raw"), F.when(closed, F.regexp_extract("_t", pattern, 2)).otherwise(F.col("_t")).alias("body"),
        F.when(~opened, "no front matter").when(~closed, "front matter not closed").alias("_early"),
    )
    kind = rows.schema[key].dataType.simpleString()
    made = split.mapInPandas(_parsed, f"{key} {kind}, body string, _early string, _problem string, frontmatter string")
    return made.select(key, "frontmatter", "body", F.coalesce("_early", "_problem").alias("problem"))


def naive_fields(raw: Column) -> Column:
    """``key: value`` lines of a front matter as a map, without YAML: outer quotes go, the last of a key counts."""
    lines = F.filter(F.split(raw, "\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.regexp_replace(x, r"\A[^:]*:", "")).alias("v")))
    bare = F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), F.regexp_replace(p["v"], r"""\A(["'])(.*)\1\z""", "$2").alias("v")))
    named = F.filter(bare, lambda p: p["k"] != "")
    last = F.filter(named, lambda p, i: ~F.exists(F.slice(named, i + 2, F.greatest(F.size(named), F.lit(1))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def repository_links(text: Column) -> Column:
    """Distinct ``owner/repo`` of the code-host links in a text that a blank or closing bracket ends, in order.

    Fixed values: owners of lists, endings of images and the name of workflow badges are left out."""
    pattern = r"github\.com/([A-Za-z0-9_.-]+)/([A-Za-z0-9_.-]+)(?=[\s)])"
    owners, repos = F.regexp_extract_all(text, F.lit(pattern), 1), F.regexp_extract_all(text, F.lit(pattern), 2)
    pairs = F.zip_with(owners, repos, lambda o, r: F.struct(o.alias("o"), F.regexp_replace(r, r"\.+\z", "").alias("r")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["o"]).isin("voltagent", "awesome") & ~p["r"].rlike(r"\.(svg|png|jpg|gif)\z") & (p["r"] != "workflows"))
    return F.array_distinct(F.transform(kept, lambda p: F.concat(p["o"], F.lit("/"), p["r"])))


def sitemap_repositories(pages: DataFrame, xml: str) -> DataFrame:
    """Distinct ``owner/repo`` of the first two path segments of a sitemap's locations."""
    place = F.explode(F.regexp_extract_all(F.col(xml), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), 1)).alias("url")
    parts = pages.select(place).select(F.filter(F.split(F.regexp_replace("url", r"^[a-z]+://[^/]+", ""), "/"), lambda x: x != "").alias("p"))
    two = parts.filter(F.size("p") >= 2).select(F.col("p")[0].alias("owner"), F.col("p")[1].alias("repo"))
    return two.filter(~F.lower("owner").isin("skills", "owners", "about", "search")).distinct()


LOCALE = r"^(.+)\.(zh-CN|en-US|de|fr|es|ja|ko|pt-BR|ru|it|tr|vi|ar)$"


def agent_records(agents: DataFrame) -> DataFrame:
    """Agents ``(stem, identifier, title, description, tags, system_role, opening_message)`` as documents ``(name, text)``.

    Of one agent's languages the file without a language code counts, else the last
    one by name.  Agents without a system role, or without title and description,
    are left out.  Of several agents with one slug the first identifier keeps it,
    the others add six digits of their identifier's hash."""
    ident = F.when(F.col("stem").rlike(LOCALE), F.regexp_extract("stem", LOCALE, 1)).otherwise(F.col("stem"))
    rows = agents.withColumn("_ident", ident).withColumn("_plain", (F.col("stem") == ident))
    one = records.first_wins(rows, ["_ident"], [F.col("_plain").desc(), F.col("stem").desc()])
    tidy = lambda c: F.coalesce(F.trim(c), F.lit(""))
    one = one.filter((tidy("system_role") != "") & ((tidy("title") != "") | (tidy("description") != "")))
    base = F.trim(F.regexp_replace(F.lower(tidy("identifier")), "[^a-z0-9]+", "-"), F.lit("-"))
    one = one.withColumn("_base", F.when(base == "", "unknown").otherwise(base))
    place = F.row_number().over(Window.partitionBy("_base").orderBy("_ident"))
    named = one.withColumn("name", F.when(place == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), F.substring(F.sha1("_ident"), 1, 6))))
    quoted = lambda c: F.concat(F.lit('"'), F.trim(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit(" "))), F.lit('"'))
    title = F.when(tidy("title") != "", tidy("title")).otherwise(tidy("identifier"))
    said = F.when((tidy("description") != "") & (tidy("description") != title), F.concat(title, F.lit(": "), tidy("description"))).otherwise(title)
    # The description's limit of 1,020 characters is the document format's own.
    short = F.rtrim(F.regexp_replace(F.rtrim(F.substring(said, 1, 1020)), r":+\z", ""))
    tags = F.array_join(F.transform(F.coalesce("tags", F.array().cast("array<string>")), quoted), ", ")
    opening = F.when(tidy("opening_message") != "", F.concat(F.lit("\n\n## Opening Message\n\n"), tidy("opening_message"))).otherwise("")
    made = F.concat(
        F.lit("---\nname: "), F.col("name"), F.lit("\ndescription: "), quoted(F.when(short == "", "(no description)").otherwise(short)), F.lit("\ntags: ["), tags, F.lit("]\n---\n\n# "),
        title, F.lit("\n\n## System Prompt\n\n"), tidy("system_role"), opening, F.lit("\n"),
    )
    return named.select("name", made.alias("text"))


def licence_map(rows: DataFrame) -> DataFrame:
    """``(source, category)`` of a licence report ``(row, source, category)``; a source's last row counts."""
    return rows.filter("source IS NOT NULL").groupBy("source").agg(F.max_by("category", "row").alias("category"))


def sharded_json(spark: SparkSession, folder: str) -> DataFrame:
    """All ``part-*.jsonl.gz`` shards of a folder as one table; blank lines are skipped."""
    return spark.read.json(f"{folder}/part-*.jsonl.gz")


def with_injected(pool: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """The pool and those extra rows whose key it lacks; columns missing on a side are null."""
    return pool.unionByName(extra.join(pool.select(key), key, "left_anti"), allowMissingColumns=True)
