"""Queries of search: lexical and dense rankings, fusion, metrics, training pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text, vectors
from corpusloom.operators import fusion, lexical, matching, ranker, rankings, records
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


#: The window of the lexical view of a body, in characters (fixed value).
BODY_MAX = 8000


def skills_view(spark, sf_dir: str) -> DataFrame:
    rows = now(spark, sf_dir, "name", "description", "body", "tags", "category", "source", "deleted").filter("NOT deleted")
    return rows.withColumn("t", F.concat_ws(" ", "name", "description", F.substring("body", 1, BODY_MAX)))


def whole_view(spark, sf_dir: str) -> DataFrame:
    """The records of ``skills_view`` with the whole of their bodies."""
    return skills_view(spark, sf_dir).withColumn("t", F.concat_ws(" ", "name", "description", "body"))


def requests_view(spark, sf_dir: str) -> DataFrame:
    """Distinct requests with a text; their gold record may be unknown."""
    return read(spark, sf_dir, "match_queries").filter("query_id IS NOT NULL AND instruction_text IS NOT NULL").select("query_id", "skill_id", "category", "instruction_text").dropDuplicates(["query_id"])


_IN = "('a','an','the','of','to','in','for','and','or','is','are','be','with','on','at','by','from','this','that','it','as','we','you','your','i','they','them','our','their','using','use','used','can','will','should','would','if','then','when','which','what','how','not','no','all','any','each','such','other','than','more','most','some')"
VIEW_SQL = f"""{NOW_SQL}, docs AS (SELECT skill_id, name, description, source, concat_ws(' ', name, description, body[:{BODY_MAX}]) AS t FROM now WHERE NOT deleted),
 reqs AS (SELECT query_id, any_value(skill_id) AS gold, any_value(category) AS category, any_value(instruction_text) AS q FROM match_queries WHERE query_id IS NOT NULL AND instruction_text IS NOT NULL GROUP BY query_id)"""


def _tokens_sql(column: str, kind: str) -> str:
    if kind == "lexical":
        return f"list_filter(regexp_extract_all(lower(coalesce({column}, '')), '[a-z0-9_.-]+'), lambda x: length(x) > 1 AND x NOT IN {_IN})"
    return f"""flatten(list_transform(regexp_extract_all(lower(coalesce({column}, '')), '[a-z0-9]{{2,}}|[一-鿿]+'),
      lambda r: CASE WHEN regexp_matches(r, '^[一-鿿]') AND length(r) > 1 THEN list_transform(range(1, length(r)), lambda i: r[i:i+1]) ELSE [r] END))"""


def bm25_sql(kind: str, k: int, distinct: bool, stop: bool, pad: bool, name: str = "ranked", body: str = "t") -> str:
    """BM25 as a chain of common table expressions ending in ``name(query_id, skill_id, score, rank)``."""
    p = name[0]
    terms = f"list_distinct({_tokens_sql('q', kind)})" if distinct else _tokens_sql("q", kind)
    padding = f" UNION ALL SELECT query_id, skill_id, 0.0 FROM reqs, (SELECT skill_id FROM docs ORDER BY skill_id LIMIT {k}) WHERE (query_id, skill_id) NOT IN (SELECT (query_id, skill_id) FROM {p}sum)" if pad else ""
    return f"""{p}len AS (SELECT skill_id, {_tokens_sql(body, kind)} AS toks FROM docs),
 {p}n AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM {p}len),
 {p}tf AS (SELECT skill_id, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT skill_id, len(toks) AS dl, unnest(toks) AS term FROM {p}len) GROUP BY ALL),
 {p}df AS (SELECT term, count(*) AS df FROM {p}tf GROUP BY term{" HAVING count(*) / (SELECT n FROM " + p + "n) <= 0.5" if stop else ""}),
 {p}w AS (SELECT skill_id, term, ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * tf * 2.5::double / (tf + 1.5::double * (0.25::double + 0.75::double * dl / mean)) AS w FROM {p}tf JOIN {p}df USING (term), {p}n),
 {p}q AS (SELECT query_id, unnest({terms}) AS term FROM reqs),
 {p}sum AS (SELECT query_id, skill_id, round(sum(w), 6) AS score FROM {p}q JOIN {p}w USING (term) GROUP BY ALL{"" if pad else " HAVING round(sum(w), 6) > 0"}),
 {name} AS (SELECT * FROM (SELECT query_id, skill_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, skill_id) AS rank FROM (SELECT * FROM {p}sum{padding})) WHERE rank <= {k})"""


A_SQL = bm25_sql("lexical", 100, True, False, True, "alist")
B_SQL = bm25_sql("bigram", 100, False, True, False, "blist", "concat_ws(' ', name, name, description)")


def lexical_hits(spark, sf_dir, k: int = 100, pad: bool = True, requests: DataFrame | None = None, docs: DataFrame | None = None, carry: list[str] = (), bring: list[str] = (), others: int = 0) -> DataFrame:
    requests = requests_view(spark, sf_dir) if requests is None else requests
    docs = whole_view(spark, sf_dir) if docs is None else docs
    return lexical.bm25(requests, "query_id", text.lexical_tokens("instruction_text"), docs, "skill_id", text.lexical_tokens("t"), k, pad=pad, carry=carry, bring=bring, others=others)


def adaptive_hits(spark, sf_dir, k: int = 100) -> DataFrame:
    """The name twice and the description, ideograph pairs, words of more than half of the records ignored."""
    docs = skills_view(spark, sf_dir).withColumn("t", F.concat_ws(" ", "name", "name", "description"))
    return lexical.bm25(requests_view(spark, sf_dir), "query_id", text.bigram_tokens("instruction_text"), docs, "skill_id", text.bigram_tokens("t"), k, repeated=True, stop_share=0.5)


def both_hits(spark, sf_dir, k: int = 100, pad: bool = True, bring: list[str] = (), fuse: ranker.Fuse | None = None) -> DataFrame:
    """The adaptive (0) and the lexical (1) hits side by side; records are read once for both."""
    short = ranker.Channel(text.bigram_tokens("instruction_text"), text.bigram_tokens(F.concat_ws(" ", "name", "name", "description")), k, repeated=True, stop_share=0.5)
    whole = ranker.Channel(text.lexical_tokens("instruction_text"), text.lexical_tokens("t"), k, pad=pad)
    return ranker.search(requests_view(spark, sf_dir), "query_id", whole_view(spark, sf_dir), "skill_id", [short, whole], bring=bring, fuse=fuse)


@query(f"WITH {VIEW_SQL}, {bm25_sql('lexical', 10, True, False, True, 'alist')} SELECT query_id, skill_id, score, rank FROM alist")
def bm25_lexical_top10(spark, sf_dir):
    """Ten best records of every request; records without any of its terms fill up with score 0."""
    return lexical_hits(spark, sf_dir, 10, docs=whole_view(spark, sf_dir))


@query(f"""WITH {VIEW_SQL}, {bm25_sql('bigram', 10, False, True, False, 'blist', "concat_ws(' ', name, name, description)")} SELECT query_id, skill_id, score, rank FROM blist""")
def bm25_adaptive_top10(spark, sf_dir):
    """Ten best records by name and description; frequent words are learned and ignored."""
    return adaptive_hits(spark, sf_dir, 10)


@query(f"WITH {VIEW_SQL}, t AS (SELECT unnest(list_distinct({_tokens_sql('t', 'lexical')})) AS term FROM docs) SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM docs) + 1)::double / (count(*) + 1)) + 1, 9) AS idf FROM t GROUP BY term")
def doc_frequency_idf(spark, sf_dir):
    """Document frequency and smooth inverse document frequency of every term."""
    docs = skills_view(spark, sf_dir)
    n = docs.count()
    return lexical.document_frequency(docs, "skill_id", text.lexical_tokens("t")).select("term", "df", F.round(F.log((n + 1.0) / (F.col("df") + 1)) + 1, 9).alias("idf"))


@query(f"""WITH {VIEW_SQL}, t AS (SELECT unnest(list_distinct({_tokens_sql('t', 'lexical')})) AS term FROM docs), d AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM docs) + 1)::double / (count(*) + 1)) + 1 AS idf FROM t GROUP BY term),
 e AS (SELECT min(idf) AS lo, max(idf) AS hi FROM d), h AS (SELECT least(floor((idf - lo) / (hi - lo) * 256), 255)::int AS bin, sum(df)::double AS m, any_value(lo) AS lo, any_value(hi) AS hi FROM d, e GROUP BY 1),
 c AS (SELECT bin, lo + (bin + 0.5::double) * (hi - lo) / 256 AS mid, m / sum(m) OVER () AS p FROM h), s AS (SELECT bin, mid, sum(p) OVER (ORDER BY bin) AS c, sum(p * mid) OVER (ORDER BY bin) AS mu, sum(p * mid) OVER () AS total FROM c),
 v AS (SELECT arg_max(mid, round((total * c - mu) * (total * c - mu) / (c * (1 - c)), 9)) AS threshold FROM s WHERE c < 1 - 1e-12)
SELECT term, df, round(idf, 9) AS idf FROM d, v WHERE idf <= threshold""")
def otsu_generic_words(spark, sf_dir):
    """Words below the threshold that best splits the inverse document frequencies (256 bins, weighted by frequency)."""
    docs = skills_view(spark, sf_dir)
    n = docs.count()
    words = lexical.document_frequency(docs, "skill_id", text.lexical_tokens("t")).withColumn("idf", F.log((n + 1.0) / (F.col("df") + 1)) + 1)
    low, high = words.agg(F.min("idf"), F.max("idf")).first()
    threshold = vectors.otsu(words, "idf", "df", low, high)
    return words.filter(F.col("idf") <= threshold).select("term", "df", F.round("idf", 9).alias("idf"))


@query("""WITH q AS (SELECT vec_id AS query, embedding::double[] AS a FROM embeddings WHERE vec_id % 20 = 0), p AS (SELECT query, e.vec_id AS id, round(list_dot_product(a, e.embedding::double[]), 6) AS score FROM q JOIN embeddings e ON e.vec_id <> query)
SELECT query, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM p) WHERE rank <= 10""")
def dense_top10(spark, sf_dir):
    """Ten nearest vectors of every twentieth one, among all."""
    rows = read(spark, sf_dir, "embeddings")
    return matching.nearest(rows.filter("vec_id % 20 = 0"), rows, "vec_id", "embedding", 10)


@query(f"""WITH {VIEW_SQL}, {A_SQL}, {B_SQL},
 az AS (SELECT *, (score - avg(score) OVER (PARTITION BY query_id)) / (stddev_pop(score) OVER (PARTITION BY query_id) + 1e-9) AS z FROM alist),
 bz AS (SELECT *, (score - avg(score) OVER (PARTITION BY query_id)) / (stddev_pop(score) OVER (PARTITION BY query_id) + 1e-9) AS z FROM blist),
 f AS (SELECT query_id, skill_id, round(coalesce(b.z, 0) + 0.3 * coalesce(a.z, 0), 6) AS fused, b.rank AS ra, a.rank AS rb FROM bz b FULL JOIN az a USING (query_id, skill_id))
SELECT query_id, skill_id, fused, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, ra NULLS LAST, rb NULLS LAST) AS rank FROM f) WHERE rank <= 10""")
def score_fusion(spark, sf_dir):
    """Two channels fused by standardised scores (the short-text channel leads, the long-text one has weight 0.3)."""
    return both_hits(spark, sf_dir, fuse=ranker.Fuse(fusion.by_score, [1.0, 0.3], 10, 6))


@query(f"""WITH {VIEW_SQL}, {A_SQL}, {B_SQL}, f AS (SELECT query_id, skill_id, round(coalesce(1.0::double / (60 + b.rank), 0) + 0.3::double * coalesce(1.0::double / (60 + a.rank), 0), 9) AS fused, b.rank AS ra, a.rank AS rb FROM blist b FULL JOIN alist a USING (query_id, skill_id))
SELECT query_id, skill_id, fused, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, ra NULLS LAST, rb NULLS LAST) AS rank FROM f) WHERE rank <= 10""")
def rank_fusion(spark, sf_dir):
    """The same channels fused by reciprocal ranks."""
    return both_hits(spark, sf_dir, fuse=ranker.Fuse(fusion.by_rank, [1.0, 0.3], 10, 9))


@query(f"""WITH {VIEW_SQL}, {bm25_sql('lexical', 20, True, False, False, 'alist')}, {bm25_sql('bigram', 20, False, True, False, 'blist', "concat_ws(' ', name, name, description)")},
 hits AS (SELECT query_id, 'local' AS source, 1 AS so, 1.0::double AS weight, rank, skill_id FROM alist UNION ALL SELECT query_id, 'hub', 2, 0.85::double, rank, skill_id FROM blist),
 named AS (SELECT h.*, coalesce(nullif(trim(d.name), ''), h.skill_id) AS key, weight / (60 + rank) AS claim FROM hits h JOIN docs d USING (skill_id)),
 g AS (SELECT query_id, key, round(sum(claim), 9) AS rrf, string_agg(source, ',' ORDER BY so, rank) AS sources, arg_min(skill_id, (-claim, so, rank)) AS item, min((so, rank)) AS first_at FROM named GROUP BY query_id, key)
SELECT query_id, key, rrf, sources, item, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, first_at) AS rank FROM g) WHERE rank <= 10""")
def weighted_rrf(spark, sf_dir):
    """Two sources of hits fused by weighted reciprocal ranks, collapsed by the record's name."""
    # Lists side by side: local is 1, hub 0; the name comes with the record.  Shuffled
    # once, by request, which also serves the groups and the ranks.
    rows = both_hits(spark, sf_dir, 20, pad=False, bring=["name"]).repartition("query_id")
    lists = F.array(
        F.struct(F.col("rank1").alias("rank"), F.lit("local").alias("source"), F.lit(1).alias("source_order"), F.lit(1.0).alias("weight")),
        F.struct(F.col("rank0").alias("rank"), F.lit("hub").alias("source"), F.lit(2).alias("source_order"), F.lit(0.85).alias("weight")),
    )
    hits = rows.select("query_id", "skill_id", "name", F.inline(lists)).filter("rank IS NOT NULL")
    return fusion.weighted_rrf(hits, "query_id", "name", "skill_id", 10)


def _metrics(spark, sf_dir) -> DataFrame:
    asked = requests_view(spark, sf_dir).filter("skill_id IS NOT NULL")
    # The ranking and its metrics read these requests several times; the records are not reduced again for each.
    known = ranker.kept(asked.join(skills_view(spark, sf_dir).select("skill_id"), "skill_id", "left_semi"))
    gold = known.select("query_id", "skill_id", F.lit(1.0).alias("gain"))
    # Of a request's fifty hits only the gold record counts, so the others end where they were found.
    hits = lexical_hits(spark, sf_dir, 50, requests=known.withColumnRenamed("skill_id", "gold"), docs=whole_view(spark, sf_dir), carry=["gold"]).filter("skill_id = gold").drop("gold")
    got = rankings.per_request(known, hits, gold, "query_id", "skill_id")
    return got.join(known.select("query_id", F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit("all")).alias("group")), "query_id")


METRIC_SQL = f"""{VIEW_SQL}, {bm25_sql('lexical', 50, True, False, True, 'alist')}, known AS (SELECT query_id, gold, coalesce(nullif(trim(category), ''), 'all') AS "group" FROM reqs JOIN docs ON skill_id = gold),
 m AS (SELECT k.query_id, k."group", r.rank FROM known k LEFT JOIN alist r ON r.query_id = k.query_id AND r.skill_id = k.gold)"""


@query(f"""WITH {METRIC_SQL} SELECT query_id, "group", coalesce((rank <= 1)::int, 0)::double AS ndcg_1, coalesce(CASE WHEN rank <= 3 THEN round(1 / log2(rank + 1), 9) END, 0) AS ndcg_3, coalesce(CASE WHEN rank <= 10 THEN round(1 / log2(rank + 1), 9) END, 0) AS ndcg_10,
 coalesce((rank <= 1)::int, 0)::double AS hit_1, coalesce((rank <= 3)::int, 0) / 3.0::double AS precision_3, coalesce(CASE WHEN rank <= 10 THEN 1.0::double / rank END, 0) AS mrr_10, coalesce((rank <= 10)::int, 0)::double AS recall_10,
 coalesce((rank <= 20)::int, 0)::double AS recall_20, coalesce((rank <= 50)::int, 0)::double AS recall_50, coalesce((rank <= 3)::int, 0)::double AS coverage_3, coalesce((rank <= 5)::int, 0)::double AS coverage_5, coalesce((rank <= 10)::int, 0)::double AS coverage_10 FROM m""")
def ir_metrics(spark, sf_dir):
    """Twelve ranking metrics of every request whose gold record is in the pool."""
    return _metrics(spark, sf_dir)


@query(f"""WITH {METRIC_SQL}, g AS (SELECT "group", avg(coalesce((rank <= 10)::int, 0)) AS r, avg(coalesce(CASE WHEN rank <= 10 THEN 1.0::double / rank END, 0)) AS mrr, avg(coalesce((rank <= 1)::int, 0)) AS h FROM m GROUP BY 1)
SELECT count(*) AS groups, round(100 * avg(r), 2) AS recall_10, round(100 * avg(mrr), 2) AS mrr_10, round(100 * avg(h), 2) AS hit_1 FROM g""")
def macro_mrr(spark, sf_dir):
    """Recall, reciprocal rank and hits at 10, averaged over categories."""
    return rankings.macro(_metrics(spark, sf_dir), "group", ["recall_10", "mrr_10", "hit_1"])


@query()
def paired_bootstrap(spark, sf_dir):
    """Difference of two rankings' reciprocal ranks with a bootstrap interval."""
    one = _metrics(spark, sf_dir).select("query_id", "group", F.col("mrr_10").alias("a"), F.col("ndcg_10").alias("b"))
    return rankings.paired_bootstrap(one, "b", "a", "group", draws=200)


@query(f"""WITH {VIEW_SQL}, {bm25_sql('lexical', 20, True, False, False, 'alist')}, pos AS (SELECT query_id, gold FROM reqs JOIN docs ON skill_id = gold),
 tri AS (SELECT skill_id, name, CASE WHEN length(lower(t)) < 3 THEN [] ELSE list_distinct(list_transform(range(1, length(t) - 1), lambda i: lower(t)[i:i+2])) END AS g FROM (SELECT d.skill_id, d.name, description AS t FROM docs d)),
 c AS (SELECT a.query_id, p.gold, a.skill_id, a.score, a.rank, lower(n.name) = lower(g.name) AS same, len(list_intersect(n.g, g.g)) AS i, len(n.g) + len(g.g) - len(list_intersect(n.g, g.g)) AS u FROM alist a JOIN pos p USING (query_id) JOIN tri n ON n.skill_id = a.skill_id JOIN tri g ON g.skill_id = p.gold WHERE a.skill_id <> p.gold),
 k AS (SELECT query_id, skill_id, score, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS r FROM c WHERE NOT coalesce(same, false) AND NOT (CASE WHEN u = 0 THEN 0 ELSE i / u END > 0.6)),
 best AS (SELECT query_id, skill_id, r AS place, false AS positive FROM k WHERE r <= 9),
 has AS (SELECT DISTINCT query_id FROM best)
SELECT query_id, skill_id, place::int AS place, positive FROM best UNION ALL SELECT query_id, gold, 0, true FROM pos JOIN has USING (query_id)""")
def reranker_candidates(spark, sf_dir):
    """Training candidates of every request: the gold record and up to nine of its
    best other hits that are no hidden positives (same name, or descriptions with
    more than 0.6 of their letter trigrams in common)."""
    # Names and trigrams come with request and record, so no hit is shuffled before the nine are chosen.
    docs = whole_view(spark, sf_dir).withColumn("_g", text.char_grams(F.coalesce("description", F.lit(""))))
    asked = requests_view(spark, sf_dir).withColumnRenamed("skill_id", "gold").join(docs.select(F.col("skill_id").alias("gold"), F.col("name").alias("_pn"), F.col("_g").alias("_pg")), "gold")
    pairs = lexical_hits(spark, sf_dir, 20, pad=False, requests=asked, docs=docs, carry=["gold", "_pn", "_pg"], bring=["name", "_g"]).filter("skill_id <> gold")
    hidden = F.coalesce(F.lower("name") == F.lower("_pn"), F.lit(False)) | (text.jaccard(F.col("_g"), F.col("_pg")) > 0.6)
    kept = records.top_per_key(pairs.filter(~hidden).select("query_id", "gold", "skill_id", F.col("rank").alias("_r")), ["query_id"], [F.col("_r")], 9, "place")
    # The gold record goes before the first of the others, where there is one.
    row = lambda key, place, positive: F.struct(F.col(key).alias("skill_id"), place.cast("int").alias("place"), F.lit(positive).alias("positive"))
    other = row("skill_id", F.col("place"), False)
    return kept.select("query_id", F.inline(F.when(F.col("place") == 1, F.array(row("gold", F.lit(0), True), other)).otherwise(F.array(other))))


@query()
def hard_negatives(spark, sf_dir):
    """Seven hard negatives from a request's fifty best hits and three others, drawn
    among all records outside these hits (the same every time)."""
    # Name and hashed grams come with request and record, so no hit is shuffled before the seven are chosen.
    docs = whole_view(spark, sf_dir).withColumn("_g", F.transform(text.grams(text.lexical_tokens("t"), 3), lambda g: F.xxhash64(g)))
    asked = requests_view(spark, sf_dir).withColumnRenamed("skill_id", "gold").join(docs.select(F.col("skill_id").alias("gold"), F.col("name").alias("_pn"), F.col("_g").alias("_pg")), "gold")
    # One more is drawn than is wanted, for the gold record may be drawn.
    rows = lexical_hits(spark, sf_dir, 50, pad=False, requests=asked, docs=docs, carry=["gold", "_pn", "_pg"], bring=["name", "_g"], others=4)
    rows = rows.filter("skill_id <> gold").withColumnRenamed("name", "_n")
    prefix = (F.length("_n") > 5) & (F.length("_pn") > 5) & (F.lower(F.left("_n", F.lit(5))) == F.lower(F.left("_pn", F.lit(5))))
    hidden = (text.jaccard(F.col("_g"), F.col("_pg")) > 0.6) | F.coalesce(prefix, F.lit(False))
    kind = F.when(F.col("other").isNull(), "hard").otherwise("random")
    chosen = rows.filter(F.col("other").isNotNull() | ~hidden).select("query_id", "skill_id", kind.alias("kind"), F.coalesce("other", "rank").alias("_r"))
    return records.top_per_key(chosen, ["query_id", "kind"], [F.col("_r")], 7, "place").filter("kind = 'hard' OR place <= 3").select("query_id", "skill_id", "kind")


@query(f"""WITH {VIEW_SQL}, s AS (SELECT skill_id, unnest(list_filter(list_transform(string_split(regexp_replace(body, '\\n(#{{1,3}} )', chr(1) || '\\1', 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) >= 200)) AS section FROM now WHERE NOT deleted)
SELECT skill_id, count(*) AS sections, max(length(section)) AS longest FROM s GROUP BY skill_id""")
def sections_heading(spark, sf_dir):
    """Number and greatest length of the sections of 200 characters or more."""
    rows = now(spark, sf_dir, "body", "deleted").filter("NOT deleted").select("skill_id", F.explode(text.heading_sections("body")).alias("section"))
    return rows.groupBy("skill_id").agg(F.count("*").alias("sections"), F.max(F.length("section")).alias("longest"))


@query(f"""WITH {VIEW_SQL}, s AS (SELECT skill_id, unnest(list_filter(list_transform(string_split(regexp_replace(body, '\\n(#{{1,3}} )', chr(1) || '\\1', 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) >= 200)) AS section FROM now WHERE NOT deleted),
 q AS (SELECT query_id, gold, list_distinct({_tokens_sql('q', 'lexical')}) AS w FROM reqs),
 v AS (SELECT query_id, gold, max(round(len(list_intersect(w, list_distinct({_tokens_sql('section', 'lexical')}))) / greatest(1, len(w))::double, 9)) AS best FROM q JOIN s ON s.skill_id = gold GROUP BY ALL)
SELECT q.query_id, coalesce(best, round(len(list_intersect(w, list_distinct({_tokens_sql('t', 'lexical')}))) / greatest(1, len(w))::double, 9)) AS best, best IS NOT NULL AS by_section FROM q JOIN docs d ON d.skill_id = gold LEFT JOIN v USING (query_id)""")
def section_best_score(spark, sf_dir):
    """The best section of each request's gold record by the share of the request's
    words it holds; a record without sections counts as a whole."""
    docs = skills_view(spark, sf_dir)
    asked = requests_view(spark, sf_dir).select("query_id", "skill_id", F.array_distinct(text.lexical_tokens("instruction_text")).alias("w"))
    share = lambda t: F.round(text.overlap_share(F.col("w"), text.lexical_tokens(t)), 9)
    parts = asked.join(docs.select("skill_id", F.explode(text.heading_sections("body")).alias("section")), "skill_id")
    best = parts.groupBy("query_id").agg(F.max(share("section")).alias("_b"))
    return asked.join(docs.select("skill_id", "t"), "skill_id").join(best, "query_id", "left").select("query_id", F.coalesce("_b", share("t")).alias("best"), F.col("_b").isNotNull().alias("by_section"))


@query()
def keyword_relevance(spark, sf_dir):
    """The keyword guard between each request and its gold record: matched terms and their share."""
    docs = skills_view(spark, sf_dir).select("skill_id", F.concat_ws(" ", "name", "description", "tags").alias("_hay"))
    rows = requests_view(spark, sf_dir).join(docs, "skill_id").withColumn("r", text.relevance("instruction_text", F.col("_hay")))
    return rows.select("query_id", F.col("r.passed").alias("passed"), F.array_join("r.matched", ",").alias("matched"), F.round("r.ratio", 6).alias("ratio"))


@query(f"""WITH {VIEW_SQL}, p AS (SELECT query_id, q, d.description AS t FROM reqs JOIN docs d ON skill_id = gold),
 g AS (SELECT query_id, list_distinct(list_transform(range(1, greatest(length(q) - 1, 1)), lambda i: lower(q)[i:i+2])) AS a, list_distinct(list_transform(range(1, greatest(length(t) - 1, 1)), lambda i: lower(t)[i:i+2])) AS b FROM p WHERE t IS NOT NULL)
SELECT query_id, round(CASE WHEN len(a) + len(b) = 0 THEN 0 ELSE len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))::double END, 9) AS jaccard FROM g""")
def jaccard_trigram_pairs(spark, sf_dir):
    """Letter trigrams that each request and its gold record's description have in common."""
    rows = requests_view(spark, sf_dir).join(skills_view(spark, sf_dir).select("skill_id", "description"), "skill_id").filter("description IS NOT NULL")
    return rows.select("query_id", F.round(text.jaccard(text.char_grams("instruction_text"), text.char_grams("description")), 9).alias("jaccard"))


@query(f"""WITH {NOW_SQL}, t AS (SELECT skill_id, {_tokens_sql("concat_ws(' ', name, description)", 'bigram')} AS b, list_filter(regexp_extract_all(lower(coalesce(description, '')), '[a-z][a-z0-9_]{{2,}}'), lambda x: x NOT IN ({", ".join(repr(w) for w in text.CONTENT_STOP)})) AS c, body FROM now)
SELECT skill_id, array_to_string(b, ' ') AS bigrams, array_to_string(c, ' ') AS content, greatest(1, length(body) // 4)::int AS rough_tokens FROM t""")
def token_views(spark, sf_dir):
    """Tokens of name and description by the ideograph-aware tokenizer, content words, and a rough token count."""
    rows = now(spark, sf_dir, "name", "description", "body")
    return rows.select(
        "skill_id", F.array_join(text.bigram_tokens(F.concat_ws(" ", "name", "description")), " ").alias("bigrams"),
        F.array_join(text.content_words("description"), " ").alias("content"), text.rough_tokens("body").alias("rough_tokens"),
    )
