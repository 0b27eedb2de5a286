"""Text functions as Catalyst expressions; none needs Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Stop words of the whole-document tokenizer.
LEXICAL_STOP = """a an the of to in for and or is are be with on at by from this that it as
we you your i they them our their using use used can will should would if then when
which what how not no all any each such other than more most some""".split()

# Stop words of the content-word measure.
CONTENT_STOP = """the a an and or of to in for with on at by from as is are be was were this that these those
it its into your you i we they he she his her their our not no if then than so such can could may might
will would shall should must do does did done have has had been being but about over under more most
other some any each both few all own same too very just only also then once here there when where why how
what which who whom whose use using used make makes made get gets got please need needs want wants""".split()

# Words that make no tag.
TAG_STOP = """the and for this that with from into your
yours you use using used when whenever what
which how where why here there their them
have has had having are was were been being
must should would could will can may might do
does did doing done but not than then also
out off over under such same other another more
most any all some every each few many
skill skills task tasks help helps helper
description name claude agent agents user users
tool tools return returns function functions
create created creating generate generates generated
produce produced work works working need needs
needed etc want wants anything something
file files data input output result results
type types step steps way ways example examples
case cases setup support supports supported""".split()

# Stop words, aliases and generic words of the keyword guard.
QUERY_STOP = """a an the to for with using use create make help please and or of in on my me i want need how can from
this that these those such no 帮我 请 一个 一下 如何 怎么 使用 需要 想要 进行""".split()
QUERY_ALIASES = {
    "k8s": ["kubernetes"], "pr": ["pull", "request"], "ppt": ["powerpoint"], "pptx": ["powerpoint"],
    "postgres": ["postgresql"], "transcription": ["transcribe"],
}
QUERY_GENERIC = """extract review deploy deployment generate generator analysis optimize optimization process processing
data code task""".split()


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words_array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


# ---- normal forms, hashes, identifiers


def normalize_body(body: ColumnLike) -> Column:
    """Lines trimmed, inner blanks collapsed, blank lines dropped; null stays null."""
    lines = F.split(col(body), r"\r\n|[\n\r]")
    tidy = F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.array_join(F.filter(tidy, lambda x: x != ""), "\n")


def content_hash(body: ColumnLike) -> Column:
    return F.sha2(normalize_body(body), 256)


def canonical_name(name: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.trim(col(name))), "[^a-z0-9]+", " "))


def name_hash(name: ColumnLike) -> Column:
    return F.sha2(canonical_name(name), 256)


def slug(name: ColumnLike) -> Column:
    dashed = F.trim(F.lower(F.regexp_replace(col(name), "[^A-Za-z0-9]+", "-")), F.lit("-"))
    return F.coalesce(F.nullif(dashed, F.lit("")), F.lit("unnamed"))


def record_id(source: ColumnLike, name: ColumnLike, hash_: ColumnLike) -> Column:
    return F.concat_ws("__", col(source), slug(name), F.substring(col(hash_), 1, 8))


def safe_dir(source: ColumnLike, slug_: ColumnLike) -> Column:
    """Directory name of an installed record: ASCII letters kept, and eight digits of the identity's hash."""
    identity = F.concat(col(source), F.lit("/"), col(slug_))
    kept = F.regexp_replace(F.concat(col(source), F.lit("__"), col(slug_)), "[^A-Za-z0-9_.@-]", "_")
    return F.concat(kept, F.lit("__"), F.substring(F.sha2(identity, 256), 1, 8))


def rough_tokens(body: ColumnLike) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(col(body)) / 4).cast("int"))


def head(text: ColumnLike, n: int, more: str = " ...") -> Column:
    """The first ``n`` characters, with a sign that there were more."""
    return F.when(F.length(col(text)) > n, F.concat(F.rtrim(F.substring(col(text), 1, n)), F.lit(more))).otherwise(F.rtrim(F.coalesce(col(text), F.lit(""))))


def catalog_line(text: ColumnLike, n: int = 200) -> Column:
    return F.when(F.length(col(text)) > n, F.concat(F.substring(col(text), 1, n - 3), F.lit("..."))).otherwise(col(text))


def strip_front_matter(body: ColumnLike) -> Column:
    return F.regexp_replace(col(body), r"(?s)\A---\n.*?\n---\s*\n?", "")


def embedding_text(name: ColumnLike, description: ColumnLike, body: ColumnLike, desc_max: int = 500, body_max: int = 8000) -> Column:
    """The text an encoder is given: its limits are the encoder's window."""
    return F.concat(col(name), F.lit(" | "), F.substring(col(description), 1, desc_max), F.lit(" | "), F.substring(strip_front_matter(body), 1, body_max))


# ---- tokens


def lexical_tokens(text: ColumnLike) -> Column:
    """Tokens of the whole-document index: letters, digits, ``_ - .``, two or more, no stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(col(text), F.lit(""))), F.lit(r"[a-z0-9_\-.]+"), 0)
    return F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(LEXICAL_STOP))


def bigram_tokens(text: ColumnLike) -> Column:
    """Latin words of two or more letters, and overlapping pairs of ideographs."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(col(text), F.lit(""))), F.lit(r"[a-z0-9]{2,}|[一-鿿]+"), 0)
    pairs = lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))
    cut = lambda r: F.when(r.rlike(r"^[一-鿿]") & (F.length(r) > 1), pairs(r)).otherwise(F.array(r))
    return F.flatten(F.transform(runs, cut))


def content_words(text: ColumnLike) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(col(text), F.lit(""))), F.lit(r"[a-z][a-z0-9_]{2,}"), 0)
    stop = words_array(CONTENT_STOP)
    return F.filter(found, lambda t: ~F.array_contains(stop, t))


def grams(items: Column, n: int, joiner: str = " ") -> Column:
    """Distinct runs of ``n`` array elements; an array that is too short has none.

    The array is zipped with itself shifted, as inside a lambda it would be computed
    anew for every element."""
    size = F.size(items)
    shifted = [F.slice(items, F.lit(k + 1), F.greatest(size - k, F.lit(0))).alias(f"g{k}") for k in range(n)]
    runs = F.slice(F.arrays_zip(*shifted), F.lit(1), F.greatest(size - n + 1, F.lit(0)))
    return F.array_distinct(F.transform(runs, lambda z: F.concat_ws(joiner, *[z[f"g{k}"] for k in range(n)])))


def char_grams(text: ColumnLike, n: int = 3) -> Column:
    t = F.lower(col(text))
    starts = F.when(F.length(t) >= n, F.sequence(F.lit(1), F.length(t) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(t, i, F.lit(n))))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def overlap_share(wanted: Column, given: Column) -> Column:
    """Share of the distinct wanted words that are given."""
    return F.size(F.array_intersect(wanted, given)) / F.greatest(F.lit(1), F.size(F.array_distinct(wanted)))


def tags(front_tags: Column, category: Column, name: ColumnLike, description: ColumnLike, most: int = 5) -> Column:
    """Front-matter tags, category, name parts and long description words, in this order."""
    empty = F.array().cast("array<string>")
    words = F.filter(F.regexp_extract_all(F.coalesce(col(description), F.lit("")), F.lit("[a-zA-Z][a-zA-Z0-9+#]{1,}"), 0), lambda w: F.length(w) >= 4)
    all_ = F.concat(
        F.coalesce(front_tags, empty), F.when(category.isNotNull(), F.array(category)).otherwise(empty),
        F.split(F.coalesce(col(name), F.lit("")), r"[-_\s/.]+"), words,
    )
    tidy = F.transform(all_, lambda t: F.lower(F.trim(t)))
    stop = words_array(TAG_STOP)
    return F.slice(F.array_distinct(F.filter(tidy, lambda t: (F.length(t) >= 2) & ~F.array_contains(stop, t))), 1, most)


# ---- keyword guard


def light_stem(t: Column) -> Column:
    return (
        F.when(t.endswith("ies") & (F.length(t) > 4), F.concat(F.substring(t, F.lit(1), F.length(t) - 3), F.lit("y")))
        .when(t.endswith("ing") & (F.length(t) > 5), F.substring(t, F.lit(1), F.length(t) - 3))
        .when(t.endswith("ed") & (F.length(t) > 4), F.substring(t, F.lit(1), F.length(t) - 2))
        .when(t.endswith("s") & (F.length(t) > 4) & ~t.rlike("(ss|us|is|es)$"), F.substring(t, F.lit(1), F.length(t) - 1))
        .otherwise(t)
    )


def query_terms(query: ColumnLike) -> Column:
    """Ordered distinct terms of a query: ideograph pairs, aliases, light stems, no stop words."""
    chunks = F.regexp_extract_all(F.lower(F.coalesce(col(query), F.lit(""))), F.lit(r"[a-z0-9+#.\-]+|[㐀-䶿一-鿿]+"), 0)
    cjk = lambda c: c.rlike(r"^[㐀-䶿一-鿿]+$") & (F.length(c) >= 2)
    pairs = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))
    raw = F.flatten(F.transform(chunks, lambda c: F.when(cjk(c), pairs(c)).otherwise(F.array(c))))
    stop = words_array(QUERY_STOP)
    kept = F.filter(raw, lambda t: (F.length(t) >= 2) & ~F.array_contains(stop, t))
    bare = F.transform(kept, lambda t: F.regexp_replace(t, r"^[.\-]+|[.\-]+$", ""))
    known = F.create_map(*[x for k, v in QUERY_ALIASES.items() for x in (F.lit(k), words_array(v))])
    terms = F.flatten(F.transform(bare, lambda t: F.coalesce(F.try_element_at(known, t), F.array(light_stem(t)))))
    return F.array_distinct(F.filter(terms, lambda t: (t != "") & ~F.array_contains(stop, t)))


def holds_term(text: Column, term: Column) -> Column:
    """Latin terms must stand as words of their own, others may be anywhere."""
    latin = term.rlike(r"^[a-z0-9+#.\-]+$")
    alone = F.rlike(text, F.concat(F.lit(r"(^|[^a-z0-9])\Q"), term, F.lit(r"\E([^a-z0-9]|$)")))
    return F.when(latin, alone).otherwise(text.contains(term))


def relevance(query: ColumnLike, haystack: Column) -> Column:
    """Struct ``(passed, matched, ratio)`` of the keyword guard."""
    terms = query_terms(query)
    text = F.lower(haystack)
    matched = F.filter(terms, lambda t: holds_term(text, t))
    generic = words_array(QUERY_GENERIC)
    required = F.filter(terms, lambda t: ~F.array_contains(generic, t))
    firm = (F.size(required) == 0) | F.arrays_overlap(matched, required)
    enough = F.size(matched) >= F.when(F.size(terms) >= 4, 2).otherwise(1)
    return F.struct(
        ((F.size(terms) > 0) & firm & enough).alias("passed"), matched.alias("matched"),
        F.when(F.size(terms) > 0, F.size(matched) / F.size(terms)).otherwise(0.0).alias("ratio"),
    )


# ---- sections and windows


def heading_sections(body: ColumnLike, least: int = 200) -> Column:
    """Pieces that start at headings of level 1 to 3, without the short ones."""
    return F.filter(F.transform(F.split(col(body), r"\n(?=#{1,3} )"), F.trim), lambda p: F.length(p) >= least)


def paragraph_windows(body: ColumnLike, size: int = 1200, least: int = 200) -> Column:
    """Whole paragraphs gathered until ``size`` characters are reached."""
    paras = F.filter(F.split(col(body), r"\n\s*\n"), lambda p: F.trim(p) != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        text = F.when(acc["open"] == "", p).otherwise(F.concat(acc["open"], F.lit("\n\n"), p))
        full = F.length(text) >= size
        return F.struct(F.when(full, F.concat(acc["done"], F.array(text))).otherwise(acc["done"]).alias("done"), F.when(full, F.lit("")).otherwise(text).alias("open"))

    end = lambda acc: F.when(F.trim(acc["open"]) != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
    return F.filter(F.aggregate(paras, start, step, end), lambda p: F.length(F.trim(p)) >= least)


def sections(body: ColumnLike) -> Column:
    """Heading sections if there are two or more, else paragraph windows, else the whole body."""
    by_heading, by_window = heading_sections(body), paragraph_windows(body)
    return F.when(F.size(by_heading) >= 2, by_heading).when(F.size(by_window) > 0, by_window).otherwise(F.array(col(body)))


def word_windows(words: Column, size: int = 80) -> Column:
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, F.lit(size)), " "))


def without_words(text: ColumnLike, words: Column) -> Column:
    """The text's blank-separated tokens without those whose lower-case letters are among ``words``."""
    tokens = F.filter(F.split(col(text), r"\s+"), lambda t: t != "")
    return F.array_join(F.filter(tokens, lambda t: ~F.array_contains(words, F.regexp_replace(F.lower(t), "[^a-z0-9_]", ""))), " ")
