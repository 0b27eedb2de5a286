"""Problem 8: texts cut off by field limits or broken transfers.

Three sources of evidence meet in one log-odds per text:

* Length.  Per source, a log-normal distribution of lengths, right-censored at a
  candidate limit, is fitted by maximum likelihood to the source's histogram
  (in characters and in bytes).  A value at the limit is censored with the
  posterior that the fit gives: texts beyond expectation at exactly that length.
* Form.  How the last line ends: an open code block or front matter, a mark that
  was added at the cut, a line of prose without an end, or a complete list item,
  table row, link or signature.  What each form says is fitted as well: texts at
  fitted limits show with which forms cuts end, the others with which forms
  texts end; the shares of both kinds and the shares of forms in them are found
  together by expectation-maximisation over all texts.  A block left open and a
  mark of a cut are cuts, a complete end is none, by the problem's statement.
* Wording.  How often the last word ends a sentence or line anywhere in the
  corpus, against how often it occurs at all and how often it would be left over
  from cutting a longer word.  A sentence with which many texts trail off is a
  stock phrase; what cuts leave over seldom repeats.

Copies of one text share the strongest evidence of any of them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import Words, clean_source, cut, table

#: Share of cut texts expected where length says nothing.
PRIOR = 0.05
#: Fewest texts at one length that may be a limit: one alone shows none.
LEAST_AT_LIMIT = 2
#: Lengths of which one is expected to be a limit.
LENGTHS_PER_LIMIT = 20_000

_MARK = re.compile(
    r"\s*(?:(?:\.{3}|…)\s*)?(?:[\[(<]\s*(?:\.{3}|…|[^\[\](){}<>\n]{0,40}\b(?:truncat\w+|cut|snip(?:ped)?|omitted|more|continued|cont|gekürzt|abgeschnitten|truncado|recortado|tronqué|coupé|suite|mehr|más)\b[^\[\](){}<>\n]{0,40})\s*[\])>]"
    r"|(?<=[\s.…])(?:read more|show more|continue reading|see more|view more|weiterlesen|mehr anzeigen|leer más|ver más|lire la suite|阅读全文|查看更多))\s*\Z",
    re.I,
)
_DOTS = re.compile(r"\s*[,;]?\s*(?:\.{3,}|…+)\s*\Z")
_ROLE = re.compile(r"^\s*(?:user|assistant|system|tool|human|ai|judge)\s*:\s*", re.I)
_ITEM = re.compile(r"^\s*(?:[-*+•]|\d+[.)])\s+")
_HEADING = re.compile(r"^\s*#{1,6}\s")
_LINK = re.compile(r"(?:https?://|www\.)\S+\Z|\S+/\S*\.\w{1,5}\Z|\S+@\S+\.\w+\Z|\[[^\]\n]*\]\([^)\n]+\)\Z", re.I)
_SIGNED = re.compile(r"^\s*(?:--|—|–|~)\s*\S|^\s*(?:best|regards|cheers|thanks|signed|grüße|saludos|cordialement)\b.{0,40}\Z", re.I)
_END = re.compile(r"[.!?。！？‽؟।]\Z")
_CLOSERS = " \t\"'”’»)]}*_`>）」』"
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_FENCE = re.compile(r"^[^\S\n]*(```|~~~)([^\n]*)", re.M)
_CLOSE = re.compile(r"\n[^\S\n]*(?:---|\.\.\.)[^\S\n]*(?:\n|\Z)")
_SENTENCE = re.compile(r"[.!?。！？]\s")
_RUN = re.compile(r"[^\W_]+")


def last_word(line: str) -> str:
    """The last word of a line, or its last two characters in scripts without blanks;
    empty if the line ends in no word."""
    start = len(line)
    while start and line[start - 1].isalnum():
        start -= 1
    word = line[start:].lower()
    return word[-2:] if word and _CJK.match(word[-1]) else word


def tail(body: str) -> str:
    """The last words, twelve at most, of the sentence in which ``body`` ends."""
    line = body[body.rfind("\n") + 1 :]
    ends = [m.end() for m in _SENTENCE.finditer(line)]
    return " ".join(_RUN.findall(line[ends[-1] if ends else 0 :].lower())[-12:])


def ending(text: str) -> tuple[str, str]:
    """Form of a text's end and its last word.

    Forms: ``open`` (code or front matter left open), ``marked`` (an explicit mark
    of a cut), ``dots``, ``prose`` and ``broken`` (a sentence or row without its
    end), ``item`` (a line that needs no full stop), ``colon``,
    ``link``, ``signed``,
    ``whole`` (complete), ``empty``.
    """
    body = text.rstrip()
    if not body:
        return "empty", ""
    start = body.rfind("\n") + 1
    # The last line with the break before it; what is looked for reaches no further back.
    end = body[max(0, start - 1) :]
    if _MARK.search(end):
        return "marked", ""
    dots = _DOTS.search(end)
    if body.startswith("---\n") and not _CLOSE.search(body, 3):
        return "open", ""
    if "```" in body or "~~~" in body:
        fence = ""
        for m in _FENCE.finditer(body):
            if not fence:
                fence = m[1]
            elif m[1] == fence and not m[2].strip("`~ \t\r"):
                fence = ""
        if fence:
            return "open", ""
    if dots:
        return "dots", last_word(_DOTS.sub("", body[:start] + body[start:][: max(0, dots.start() - (1 if start else 0))]).rstrip(" \t\n,;"))
    line = _ROLE.sub("", body[start:]).strip()
    if not line or set(line) <= set("`~-=*_"):
        return "whole", ""
    if line.startswith("|"):
        return ("whole" if line.endswith("|") and len(line) > 1 else "broken"), ""
    if _SIGNED.search(line):
        return "signed", last_word(line)
    if _LINK.search(line):
        return "link", ""
    bare = line.rstrip(_CLOSERS)
    if _END.search(bare):
        return "whole", ""
    if bare.endswith((":", "：")):
        return "colon", ""
    if _ITEM.match(line) or _HEADING.match(line):
        return ("item", last_word(bare)) if last_word(bare) else ("broken", "")
    return "prose", last_word(bare)


#: How cut and entire texts are expected to end before any is seen, as shares, and
#: for how many texts each expectation stands beside those counted.
CUT_FORM = {"prose": 0.8, "broken": 0.02, "colon": 0.005, "item": 0.03, "dots": 0.14, "link": 0.003, "signed": 0.002}
ENTIRE_FORM = {"prose": 2e-4, "broken": 1e-4, "colon": 0.005, "item": 0.05, "dots": 0.01, "link": 0.05, "signed": 0.03}
EXPECTED = 20.0
#: Forms that the problem's statement settles: complete ends, and blocks left open or marks of a cut.
SETTLED = {"whole": -30.0, "empty": -30.0, "open": 12.0, "marked": 12.0}


def form_weights(counts: list[tuple[str, float, int]], rounds: int = 200) -> tuple[dict[str, float], float]:
    """Log-odds that each form adds for a cut, and the share of cut texts away from limits.

    ``counts`` has the number of texts per form and posterior of their length.
    Expectation-maximisation over the two kinds of texts; the forms that the
    problem's statement settles keep their ``SETTLED`` weights."""
    forms = list(CUT_FORM)
    levels = np.array(sorted({p for _, p, _ in counts} | {0.0}))
    place = {p: k for k, p in enumerate(levels.tolist())}
    n = np.zeros((len(forms), len(levels)))
    for f, p, k in counts:
        if f in CUT_FORM:
            n[forms.index(f), place[p]] += k
    complete = sum(k for f, _, k in counts if SETTLED.get(f, 0) < 0)
    settled_cut = sum(k for f, _, k in counts if SETTLED.get(f, 0) > 0)
    expect_cut, expect_entire = np.array(list(CUT_FORM.values())), np.array([ENTIRE_FORM[f] for f in forms])
    cut_share, entire_share, base = expect_cut, expect_entire, PRIOR
    far = levels < 0.5
    for _ in range(rounds):
        prior = np.maximum(base, levels)[None, :]
        ahead = prior * cut_share[:, None]
        r = ahead / (ahead + (1 - prior) * entire_share[:, None])
        cut_n, entire_n = (n * r).sum(axis=1) + EXPECTED * expect_cut, (n * (1 - r)).sum(axis=1) + EXPECTED * expect_entire
        cut_share = cut_n / cut_n.sum()
        entire_share = entire_n / (entire_n.sum() + complete + EXPECTED * (1 - expect_entire.sum()))
        base = ((n * r)[:, far].sum() + settled_cut + EXPECTED * PRIOR) / (n[:, far].sum() + settled_cut + complete + EXPECTED)
        base = float(np.clip(base, 0.005, 0.5))
    return dict(zip(forms, np.log(cut_share / entire_share).tolist())) | SETTLED, base


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            body = (text or "").rstrip()
            form, word = ending(body)
            raw = body.encode("utf-8", "replace")
            rows.append((form, word, tail(_DOTS.sub("", body)) if form == "dots" else None, len(body), len(text or ""), len(raw), hashlib.md5(raw, usedforsecurity=False).digest()))
        form, word, last, chars, chars_raw, size, digest = zip(*rows) if rows else ([],) * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(form, pa.string()), pa.array(word, pa.string()), pa.array(last, pa.string()), pa.array(chars, pa.int32()), pa.array(chars_raw, pa.int32()), pa.array(size, pa.int32()), pa.array(digest, pa.binary())],
            ["_doc", "_src", "form", "word", "tail", "chars", "chars_raw", "bytes", "digest"],
        )


_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in " \n\r\t"]] = True


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word its occurrences and its stops (before a full stop or line end, but
    for the text's own end); scripts without blanks count by pairs of characters."""
    for batch in batches:
        words = Words(batch.column(0))
        if not len(words.hash):
            continue
        raw = np.concatenate([words.raw, np.full(2, 10, np.uint8)])
        after, then = raw[words.stop], raw[words.stop + 1]
        stops = (after == 10) | (after == 13) | (_STOP[after] & _BLANK[then])
        own_end = np.zeros(len(stops), bool)
        own_end[words.offset[1:][words.count > 0] - 1] = True
        _, first, code = np.unique(words.hash, return_index=True, return_inverse=True)
        n_stop = np.bincount(code, weights=stops & ~own_end)
        n_inner = np.bincount(code, weights=~own_end)
        data = words.raw.tobytes()
        found = [data[a:b].decode("utf-8", "replace") for a, b in zip(words.start[first].tolist(), words.stop[first].tolist())]
        pairs: dict[str, list[float]] = {}
        plain = np.ones(len(found), bool)
        for k, word in enumerate(found):
            if not word.isascii() and _CJK.match(word[-1]):
                plain[k] = False
                for i in range(len(word) - 1):
                    pairs.setdefault(word[i : i + 2], [0.0, 0.0])[0] += n_inner[k]
                pairs.setdefault(word[-2:], [0.0, 0.0])[1] += n_inner[k]
        word = [w for w, p in zip(found, plain) if p] + list(pairs)
        n = np.r_[n_inner[plain], [v[0] for v in pairs.values()]]
        stop = np.r_[n_stop[plain], [v[1] for v in pairs.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(n, pa.float64()), pa.array(stop, pa.float64())], ["word", "n", "stops"])


def censored_fit(count: np.ndarray, s1: np.ndarray, s2: np.ndarray, censored: np.ndarray, limit: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood log-normal ``(mu, sigma)`` of right-censored lengths.

    ``count``, ``s1`` and ``s2`` are number, sum and sum of squares of the log
    lengths of uncensored values; ``censored`` values are only known to reach
    ``limit``.  Expectation-maximisation, all rows at once."""
    at = np.log(limit)
    total = np.maximum(count + censored, 1e-9)
    mu = np.where(count > 0, s1 / np.maximum(count, 1), at)
    sigma = np.sqrt(np.maximum(np.where(count > 1, s2 / np.maximum(count, 1) - mu**2, 0.25), 0.01))
    for _ in range(steps):
        z = (at - mu) / sigma
        tail = np.maximum(_upper(z), 1e-300)
        ratio = np.exp(-0.5 * z**2) / math.sqrt(2 * math.pi) / tail
        ratio = np.where(z > 30, z + 1 / z, ratio)
        mean = mu + sigma * ratio
        square = mu**2 + sigma**2 + sigma * (at + mu) * ratio
        mu = (s1 + censored * mean) / total
        sigma = np.sqrt(np.maximum((s2 + censored * square) / total - mu**2, 0.01))
    return mu, sigma


def _upper(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.vectorize(math.erfc)(z / math.sqrt(2))


def limits(lengths: DataFrame) -> DataFrame:
    """Candidate limits ``(_src, unit, size, posterior, at_limit, mu, sigma)`` from
    a histogram ``(_src, unit, size, n)``: lengths that more texts of the source
    have than its fitted distribution explains.  Limits of fewer than
    ``LEAST_AT_LIMIT`` texts are not told from chance."""
    log = F.log("size")
    per = Window.partitionBy("_src", "unit")
    below = per.orderBy("size").rangeBetween(Window.unboundedPreceding, -1)
    table_ = lengths.filter("size > 0").select(
        "_src", "unit", "size", "n",
        F.sum("n").over(below).alias("count"), F.sum(F.col("n") * log).over(below).alias("s1"), F.sum(F.col("n") * log * log).over(below).alias("s2"),
        F.sum("n").over(per).alias("all"),
    )
    spikes = table_.filter(F.col("n") >= LEAST_AT_LIMIT).na.fill(0)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            size = rows["size"].to_numpy(float)
            over = (rows["all"] - rows["count"]).to_numpy(float)
            mu, sigma = censored_fit(rows["count"].to_numpy(float), rows["s1"].to_numpy(float), rows["s2"].to_numpy(float), over, size)
            density = np.exp(-0.5 * ((np.log(size) - mu) / sigma) ** 2) / (sigma * math.sqrt(2 * math.pi) * size)
            n = rows["n"].to_numpy(float)
            expected = np.maximum(rows["all"].to_numpy(float) * density, 1e-6)
            # That the length is a limit at all, one in LENGTHS_PER_LIMIT being one, and then that this text was censored.
            ratio = np.where(n > expected, n * np.log(n / expected) - (n - expected), 0.0) - math.log(LENGTHS_PER_LIMIT)
            posterior = np.clip((1 - expected / n) / (1 + np.exp(-np.clip(ratio, -50, 50))), 1e-4, 0.999)
            yield rows[["_src", "unit", "size", "n"]].assign(posterior=posterior, mu=mu, sigma=sigma)

    found = spikes.mapInPandas(fit, "_src string, unit string, size int, n long, posterior double, mu double, sigma double")
    return found.withColumnRenamed("n", "at_limit")


def cut_texts(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """Evidence on every document: ``(doc_id, source, form, at_limit, log_odds, is_cut)``.

    Null and empty texts are complete; a null source is a source of its own;
    repeated rows are judged alike; an empty table gives an empty result; whole
    texts are read and further columns are ignored.
    """
    docs = documents.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"), clean_source(source).alias("_src"))
    kind = docs.schema["_doc"].dataType.simpleString()
    ends = cut(docs.mapInArrow(_endings, f"_doc {kind}, _src string, form string, word string, tail string, chars int, chars_raw int, bytes int, digest binary"))
    # Copies of one text within a source count once, so that they make no limit.
    apart = ends.select(F.coalesce("_src", F.lit("")).alias("_src"), "digest", "chars", "bytes").distinct()
    histogram = apart.select("_src", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("size")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("size")))).alias("u"))
    histogram = histogram.groupBy("_src", "u.unit", "u.size").agg(F.count("*").alias("n"))
    known = cut(limits(histogram))
    by_chars = known.filter("unit = 'chars'").select("_src", F.col("size").alias("chars"), F.col("posterior").alias("_pc"))
    by_bytes = known.filter("unit = 'bytes'").select("_src", F.col("size").alias("bytes"), F.col("posterior").alias("_pb"))
    ends = ends.withColumn("_src", F.coalesce("_src", F.lit("")))
    placed = ends.join(by_chars, ["_src", "chars"], "left").join(by_bytes, ["_src", "bytes"], "left")
    placed = placed.withColumn("posterior", F.coalesce(F.greatest("_pc", "_pb"), F.lit(0.0)))
    # What the forms say, from each different text once.
    kinds = placed.groupBy("digest", "form").agg(F.max("posterior").alias("posterior")).groupBy("form", F.round("posterior", 2).alias("p")).agg(F.count("*").alias("n"))
    weights, base = form_weights([(r.form, r.p, r.n) for r in kinds.collect()])  # at most 101 rows per form
    form = F.coalesce(*[F.when(F.col("form") == k, F.lit(v)) for k, v in weights.items()])
    prior = F.greatest(F.lit(base), F.col("posterior"))
    placed = placed.withColumn("_odds", F.log(prior / (1 - prior)) + form)
    # Only ends that may be natural ask for their wording; all others are settled.
    open_, settled = placed.filter(F.col("form").isin("item", "dots")), placed.filter(~F.col("form").isin("item", "dots"))
    counts = docs.select("_text").mapInArrow(_word_counts, "word string, n double, stops double")
    counts = cut(counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("stops").alias("stops")))
    asked = cut(open_.filter("word <> ''").select("word").distinct())
    lengths = sorted(r.k for r in asked.select(F.length("word").alias("k")).distinct().collect())  # one row per length of a word
    spelt = counts.filter(~F.col("word").rlike(_CJK.pattern))
    over = F.filter(F.array(*[F.lit(k) for k in lengths]) if lengths else F.array().cast("array<int>"), lambda k: k < F.length("word"))
    left = spelt.select(F.explode(F.transform(over, lambda k: F.substring("word", F.lit(1), k))).alias("word"), "n").join(asked, "word", "left_semi")
    left = left.groupBy("word").agg(F.sum("n").alias("cuts"))
    totals = counts.agg(F.sum("n"), F.sum("stops"), F.sum(F.when(~F.col("word").rlike(_CJK.pattern), F.col("n") * (F.length("word") - 1)))).first()
    n_all, stops_all, cuts_all = (max(1.0, x or 0.0) for x in totals)
    wording = counts.join(asked, "word", "left_semi").join(left, "word", "left").select("word", "n", "stops", F.coalesce("cuts", F.lit(0.0)).alias("cuts"))
    ahead = open_.join(wording, "word", "left").na.fill(0.0, ["n", "stops", "cuts"])
    natural = (F.col("stops") + 0.05) / stops_all
    # A fifth of all cuts fall between words, the others inside one.
    severed = 0.2 * (F.col("n") + 0.05) / n_all + 0.8 * (F.col("cuts") + 0.5) / cuts_all
    said = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), F.log(severed / natural)))
    stock = cut(open_.filter("form = 'dots'").groupBy("tail").agg(F.countDistinct("digest").alias("_same")))
    trailing, phrases = stock.agg(F.sum("_same"), F.count("*")).first()
    ahead = ahead.join(stock, "tail", "left")
    repeated = F.coalesce(-F.log(F.col("_same") * F.lit(float(phrases) / max(1, trailing or 0))), F.lit(0.0))
    kept = ["_doc", "_src", "form", "word", "posterior", "digest", "_odds"]
    judged = cut(settled.select(*kept).unionByName(ahead.withColumn("_odds", F.col("_odds") + said + repeated).select(*kept)))
    # Copies that differ in their evidence, as only some of them lie at their source's limit.
    most = judged.groupBy("digest").agg(F.max("_odds").alias("_most"), F.min("_odds").alias("_least")).filter("_most > _least").select("digest", "_most")
    odds = F.coalesce("_most", "_odds")
    return judged.join(most, "digest", "left").select(
        F.col("_doc").alias(doc_id), F.col("_src").alias("source"), "form", F.col("posterior").alias("at_limit"), "word", F.round(odds, 6).alias("log_odds"), (odds > 0).alias("is_cut")
    )


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_texts(table(spark, sf_dir, "documents"), "doc_id", "text", "source")


def cut_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that stop before their end."""
    return _evidence(spark, sf_dir).filter("is_cut").select("doc_id")


def cut_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source the number of its documents, the cut ones among them and their share."""
    rows = _evidence(spark, sf_dir)
    return rows.groupBy("source").agg(F.count("*").alias("documents"), F.count_if("is_cut").alias("cut"), F.round(F.avg(F.col("is_cut").cast("double")), 6).alias("cut_rate"))
