"""Problem 3: template residue, filler and error pages instead of content.

Labelled exemplars (sentences that are residue, and sentences that only talk
about residue) are indexed by their words.  A first pass over all rows counts in
how many texts each indexed word occurs, which gives the TF-IDF weights.  The
second pass accumulates, through the inverted index, how much of each exemplar a
text holds at all, and only in texts that hold enough of one compares their
passage windows (sentences and lines) with the exemplars: a window is residue
when the share of its TF-IDF weight that a residue exemplar contains is high, and
higher than what any content exemplar contains.  Marks inside code are content;
marks in prose are a word of their own, and each is a short window with its
neighbours besides: it is residue in any sentence that does not explain it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import Words, table

MARK = "‹mark›"
#: A lead word that may be a plain word (Spanish "todo"): a mark for the exemplars, none by itself.
LEAD = "‹lead›"
CODE = "‹code›"
#: Share of an exemplar's weight that a window must hold.
CONTAINED = 0.6

#: Labelled exemplars of residue, one sentence each: error pages and blocked page loads.
PAGES = """
404 not found
page not found
the page you are looking for could not be found
the page you requested was not found
sorry we could not find that page
the requested path does not exist on this server
the requested url was not found on this server
it may have been removed renamed or made private
the page may have been moved or deleted
this repository or file is no longer available
error 502 gateway did not answer in time
504 gateway timeout
502 bad gateway
500 internal server error
503 service unavailable
error 500
service temporarily unavailable
the server is temporarily unable to service your request
the server handling is overloaded or down for maintenance
the site is down for maintenance
please try again later
try again later
access denied
403 forbidden
401 unauthorized
you do not have permission to view
you do not have permission to access this resource
you are not authorized to view this page
just a moment
one moment please
we are checking your browser before opening
checking your browser before accessing
checking if the site connection is secure
verify that you are human
verify you are human by completing the action below
please complete the captcha to continue
attention required
your request has been blocked
sorry you have been blocked
unusual traffic from your network
oops something went wrong while loading
something went wrong
an unexpected error occurred
please refresh the page or go back to the start
please refresh the page and try again
please log in to continue reading
please sign in to continue
sign in to view this page
you must be logged in to view this page
session has expired
your session has expired please sign in again
api rate limit exceeded for request
rate limit exceeded
too many requests please slow down
sign in to get a higher limit then fetch again
you need to enable javascript to run this app
please enable javascript to view this page
please enable javascript and cookies to continue
javascript is required
javascript is disabled in your browser
this site requires javascript
this page needs javascript
turn on javascript to continue
this browser is not supported
your browser is not supported please upgrade
turn on scripts and cookies then reload
if nothing happens turn on scripts in your browser
xml version error code nosuchkey key requestid
error code accessdenied message access denied requestid
error loading remote section upstream returned status 500
failed to load resource
upstream returned status
connection timed out
this content is not available in your region
dieser inhalt kann ohne aktiviertes skript nicht angezeigt werden
bitte browser einstellungen prüfen
bitte aktivieren sie javascript um diese seite anzuzeigen
javascript muss aktiviert sein
die seite wurde nicht gefunden
die angeforderte seite existiert nicht oder wurde verschoben
seite nicht gefunden
zugriff verweigert
sie haben keine berechtigung diese seite anzuzeigen
bitte melden sie sich an um weiterzulesen
ihre sitzung ist abgelaufen
der dienst ist vorübergehend nicht verfügbar
bitte versuchen sie es später erneut
zu viele anfragen
zurück zur startseite
ein fehler ist aufgetreten
la página no existe o fue movida
vuelve al inicio
página no encontrada
no se encontró la página solicitada
acceso denegado
no tienes permiso para ver esta página
activa javascript para ver esta página
es necesario habilitar javascript
inicia sesión para continuar leyendo
la sesión ha caducado
servicio no disponible temporalmente
inténtalo de nuevo más tarde
demasiadas solicitudes
ha ocurrido un error
page introuvable
la page demandée n existe pas ou a été déplacée
accès refusé
vous n avez pas l autorisation de consulter cette page
veuillez activer javascript pour afficher cette page
service temporairement indisponible
veuillez réessayer plus tard
votre session a expiré
404 file not found
410 gone
429 too many requests
400 bad request
this page does not exist
this page isn t available
this page is no longer available
the requested resource could not be found
the server encountered an internal error
the connection was reset
this site can t be reached
the connection has timed out
dns probe finished nxdomain
you have been rate limited
access to this resource is forbidden
access to this page has been denied
enable javascript and cookies to continue
press and hold to confirm you are a human
performing security verification
""".strip().split("\n")

#: Labelled exemplars of residue: template marks, instructions to the author, filler.
#: A star stands for the mark token.
TEMPLATES = """
*
* *
this section covers * for *
welcome to * the best way to your *
contact * if the fails
use when the user asks to *
a skill that * for *
a skill that does *
undefined *
undefined
todo
tbd
todo describe the and the before release
todo add a description for
* describe the and the before release
* add a description for
* add a description
* write this section
description goes here
your text goes here
your description here
text goes here
content goes here
add your content here
insert text here
replace this text
replace this text with your own
replace this text with your own instructions
replace this section with your own
replace me
short summary of the skill replace me
short description of the skill replace me
change me
write something about your
tell the reader about
your own text here
replace this with a short description
write a short description here
enter a description
enter your description in this field
enter your text here
fill in this field
fill in this section
fill out this section
describe your skill here
describe what this skill does
explain what this skill does here
provide a description
provide a short summary here
add details here
add examples here
list the steps here
more information to follow
details to follow
lorem ipsum
add two or three sentences about here
one sentence on what this skill does
content for the coming soon
coming soon
this section is under construction
to be written
to be determined
to be completed
fill in later
xxxx xxxx xxxx fill in later
xxxx
click here to edit this block
click to add text
double click to edit
edit this text
sample text
placeholder text
placeholder
no description provided
new skill
untitled
hier den text zu einfügen
hier text einfügen
hier beschreibung einfügen
beschreibung folgt
text folgt
inhalt folgt
wird noch ergänzt
platzhalter
inserte aquí el texto
insertar texto aquí
escriba aquí la descripción
descripción pendiente
la descripción va aquí
texto de ejemplo
próximamente
insérer le texte ici
description à venir
à compléter
texte à venir
""".strip().split("\n")

#: Labelled exemplar of filler: the words of the usual pseudo-Latin text.
FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in
reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa
qui officia deserunt mollit anim id est laborum vivamus vestibulum mauris massa risus ligula lacus urna orci odio erat porta
augue felis diam sapien neque nunc nibh vero quam purus justo turpis ante tellus curabitur pellentesque habitant morbi
tristique senectus netus malesuada fames ac egestas donec pretium vulputate maecenas faucibus fusce integer nec praesent
""".split()

#: Labelled exemplars of content: sentences about such marks and pages.
CONTENT = """
renders pages that need javascript and saves the resulting
generates lorem ipsum filler of a chosen length for mock ups
finds todo marks in a and opens a ticket for each
fills * style templates for a from tabular data with
explains 404 and 503 responses seen by and how to retry them
detects access denied pages in crawled dumps with
when a request returns 404 not found waits and tries the again
search the for leftover todo comments and turn each into a ticket
use lorem ipsum only in mock ups and swap in the real copy before launch
access denied errors usually mean the role is missing in
a service temporarily unavailable reply should trigger the fallback
the check fails if any text is still in the
every mark in the template is filled by from the matching column
replace * with the value
the placeholder * is filled in by
templates use * marks for values
this skill checks pages for error messages
retry when the server answers 500 internal server error
a page not found message means that
if you see access denied ask for the role
handles rate limit exceeded errors by waiting
detects pages that require javascript
warns about placeholder text left in a document
""".strip().split("\n")

#: Words that explain a mark where all of them stand close to it.
EXPLAINED = [
    frozenset(t.split())
    for t in """
replace with
replaces with
replaced with
replaced by
substitute with
substituted by
substituted with
filled by
filled from
filled with
expands to
resolves to
stands for
refers to the value
rendered as
escape as
the placeholder
the placeholders
a placeholder
placeholders like
placeholders such as
the variable
variables like
variables such as
the mark
marks like
marks such as
tokens like
tags like
style template
style templates
style placeholders
syntax
template syntax
leftover
unfilled
unresolved
platzhalter
ersetze durch
ersetzt durch
marcador
reemplaza por
reemplaza con
remplacez par
remplacer par
""".strip().split("\n")
]
CLOSE = 4

_NAME = r"[^\W\d_][\w .'’/-]{0,60}"
#: Forms of a mark that was to be filled in.
MARKS = re.compile(
    r"\{\{\{?[^{}\n]{1,80}\}?\}\}|\{%[^%\n]{1,80}%\}|\$\{[^{}\n]{1,80}\}|#\{[^{}\n]{1,80}\}|<%[^%\n]{1,80}%>|<<[^<>\n]{1,80}>>|@@[^@\n]{1,60}@@"
    r"|%\([A-Za-z_][\w ]{0,60}\)[sd]|(?<![\w%])%[A-Z][A-Z0-9_]{2,60}%(?!\w)|(?<![\w_])__[A-Z][A-Z0-9_]{1,60}__(?!\w)"
    r"|<(?!/)(?:[^\W\d_][\w'’-]*[ _]){1,8}[\w'’-]+>|<(?:your|insert|enter|add)[\w '’-]{0,60}>"
    r"|\[(?:insert|your|add|enter|describe|replace|write|fill|one sentence|name of|todo|tbd|placeholder|hier|inserte|insertar|tu|su|insérer|votre)\b[^\]\n]{0,120}\](?![(:])"
    r"|\[[^\]\[\n]{1,80}\b(?:tbd|todo|here|goes here|placeholder|einfügen|aquí|ici)\](?![(:])",
    re.I,
)
#: Syntax that only looks like a mark: emphasis and names of Python, variables of the environment, elements of HTML.
_SYNTAX = re.compile(
    r"(?<![\w_])__(?:[a-z]+|[A-Z][a-z]+)__(?!\w)|\$\{(?:HOME|PATH|USER|PWD|SHELL|TMPDIR|LANG)\}"
    r"|%(?:PATH|APPDATA|LOCALAPPDATA|USERPROFILE|TEMP|TMP|PROGRAMFILES|SYSTEMROOT|WINDIR|USERNAME|HOMEPATH)%"
    r"|<(?:details|input|option|button|video|audio|script|select|textarea|ol|iframe|form)(?: (?:open|disabled|checked|selected|required|multiple|readonly|hidden|autofocus|async|defer|reversed|controls|muted|loop))+>"
)
#: A cheap search in whole texts that finds every text with such a mark or a lead word, and more.
MARKS_RE2 = (
    r"(?is)\{\{|\{%|\$\{|#\{|<%|<<|@@|%\(|%\pL|__\pL|<[\pL\p{Nl}\p{No}]|\[.*\](?:[^(:]|$)"
    r"|todo|tbd|f[iİı]xme"
)
_FENCE = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
_INLINE = re.compile(r"(`+)(?!`).+?\1", re.S)
_LEAD = re.compile(r"^[\s#>*+-]*(?:\d+[.)]\s+)?(?:todo|tbd|fixme)\b\s*[:\-–]?\s*", re.I)
_FIRM = re.compile(r"TODO|TBD|FIXME|[:–-]\s*$")
#: Paths, links, host names, slugs and long codes carry no weight.
_IDS = re.compile(r"https?://\S+|(?<!\w)/?(?:[\w.-]+/)+[\w.-]*|\b(?=\w*\d)[0-9a-f]{7,}\b|\b[\w-]+(?:\.[\w-]+){2,}\b|\b\w+(?:-\w+){2,}\b", re.I)
_TOKEN = re.compile(rf"{MARK}|{LEAD}|{CODE}|[^\W_]+")
_BREAK = re.compile(r"(?<=[.!?。！？])\s+|\n+|(?<=[。！？])")


def tokens_of(window: str) -> list[str]:
    """Words of a window; status codes are kept, other numbers and identifiers dropped."""
    found = _TOKEN.findall(_IDS.sub(" ", window).lower())
    return [t for t in found if not t.isdigit() or re.fullmatch(r"[45]\d\d", t)]


def windows(text: str) -> Iterator[str]:
    """Sentences and lines, with code and marks replaced by their tokens."""
    text = _INLINE.sub(f" {CODE} ", _FENCE.sub(f"\n{CODE}\n", text))
    text = MARKS.sub(f" {MARK} ", _SYNTAX.sub(f" {CODE} ", text))
    for window in _BREAK.split(text):
        window = _LEAD.sub(lambda m: f"{MARK if _FIRM.search(m[0]) else LEAD} ", window, count=1).strip()
        if window:
            yield window


class Exemplars:
    """The labelled exemplars, their inverted index and TF-IDF weights."""

    def __init__(self) -> None:
        spoken = [(t, "residue", 0.62) for t in PAGES] + [(t, "residue", 0.45 if "*" in t else 0.62) for t in TEMPLATES] + [(t, "content", 0.3) for t in CONTENT]
        self.sets = [frozenset(tokens_of(t.replace("*", MARK))) for t, _, _ in spoken] + [frozenset(FILLER)]
        self.label = [k for _, k, _ in spoken] + ["residue"]
        self.least = [c for _, _, c in spoken] + [0.6]
        self.bag = [False] * len(spoken) + [True]
        self.vocabulary = sorted(set().union(*self.sets) - {MARK, CODE})
        self.weight: dict[str, float] = {}
        self.index: dict[str, list[int]] = {}

    def weigh(self, texts: int, frequency: dict[str, int]) -> None:
        self.weight = {t: float(np.log((texts + 1) / (frequency.get(t, 0) + 1)) + 1) for t in self.vocabulary}
        # A mark weighs as a rare word, however many rows are spoilt.
        self.weight[MARK] = max(8.0, max(self.weight.values(), default=8.0))
        self.weight[CODE] = 3.0
        self.other = float(np.mean([self.weight[t] for t in self.vocabulary])) * 0.6
        index: dict[str, list[int]] = defaultdict(list)
        for e, words in enumerate(self.sets):
            for t in words:
                index[t].append(e)
        self.index = dict(index)

    def posting_lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The residue exemplars' inverted index in flat form: offset of each
        vocabulary word, exemplar and share of the exemplar's weight of each entry."""
        lists = [[e for e in self.index.get(t, ()) if self.label[e] == "residue" and MARK not in self.sets[e]] for t in self.vocabulary]
        full = [sum(self.weight[t] for t in s) for s in self.sets]
        offset = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        share = [(0.2 if self.bag[e] else self.weight[t] / full[e]) for t, x in zip(self.vocabulary, lists) for e in x]
        return offset, np.array([e for x in lists for e in x], np.int64), np.array(share), np.array(full)

    def judge(self, window: str) -> tuple[str, float]:
        """Label of the exemplar that contains most of the window, and how much."""
        spoken = tokens_of(window)
        words = [MARK if t == LEAD else t for t in spoken]
        kinds = set(words)
        near = {e for t in kinds for e in self.index.get(t, ())}
        if not near:
            return "", 0.0
        marks = min(3, words.count(MARK))
        worth = {t: self.weight.get(t, self.other) * (marks if t == MARK else 1) for t in kinds}
        total = sum(worth.values())
        best = {"residue": 0.0, "content": 0.0}
        for e in near:
            own = self.sets[e]
            shared = kinds & own
            covered = sum(worth[t] for t in shared) / total
            contained = len(shared) >= 5 or len(shared) == len(kinds) > 2 if self.bag[e] else sum(self.weight[t] for t in shared) >= CONTAINED * sum(self.weight[t] for t in own)
            if contained and covered >= self.least[e]:
                best[self.label[e]] = max(best[self.label[e]], covered)
        label = "residue" if best["residue"] > best["content"] else "content"
        if marks and label == "content":
            covered = self.bare_mark(spoken)
            if covered:
                return "residue", covered
        return (label, best[label]) if best[label] else ("", 0.0)

    def bare_mark(self, words: list[str]) -> float:
        """The share that a mark has of the short window around it, at the mark
        where it is highest among those the sentence does not explain; 0 if none."""
        spoken = set(words) - {MARK, LEAD}
        for e, own in enumerate(self.sets):
            # The mark itself is no sign that a sentence explains it.
            own = own - {MARK}
            if self.label[e] == "content" and sum(self.weight[t] for t in spoken & own) >= CONTAINED * sum(self.weight[t] for t in own):
                return 0.0
        best = 0.0
        for at in (k for k, t in enumerate(words) if t == MARK):
            close = set(words[max(0, at - CLOSE) : at + CLOSE + 1])
            if not any(own <= close for own in EXPLAINED):
                beside = words[max(0, at - 1) : at] + words[at + 1 : at + 2]
                best = max(best, self.weight[MARK] / (self.weight[MARK] + sum(self.weight.get(t, self.other) for t in beside)))
        return best


def _vocabulary_hashes(vocabulary: list[str]) -> np.ndarray:
    words = Words(pa.array(vocabulary))
    return words.hash[words.offset[:-1]]


def _frequencies(vocabulary: list[str]):
    """Texts of a partition to the number of them that hold each indexed word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _vocabulary_hashes(vocabulary)
        order = np.argsort(code)
        sorted_code = code[order]
        count, texts = np.zeros(len(code), np.int64), 0
        for batch in batches:
            for column in batch.columns:
                words = Words(column)
                texts += int((words.count > 0).sum())
                at = np.minimum(np.searchsorted(sorted_code, words.hash), len(code) - 1)
                hit = np.flatnonzero(sorted_code[at] == words.hash)
                pair = np.unique(words.owner[hit] * len(code) + at[hit])
                count += np.bincount(order[pair % len(code)], minlength=len(code))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array([*some, -1], pa.int32()), pa.array([*count[some], texts], pa.int64())], ["word", "n"])

    return run


def _residue(shared, fields: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Exemplars = shared.value
        code = _vocabulary_hashes(known.vocabulary)
        order = np.argsort(code)
        code = code[order]
        offset, entry, share, full = known.posting_lists()
        for batch in batches:
            reasons: dict[int, tuple[float, str]] = {}
            for f in range(1, fields + 1):
                texts = batch.column(f)
                words = Words(texts)
                at = np.minimum(np.searchsorted(code, words.hash), len(code) - 1)
                hit = np.flatnonzero(code[at] == words.hash)
                pair = np.unique(words.owner[hit] * len(code) + at[hit])
                owner, word = pair // len(code), order[pair % len(code)]
                times = offset[word + 1] - offset[word]
                place = np.repeat(offset[word], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                held = np.bincount(np.repeat(owner, times) * len(full) + entry[place], weights=share[place], minlength=batch.num_rows * len(full))
                # A window cannot hold more of an exemplar than its text does.
                maybe = held.reshape(batch.num_rows, len(full)).max(axis=1, initial=0.0) >= CONTAINED - 1e-9
                maybe |= pc.fill_null(pc.match_substring_regex(texts, MARKS_RE2), False).to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(maybe).tolist():
                    for window in windows(texts[i].as_py() or ""):
                        label, covered = known.judge(window)
                        if label == "residue" and covered > reasons.get(i, (0.0, ""))[0]:
                            reasons[i] = (covered, window)
            rows = sorted(reasons)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([reasons[i][0] for i in rows], pa.float64()), pa.array([reasons[i][1] for i in rows], pa.string())],
                ["_key", "coverage", "passage"],
            )

    return run


def residue(records: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Records with residue in any of ``fields``: ``(key, coverage, passage)``.

    One row per key, with the passage that an exemplar covers most.  Null and
    empty texts hold no residue; rows without a key are dropped; repeated rows
    come out once; texts are read whole.
    """
    spark = records.sparkSession
    texts = records.select(F.col(key).cast("string").alias("_key"), *[F.col(f) for f in fields]).filter("_key IS NOT NULL")
    known = Exemplars()
    counted = texts.select(*fields).mapInArrow(_frequencies(known.vocabulary), "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r.word: r.n for r in counted.collect()}  # at most one row per indexed word
    known.weigh(counts.pop(-1, 0), {known.vocabulary[k]: n for k, n in counts.items()})
    shared = spark.sparkContext.broadcast(known)
    found = texts.mapInArrow(_residue(shared, len(fields)), "_key string, coverage double, passage string")
    return found.groupBy(F.col("_key").alias(key)).agg(F.max("coverage").alias("coverage"), F.max_by("passage", F.struct("coverage", "passage")).alias("passage"))


def spoilt_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills whose body or description holds residue instead of content."""
    return residue(table(spark, sf_dir, "skills"), "skill_id", ["body", "description"]).select("skill_id")
