"""Exact BM25 rankings by blocks of documents, without a row for every pair that meets.

Documents are reduced to the terms that some request asks for and written once, in the
order of their keys, to the shared folder.  A task holds a group of requests and reads
all documents in blocks; a term's weights in a block are one vector, and the sum of a
request's vectors tells its scores, of which only the best ``k`` are kept.  The sums are
made of weights rounded up to 16-bit steps, so they are bounds; only documents whose bound
reaches the ``k``-th best score so far are scored in full.  Requests are
sorted by their terms, the most asked first, so those with the same first terms share
the sum over them.  Nothing is left out: every document is bounded for every request.
"""

from __future__ import annotations

import random
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

K1, B = 1.5, 0.75
#: Documents and postings of a block, requests of a task, rows read and handed to Spark at once.
BLOCK, POSTINGS, REQUESTS, READ, ROWS = 32768, 1 << 21, 16384, 16384, 20_000
#: Requests whose lists are joined at once.
TOGETHER = 1024
#: A term is a vector of its block if one of so many documents holds it.
DENSE = 32


@dataclass
class Channel:
    """One ranking: the terms of requests and documents, and how many documents stay.

    Terms of a request count as often as they occur if ``repeated``, else once.  With
    ``stop_share``, terms in more than this share of at least ``stop_from`` documents
    are ignored.  ``pad`` fills up with the first keys at score 0."""

    terms: Column
    tokens: Column
    k: int
    repeated: bool = False
    stop_share: float | None = None
    stop_from: int = 10
    pad: bool = False
    digits: int = 6


@dataclass
class Fuse:
    """Joins the lists of a request: ``value(score, rank, mean, deviation)`` of each
    channel (arrays), times its weight, summed; what a list lacks adds nothing.  Of
    equal sums the one listed earlier wins, the first channel before the second."""

    value: Callable
    weights: list[float]
    k: int
    digits: int


def _shared(spark) -> str:
    """A new folder below the one that all machines share; it goes when the session ends."""
    context = spark.sparkContext
    set_ = context._jsc.sc().getCheckpointDir()
    root = set_.get() if set_.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if root is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    path = f"{root or tempfile.mkdtemp(prefix='corpusloom-')}/bm25-{uuid.uuid4().hex}"
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(context._jsc.hadoopConfiguration())
    files.deleteOnExit(hadoop)
    return files.makeQualified(hadoop).toString()


def _keep(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def kept(rows: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder, for plans that read them several times."""
    return _keep(rows, f"{_shared(rows.sparkSession)}/rows")


def _files(path: str):
    """The Parquet files of a folder in the order of their partitions."""
    from pyarrow import fs

    files, at = fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/+", "file:///", path))
    names = sorted(x.path for x in files.get_file_info(fs.FileSelector(at)) if x.path.endswith(".parquet"))
    return files, names


def _batches(path: str, columns: list[str], least: int = 1):
    """``(number of the first row, batch)`` over all rows in order; batches are joined until they hold ``least`` rows."""
    import pyarrow.parquet as pq

    files, names = _files(path)
    base, held, count = 0, [], 0
    for name in names:
        with files.open_input_file(name) as source:
            for batch in pq.ParquetFile(source).iter_batches(READ, columns=columns):
                held.append(batch)
                count += len(batch)
                if count >= least:
                    yield base, pa.concat_batches(held)
                    base, held, count = base + count, [], 0
    if count:
        yield base, pa.concat_batches(held)


def _codes(lists: pa.ListArray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every known term of a batch."""
    code = pc.index_in(lists.flatten(), value_set=vocabulary)
    known = pc.is_valid(code).to_numpy(zero_copy_only=False)
    return pc.list_parent_indices(lists).to_numpy()[known].astype(np.int64), pc.fill_null(code, 0).to_numpy()[known].astype(np.int64)


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), pa.array(values, pa.int32()))


def _weights(batch: pa.RecordBatch, base: int, c: int, known: np.ndarray, idf: np.ndarray, mean: float):
    """Per block: number of its first row, its size, terms -> places and weights, and by document where it begins, terms and weights.

    The first blocks are small: they give the bounds that leave few documents of the next ones to be scored."""
    ids, tfs = batch.column(f"_ids{c}"), batch.column(f"_tfs{c}")
    ends = np.r_[0, np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))].astype(np.int64)
    ids, tfs, length = ids.flatten().to_numpy(), tfs.flatten().to_numpy(), batch.column(f"_dl{c}").to_numpy().astype(float)
    start = 0
    while start < len(batch):
        stop = max(start + 1, min(start + max(BLOCK // 16, 3 * (base + start)), int(np.searchsorted(ends, ends[start] + POSTINGS, side="right")) - 1))
        n, part = stop - start, slice(ends[start], ends[stop])
        term, tf, doc = ids[part], tfs[part].astype(float), np.repeat(np.arange(n), np.diff(ends[start : stop + 1]))
        asked = known[term]
        term, tf, doc = term[asked], tf[asked], doc[asked]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[start:stop][doc] / mean))
        order = np.argsort(term.astype(np.uint16) if len(idf) <= 1 << 16 else term, kind="stable")  # of 16 bits in one pass
        ranked, places, weights = term[order], doc[order], weight[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(term) else np.zeros(0, np.int64)
        rows = {int(ranked[a]): (places[a:b], weights[a:b]) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(term)])}
        yield start, n, rows, (np.searchsorted(doc, np.arange(n + 1)), term, weight)
        start = stop


def _steps(rows: dict, n: int, unit: float) -> dict:
    """Weights in steps, rounded up: terms -> places and steps, or None and a vector."""
    out = {}
    for t, (at, w) in rows.items():
        steps = (np.floor(w * unit) + 1).astype(np.uint16)
        if len(at) * DENSE >= n:
            row = np.zeros(n, np.uint16)
            row[at] = steps
            out[t] = (None, row)
        else:
            out[t] = (at, steps)
    return out


def _exact(times: np.ndarray, held: tuple, found: np.ndarray) -> np.ndarray:
    """Scores of a few documents of a block; ``times`` tells how often each term is asked."""
    begin, term, weight = held
    low = begin[found]
    count = begin[found + 1] - low
    row = np.repeat(np.arange(len(found)), count)
    at = np.arange(len(row)) + np.repeat(low - (np.cumsum(count) - count), count)
    often = times[term[at]]
    asked = np.flatnonzero(often)
    return np.bincount(row[asked], weight[at[asked]] * often[asked], len(found))


def _best(queries: list[list[int]], path: str, c: int, k: int, idf: np.ndarray, mean: float, digits: int) -> list:
    """``(numbers, scores)`` of the best ``k`` documents of every request, best first."""
    order = sorted(range(len(queries)), key=queries.__getitem__)
    terms = [queries[i] for i in order]
    common = [0] * (len(terms) + 1)  # terms that a request shares with the one before
    for i in range(1, len(terms)):
        x, y = terms[i - 1], terms[i]
        common[i] = next((d for d, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    known = np.zeros(len(idf), bool)
    known[np.array([t for q in terms for t in q], np.int64)] = True
    depth = max(common) + 2
    none = (np.zeros(0, np.int64), np.zeros(0))
    kept, least = [none] * len(terms), [0.0] * len(terms)
    flat, ends, long = np.array([t for q in terms for t in q], np.int64), np.cumsum([len(q) for q in terms]), max(map(len, terms), default=0)
    scale, times, distinct = 10.0**digits, np.zeros(len(idf)), []
    for q in terms:
        own, often = np.array(q, np.int64), 1.0
        if len(set(q)) < len(q):
            own, often = np.unique(own, return_counts=True)
        distinct.append((own, often))
    for base, batch in _batches(path, [f"_ids{c}", f"_tfs{c}", f"_dl{c}"], BLOCK):
        for start, n, rows, held in _weights(batch, base, c, known, idf, mean):
            # The largest sum of any request, its roundings included, fits into 16 bits.
            tops = np.zeros(len(idf))
            tops[list(rows)] = [w.max() for _, w in rows.values()]
            total = np.r_[0.0, np.cumsum(tops[flat])]
            most = float((total[ends] - total[np.r_[0, ends[:-1]]]).max()) if len(terms) else 0.0
            if most <= 0:
                continue
            if long >= 1 << 15:
                raise ValueError("a request of 32,768 terms or more")
            unit = (65535 - long - 1) / (most * (1 + 1e-9))
            steps = _steps(rows, n, unit)
            sums, over = np.zeros((depth, n), np.uint16), np.empty(n, bool)  # sums[d]: of the first d terms; the last: of all
            full = sums[depth - 1]
            for i, q in enumerate(terms):
                same, ahead = common[i], common[i + 1]
                if same == len(q) == (len(terms[i - 1]) if i else -1):
                    pass  # the very terms of the request before: its sums stand
                else:
                    now = sums[same]
                    for d in range(same, len(q)):
                        to = sums[d + 1] if d < ahead else full
                        at, w = steps.get(q[d], (None, None))
                        if w is None:
                            if now is not to:
                                np.copyto(to, now)
                        elif at is None:
                            np.add(now, w, out=to)
                        else:
                            if now is not to:
                                np.copyto(to, now)
                            to[at] += w
                        now = to
                # One step less for what the sums of full weights lose by rounding.
                bound = max(0, int(least[i] * unit) - 1)
                if bound >= 65535:
                    continue
                np.greater(now, np.uint16(bound), out=over)
                found = np.flatnonzero(over)
                if not len(found):
                    continue
                if len(found) > 2 * k:
                    # Sums are too large by less than a step a term; a score in last place is left to the full sums.
                    reach = now[found]
                    edge = int(np.partition(reach, len(reach) - k)[len(reach) - k]) - len(q) - int(unit / scale) - 3
                    found = found[reach >= edge] if edge > 0 else found
                own, often = distinct[i]
                times[own] = often
                score = np.floor(_exact(times, held, found) * scale + 0.5) / scale
                times[own] = 0.0
                better = score > least[i]  # of equal scores the smaller key stays, which came before
                found, score = found[better], score[better]
                if not len(found):
                    continue
                if len(found) > 2 * k:
                    edge = score >= np.partition(score, len(score) - k)[len(score) - k]
                    found, score = found[edge], score[edge]
                nos, scores = np.concatenate([kept[i][0], found + (base + start)]), np.concatenate([kept[i][1], score])
                top = np.argsort(-scores, kind="stable")[:k]
                kept[i] = (nos[top], scores[top])
                if len(top) == k:
                    least[i] = float(scores[top[-1]])
    out = [none] * len(queries)
    for i, x in zip(order, kept):
        out[i] = x
    return out


def _padded(hits: tuple[np.ndarray, np.ndarray], k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    nos, scores = hits
    if len(nos) >= min(k, n):
        return hits
    spare = np.setdiff1d(np.arange(min(k, n)), nos)[: k - len(nos)]
    return np.r_[nos, spare], np.r_[scores, np.zeros(len(spare))]


def _others(best: list[list], ids: list, count: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, request and place of ``count`` documents a request that none of its lists holds, or all of these if there are fewer."""
    found = []
    for q, own in enumerate(ids):
        taken, draw = {x for lists in best for x in lists[q][0].tolist()}, random.Random(str(own))
        for place in range(1, min(count, n - len(taken)) + 1):
            no = draw.randrange(n)
            while no in taken:
                no = draw.randrange(n)
            taken.add(no)
            found.append((no, q, place))
    return tuple(np.array(found, np.int64).reshape(-1, 3).T)


def _beside(best: list[list]) -> tuple[np.ndarray, np.ndarray, list, list]:
    """Documents and requests, by document, that any channel lists; per channel where it lists them, the scores and the ranks; per channel the places of its list."""
    many, lists = len(best[0]), []
    for found in best:
        size = np.array([len(x[0]) for x in found], np.int64)
        q, first = np.repeat(np.arange(many), size), np.repeat(np.cumsum(size) - size, size)
        lists.append((np.concatenate([x[0] for x in found]).astype(np.int64) * many + q, np.concatenate([x[1] for x in found]), np.arange(1, len(q) + 1) - first))
    every, out, places = np.unique(np.concatenate([x[0] for x in lists])), [], []
    for code, score, rank in lists:
        at = np.searchsorted(every, code)
        held, scores, ranks = np.zeros(len(every), bool), np.zeros(len(every)), np.zeros(len(every), np.int32)
        held[at], scores[at], ranks[at] = True, score, rank
        out.append((held, scores, ranks))
        places.append(at)
    return every // many, every % many, out, places


def _fused(best: list[list], offset: int, fuse: Fuse) -> tuple[np.ndarray, ...]:
    """Document, request, fused score and rank of the best ``fuse.k`` of every request."""
    many = len(best[0])
    no, q, lists, places = _beside(best)
    total = np.zeros(len(no))
    for (held, score, rank), weight in zip(lists, fuse.weights):
        times = np.maximum(np.bincount(q[held], minlength=many), 1)
        mean = np.bincount(q[held], score[held], many) / times
        deviation = np.sqrt(np.bincount(q[held], (score[held] - mean[q[held]]) ** 2, many) / times)
        total[held] += weight * fuse.value(score[held], rank[held], mean[q[held]], deviation[q[held]])
    total = np.sign(total) * np.floor(np.abs(total) * 10.0**fuse.digits + 0.5) / 10.0**fuse.digits  # halves away from zero, as the engine does
    # In the order that settles equal sums; the sort keeps it.
    seen, order = np.zeros(len(no), bool), []
    for at in places:
        order.append(at[~seen[at]])
        seen[at] = True
    order = np.concatenate(order)
    order = order[np.lexsort((-total[order], q[order]))]
    place = np.arange(len(order)) - np.searchsorted(q[order], q[order]) + 1
    top = place <= fuse.k
    order = order[top]
    return no[order], q[order] + offset, total[order], place[top]


def search(requests: DataFrame, request: str, docs: DataFrame, key: str, channels: list[Channel], carry: list[str] = (), bring: list[str] = (), fuse: Fuse | None = None, others: int = 0) -> DataFrame:
    """Rows ``(request, *carry, key, *bring, score0, rank0, score1, ...)``: every document
    that is among the best of a channel, with null where a channel does not list it.
    ``carry`` are further columns of requests, ``bring`` of documents.

    With ``fuse`` the columns of channels give way to ``fused`` and ``rank``, and only
    the best of a request stay.

    With ``others`` there are rows of so many further documents a request, drawn
    among all that no channel lists, by the request's id; ``other`` numbers them, and
    is null for what is listed.

    Requests with a null id and documents with a null key are dropped; both ids must
    be distinct."""
    spark, many = requests.sparkSession, range(len(channels))
    folder = _shared(spark)
    asked = requests.filter(F.col(request).isNotNull()).select(request, *carry, *[(c.terms if c.repeated else F.array_distinct(c.terms)).alias(f"_t{i}") for i, c in enumerate(channels)])
    asked = _keep(asked, f"{folder}/requests")
    number = asked.count()

    # Numbers of terms: the most asked first.
    words = reduce(DataFrame.unionByName, [asked.select(F.lit(i).alias("c"), F.explode(f"_t{i}").alias("term")) for i in many])
    listed = [[] for _ in many]
    for c, term, _ in sorted(words.groupBy("c", "term").count().collect(), key=lambda r: (-r[2], r[1])):
        listed[c].append(term)
    vocabulary = [pa.array(x, pa.string()) for x in listed]

    def count(batches):
        for batch in batches:
            table = {x: batch.column(x) for x in (key, *bring)}
            for i in many:
                tokens = batch.column(f"_t{i}")
                row, code = _codes(tokens, vocabulary[i])
                size = max(1, len(vocabulary[i]))
                pair, tf = np.unique(row * size + code, return_counts=True)
                table[f"_dl{i}"] = pc.fill_null(pc.list_value_length(tokens), 0)
                table[f"_ids{i}"], table[f"_tfs{i}"] = _lists(pair % size, pair // size, len(batch)), _lists(tf, pair // size, len(batch))
            yield pa.RecordBatch.from_arrays(list(table.values()), names=list(table))

    numbers = lambda names: [T.StructField(f"{x}{i}", T.IntegerType() if x == "_dl" else T.ArrayType(T.IntegerType())) for i in many for x in names]
    rows = docs.filter(F.col(key).isNotNull()).select(key, *bring, *[c.tokens.alias(f"_t{i}") for i, c in enumerate(channels)])
    reduced = T.StructType([docs.schema[x] for x in (key, *bring)] + numbers(["_dl", "_ids", "_tfs"]))
    counted = _keep(rows.mapInArrow(count, reduced), f"{folder}/counted")
    totals = counted.agg(F.count("*"), *[F.avg(f"_dl{i}") for i in many]).first()
    n, means = totals[0], [x or 1.0 for x in totals[1:]]
    held = reduce(DataFrame.unionByName, [counted.select(F.lit(i).alias("c"), F.explode(f"_ids{i}").alias("term")) for i in many])
    df = [np.zeros(len(x)) for x in listed]
    for c, term, times in held.groupBy("c", "term").count().collect():
        df[c][term] = times
    idf = [np.log(1 + (n - x + 0.5) / (x + 0.5)) for x in df]
    ignored = [(x == 0) | ((x / max(n, 1) > c.stop_share) if c.stop_share is not None and n >= c.stop_from else False) for x, c in zip(df, channels)]
    path = f"{folder}/sorted"
    _keep(counted.sort(key), path)

    plan = [(c.k, c.pad, c.digits) for c in channels]

    def numbered(batches):
        for batch in batches:
            table = {x: batch.column(x) for x in (request, *carry)}
            for i in many:
                row, code = _codes(batch.column(f"_t{i}"), vocabulary[i])
                used = ~ignored[i][code]
                row, code = row[used], code[used]
                order = np.lexsort((code, row))
                table[f"_ids{i}"] = _lists(code[order], row[order], len(batch))
            yield pa.RecordBatch.from_arrays(list(table.values()), names=list(table))

    groups = max(spark.sparkContext.defaultParallelism, -(-number // REQUESTS))
    grouped = asked.mapInArrow(numbered, T.StructType([asked.schema[x] for x in (request, *carry)] + numbers(["_ids"]))).repartitionByRange(max(1, groups), *[f"_ids{i}" for i in reversed(many)], request)
    if fuse:
        fields = [T.StructField("fused", T.DoubleType()), T.StructField("rank", T.IntegerType())]
    else:
        fields = [T.StructField(f"{x}{i}", T.IntegerType() if x == "rank" else T.DoubleType()) for i in many for x in ("score", "rank")]
        fields += [T.StructField("other", T.IntegerType())] if others else []
    result = T.StructType([asked.schema[x] for x in (request, *carry)] + [docs.schema[x] for x in (key, *bring)] + fields)

    def score(batches):
        batches = list(batches)
        if not batches or n == 0:
            return
        group = pa.Table.from_batches(batches).combine_chunks()
        best = []
        for i, (k, pad, digits) in enumerate(plan):
            found = _best(group.column(f"_ids{i}").to_pylist(), path, i, k, idf[i], means[i], digits)
            best.append([_padded(x, k, n) for x in found] if pad else found)
        if fuse:
            parts = [_fused([x[a : a + TOGETHER] for x in best], a, fuse) for a in range(0, len(group), TOGETHER)]
            no, q, fused, rank = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(no, kind="stable")
            no, q, values = no[order], q[order], [pa.array(fused[order]), pa.array(rank[order], pa.int32())]
        else:
            no, q, lists, _ = _beside(best)
            values = [pa.array(x, mask=~held) for held, *columns in lists for x in columns]
            if others:
                more, theirs, place = _others(best, group.column(request).to_pylist(), others, n)
                values = [pa.concat_arrays([x, pa.nulls(len(more), x.type)]) for x in values] + [pa.concat_arrays([pa.nulls(len(no), pa.int32()), pa.array(place, pa.int32())])]
                no, q = np.r_[no, more], np.r_[q, theirs]
                order = np.argsort(no, kind="stable")
                no, q, values = no[order], q[order], [x.take(pa.array(order)) for x in values]
        # Rows are in the order of documents, so the files are read once more, front to back.
        for base, batch in _batches(path, [key, *bring]):
            low, high = np.searchsorted(no, [base, base + len(batch)])
            for a in range(low, high, ROWS):
                b = min(high, a + ROWS)
                mine, theirs = group.select([request, *carry]).take(pa.array(q[a:b])), batch.take(pa.array(no[a:b] - base))
                columns = [*[x.combine_chunks() for x in mine.columns], *theirs.columns, *[v.slice(a, b - a) for v in values]]
                yield pa.RecordBatch.from_arrays([x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in columns], names=result.names)

    return grouped.mapInArrow(score, result)
