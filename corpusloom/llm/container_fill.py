"""Problem 6: filling fixed-capacity containers with texts.

Texts are measured once, in tokens of a public tokenizer.  The sizes, a few
bytes each, are dealt into portions of bounded size; every portion is packed by
itself, first by best fit in decreasing order, then by swap-based local search:
the emptiest container gives items to the others by moves, one-for-one and
two-for-one exchanges that raise the sum of squared fills, until it is empty;
the search ends where the number of containers reaches its lower bound or no
exchange helps.  Against one global packing this costs at most one underfull
container per portion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, table

#: Where the public tokenizers' vocabulary files lie; a parameter of the operator.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PORTION = 5_000


def _encoder(ranks: bytes, loaded: dict = {}):  # noqa: B006
    if loaded.get("ranks") is not ranks:
        import base64

        import tiktoken

        table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        loaded.update(ranks=ranks, made=tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table_, special_tokens={}))
    return loaded["made"]


def _measured(shared, capacity: int):
    """Texts to rows (document, piece, tokens); a longer text gives full pieces and a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            size = np.array([len(encoder.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()], np.int64)
            pieces = np.maximum(1, -(-size // capacity))
            owner = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            tokens = np.minimum(capacity, size[owner] - piece * capacity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(tokens, pa.int32())], ["_doc", "piece", "tokens"]
            )

    return run


def _best_fit(size: np.ndarray, capacity: int) -> list[list[int]]:
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some container has room r
    for i in np.argsort(-size, kind="stable").tolist():
        need = int(size[i])
        above = rooms >> need
        if above:
            room = need + (above & -above).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        room -= need
        by_room[room].append(k)
        rooms |= 1 << room
    return bins


def _give(donor: list[int], taker: list[int], size: np.ndarray, room: int) -> int:
    """The best single exchange from ``donor`` to ``taker`` that adds at most
    ``room``; changes both lists and returns what it added (0: none)."""
    gain, plan = 0, None
    for x in donor:
        a = int(size[x])
        if gain < a <= room:
            gain, plan = a, ((x,), ())
        for y in taker:
            d = a - int(size[y])
            if gain < d <= room:
                gain, plan = d, ((x,), (y,))
    for i, x in enumerate(donor):
        for z in donor[i + 1 :]:
            a = int(size[x] + size[z])
            for y in taker:
                d = a - int(size[y])
                if gain < d <= room:
                    gain, plan = d, ((x, z), (y,))
    if plan is None:
        return 0
    out, back = plan
    for x in out:
        donor.remove(x)
    for y in back:
        taker.remove(y)
    donor.extend(back)
    taker.extend(out)
    return gain


def pack(size: np.ndarray, capacity: int, rounds: int = 10) -> np.ndarray:
    """Container number of each item; no item may exceed ``capacity``.

    ``rounds`` bounds the donors that are tried without success.  Items of size
    0 fill nothing; an empty input gives an empty result."""
    bins = _best_fit(size, capacity)
    least = max(1, -(-int(size.sum()) // capacity))
    failed = 0
    skip: set[int] = set()
    while len(bins) > least and failed < rounds:
        fill = np.array([int(size[b].sum()) for b in bins])
        order = [int(k) for k in np.argsort(fill, kind="stable") if id(bins[k]) not in skip]
        if not order or fill[order[0]] >= capacity:
            break
        d = order[0]
        donor = bins[d]
        for k in np.argsort(fill, kind="stable")[::-1].tolist():
            room = capacity - int(fill[k])
            # Only towards a fuller container does an exchange raise the squared fill.
            while k != d and room > 0 and donor and (added := _give(donor, bins[k], size, room)):
                room -= added
            if not donor:
                break
        if donor:
            failed += 1
            skip.add(id(donor))
        else:
            bins.pop(d)
            failed = 0
    number = np.zeros(len(size), np.int64)
    for k, items in enumerate(bins):
        number[items] = k
    return number


def fill_containers(documents: DataFrame, doc_id: str, text: str, capacity: int = 2048, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", portion: int = PORTION) -> DataFrame:
    """Container of each document: ``(doc_id, piece, tokens, container)``.

    Only a text longer than ``capacity`` is split, into full pieces and a rest.
    Null and empty texts are items of no tokens; repeated rows and null ids are
    items of their own; an empty table gives an empty result; further columns
    are ignored.
    """
    docs = documents.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    kind = docs.schema["_doc"].dataType.simpleString()
    # The rank file (a few MB, whatever the data) is read once and shipped, so no worker needs the folder.
    with open(vocabulary, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    sizes = cut(docs.mapInArrow(_measured(shared, capacity), f"_doc {kind}, piece int, tokens int"))
    portions = max(1, -(-sizes.count() // portion))
    dealt = sizes.withColumn("_portion", F.pmod(F.monotonically_increasing_id() + F.shiftrightunsigned(F.monotonically_increasing_id(), 33), F.lit(portions)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        number = pack(rows["tokens"].to_numpy(np.int64), capacity)
        return rows[["_doc", "piece", "tokens"]].assign(container=(int(key[0]) << 32) + number)

    packed = dealt.groupBy("_portion").applyInPandas(run, f"_doc {kind}, piece int, tokens int, container bigint")
    return packed.withColumnRenamed("_doc", doc_id)


def document_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's container of 2,048 tokens."""
    return fill_containers(table(spark, sf_dir, "documents"), "doc_id", "text")
