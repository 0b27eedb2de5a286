"""Problem 1: near-duplicate records with small edits, as a verified set join.

A record is the set of its shingles (runs of n consecutive words), and records
with the same set are one class from the start.  The universe of shingles is
hashed into m segments, with m set by the set's size band; bands are a factor 4
wide and overlap by half, so two sets whose sizes differ by at most 2 share a
band, and sets of like size share one in which both lie near the middle.  Of
every segment a set indexes its subset there and, for small subsets, the
subset's one-deletion neighbourhood.  Two sets become candidates when they share
a signature of a segment: equal subsets, or subsets equal but for one shingle on
either side.

``allocation`` sets, per band, how many shingles a segment holds and which
subsets and neighbourhoods are indexed: the cheapest choice (entries, and false
candidates among so many records) under which a pair exactly at the threshold
shares no signature with a chance of at most ``MISS`` (its root for pairs across
a band's edge); pairs further above it are missed still less.  The choice depends on the size alone: a subset is never
left out for how many sets share it.

Candidates pass an exact lower bound on the symmetric difference (hashed
bitmaps) and are then verified on the whole texts, so nothing false comes out.
Texts travel for that only if a bitmap over the candidates' ids holds their
class; names travel once, by themselves.

Signatures travel as packed entries (8 bytes of id, about 2.5 of signature) in a
few blobs per task, not as rows; every task sends each class once.  The number
of buckets follows from the bytes of text, rows arrive sorted by key, and every
step holds one bucket, one cell or one batch at a time.  The classes of a signature
that many share are dealt out in blocks: every two blocks meet in a cell, where
all their pairs pass the bound at once, so its pairs never travel.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, mix64, shingle_sets, table

#: Chance that a pair exactly at the threshold shares no signature in either of its two
#: bands; a pair across a band's edge shares one band, and its bound is the root of this.
MISS = 0.02
#: Share of records that hold a given shingle of another record, as the cost model sees it.
SHARED = 0.1
#: What a false candidate costs, in entries.
PRICE = 5.0
BITS = 512
FLUSH_ENTRIES = 1_000_000
PAIRS_AT_ONCE = 1_000_000
#: Classes under one signature beyond which they are dealt out in blocks, and classes of a block.
BLOCK, CELL = 64, 2048
#: Rows of cells handed to Spark at once, and pairs compared at once.
CELL_ROWS, COMPARED = 50_000, 1 << 17
#: Bytes of text per partition of the joins.
PART_BYTES = 16 << 20
ID_BITS = 63
BANDS = 26
#: Kinds of rows in the order in which a step meets those of one key; pairs have an id instead.
INCELL, MAP, MEMBER, BLOB = -4, -3, -2, -1
#: Places of the bitmap that tells whose texts are sent: so many per candidate, within bits of
#: a place's number (at the most, more texts than needed are sent), in portions of so many bits.
PLACES, LEAST_BITS, MOST_BITS, PORTION_BITS = 8, 16, 28, 16


def _poisson(mean: float, most: int) -> np.ndarray:
    k = np.arange(most + 1)
    return np.exp(k * np.log(max(mean, 1e-12)) - mean - np.cumsum(np.r_[0.0, np.log(np.arange(1, most + 1))]))


def missed(size: float, threshold: float, per_segment: float, middle: float, least: int, cutable: int, most: int) -> float:
    """Chance that two sets of ``size`` shingles at similarity ``threshold`` share
    no signature of the band around ``middle``."""
    m = max(1.0, round(middle / per_segment))
    common = _poisson(2 * threshold * size / (1 + threshold) / m, 60)
    alone = _poisson((1 - threshold) * size / (1 + threshold) / m, 1)
    k = np.arange(61)
    whole, less = (k >= least) & (k <= most), (k >= least) & (k < cutable)
    met = common @ (whole * alone[0] ** 2 + (whole & less) * 2 * alone[0] * alone[1] + less * alone[1] ** 2)
    return float((1 - met) ** m)


def missed_within(size: float, threshold: float, per_segment: float, middle: float, least: int, cutable: int, most: int) -> float:
    """The same chance for a set of ``size`` shingles that lies wholly within one of ``size / threshold``."""
    m = max(1.0, round(middle / per_segment))
    common, alone = _poisson(size / m, 60), _poisson(size * (1 / threshold - 1) / m, 1)
    k = np.arange(61)
    whole = (k >= least) & (k <= most)
    met = common @ (whole * alone[0] + (whole & (k < cutable)) * alone[1])
    return float((1 - met) ** m)


@functools.cache
def allocation(threshold: float, magnitude: int) -> np.ndarray:
    """Per band (both shifts): segments, fewest and most shingles of an indexed
    subset, and most shingles of a subset with its deletions, for about
    ``10**magnitude`` records."""
    k = np.arange(61)
    choices = [(per, least, cutable, most) for per in (1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 6.0) for least in range(1, 7) for cutable in range(least, least + 5) for most in range(cutable, cutable + 3)]
    out = np.zeros((BANDS, 4))
    for half in range(BANDS):
        middle = 2.0 ** (half + 1)
        ranked = []
        for per, least, cutable, most in choices:
            m = max(1, round(middle / per))
            held = _poisson(middle / m, 60)
            taken, cuts = (k >= least) & (k <= most), (k > least) & (k <= cutable)
            entries = m * held @ (taken + k * cuts)
            false = m * held @ (taken * SHARED**k + k * cuts * SHARED ** (k - 1.0))
            ranked.append((entries + PRICE * 10.0**magnitude * false, per, (m, least, most, cutable)))
        ranked.sort()
        fallback = None
        for _, per, choice in ranked:
            args = (threshold, per, middle, choice[1], choice[3], choice[2])
            miss = max(missed(middle * f, *args) for f in (0.71, 1.0, 1.41))
            if miss * miss <= MISS:
                # A set within a larger one shares the band in which they lie around the middle.
                miss = max(miss, *(missed_within(middle * f * threshold**0.5, *args) for f in (0.8, 1.0, 1.25)))
            if fallback is None or miss < fallback[0]:
                fallback = (miss, choice)
            # Every size lies in two bands, which miss a pair independently.
            if miss * miss <= MISS:
                break
        # Bands of a few shingles cannot reach the bound; they take what misses least.
        out[half] = choice if miss * miss <= MISS else fallback[1]
    return out


def segment_signatures(gram: np.ndarray, owner: np.ndarray, size: np.ndarray, plan: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets by the ``plan`` of ``allocation``: ``(signature,
    owner)``; ``gram`` is sorted within each owner."""
    outs, owners = [], []
    if not len(gram):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    x = mix64(gram + np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
    log = np.log2(np.maximum(size, 1))
    for shift in (0, 1):
        # Bands [4**b, 4**(b+1)) and, shifted by half, [2 * 4**(b-1), 2 * 4**b); their middles are powers of two.
        band = np.minimum(len(plan) - 1, np.maximum(0, 2 * np.floor((log + shift) / 2).astype(np.int64) - shift))
        m, least, most, cutable = plan[band].T
        # The upper half of the hash, scaled, is the segment; sorted hashes keep a segment's shingles together.
        segment = ((gram >> np.uint64(32)) * m.astype(np.uint64)[owner]) >> np.uint64(32)
        start = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])])
        held = np.diff(np.r_[start, len(gram)])
        who = owner[start]
        salt = mix64(segment[start] * np.uint64(1_000_003) + (band[who] * 2 + shift).astype(np.uint64) + np.uint64(17))
        whole = total[start + held] - total[start]
        taken = (held >= least[who]) & (held <= most[who])
        outs.append(mix64(whole[taken] + salt[taken]))
        owners.append(who[taken])
        cuts = (held > least[who]) & (held <= cutable[who])
        at = np.repeat(np.arange(len(start)), held)
        one = cuts[at]
        outs.append(mix64(whole[at[one]] - x[one] + salt[at[one]]))
        owners.append(owner[one])
    return np.concatenate(outs), np.concatenate(owners)


def set_ids(gram: np.ndarray, owner: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each whole set, without sign; equal sets have equal ids."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(gram ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
    end = np.cumsum(size)
    return mix64(total[end] - total[end - size] + size.astype(np.uint64)) >> np.uint64(64 - ID_BITS)


def _bitmaps(gram: np.ndarray, owner: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per set its size (4 bytes) and a bitmap of hashed shingles."""
    bits = np.zeros((len(size), BITS), bool)
    bits[owner, (mix64(gram) % np.uint64(BITS)).astype(np.int64)] = True
    return np.concatenate([size.astype("<u4")[:, None].view(np.uint8), np.packbits(bits, axis=1)], axis=1)


def _binary(rows: np.ndarray) -> pa.Array:
    """A two-dimensional byte array as one binary value per row."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _stacked(data: pa.Array, at: np.ndarray, width: int) -> np.ndarray:
    """Values of equal length as the rows of one array."""
    return np.frombuffer(b"".join(data.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), width)


def _packed(sig: np.ndarray, ids: np.ndarray) -> bytes:
    """Entries as one value: lower halves of signatures, sorted, as differences by byte planes, and ids as they are."""
    low = sig.astype(np.uint32)
    order = np.argsort(low, kind="stable")
    low = low[order]
    planes = np.diff(low, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    body = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)
    return np.uint64(len(sig)).tobytes() + ids.astype("<u8")[order].tobytes() + body


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lower halves of signatures, and ids."""
    n = int(np.frombuffer(blob, "<u8", 1)[0])
    planes = np.frombuffer(pa.decompress(blob[8 * n + 8 :], decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32), np.frombuffer(blob, "<u8", n, 8)


MIXED = "key long, other long, data binary"


def _batch(key: np.ndarray, other: np.ndarray, data: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(other, pa.int64()), data], ["key", "other", "data"])


def _known_sets(texts: pa.Array, n: int, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles with their owners, sizes and ids of the sets of a batch, and the rows of these sets."""
    gram, owner = shingle_sets(texts, n, least_words)
    size = np.bincount(owner, minlength=len(texts))
    real = np.flatnonzero(size)
    place = np.zeros(len(texts), np.int64)
    place[real] = np.arange(len(real))
    owner, size = place[owner], size[real]
    return gram, owner, size, set_ids(gram, owner, size), real


def _fresh(ids: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which ids come for the first time in this task."""
    fresh = np.zeros(len(ids), bool)
    fresh[np.unique(ids, return_index=True)[1]] = True
    fresh &= np.array([i not in seen for i in ids.tolist()], bool)
    seen.update(ids[fresh].tolist())
    return fresh


def _signatures(n: int, least_words: int, buckets: int, plan: np.ndarray):
    """Texts to blobs of ``(signature, class)`` by bucket, and bitmaps by class;
    ``other`` tells which (``MAP``, ``BLOB``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[int] = set()
        count = 0

        def flush() -> pa.RecordBatch:
            sig = np.concatenate([h[0] for h in held])
            ids = np.concatenate([h[1] for h in held])
            bucket = (sig >> np.uint64(40)) % np.uint64(buckets)
            order = np.argsort(bucket.astype(np.int32), kind="stable")
            sig, ids = sig[order], ids[order]
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(edges))
            blobs = [_packed(sig[edges[b] : edges[b + 1]], ids[edges[b] : edges[b + 1]]) for b in some]
            return _batch(some, np.full(len(some), BLOB), pa.array(blobs, pa.binary()))

        for batch in batches:
            gram, owner, size, ids, _ = _known_sets(batch.column(0), n, least_words)
            # Copies of a set that this task has sent already send nothing more.
            fresh = _fresh(ids, seen)
            if not fresh.any():
                continue
            place = np.cumsum(fresh) - 1
            keep = fresh[owner]
            gram, owner, size, ids = gram[keep], place[owner[keep]], size[fresh], ids[fresh]
            yield _batch(ids.astype(np.int64), np.full(len(ids), MAP), _binary(_bitmaps(gram, owner, size)))
            sig, who = segment_signatures(gram, owner, size, plan)
            held.append((sig, ids[who]))
            count += len(sig)
            if count >= FLUSH_ENTRIES:
                yield flush()
                held, count = [], 0
        if count:
            yield flush()

    return run


def _named(n: int, least_words: int):
    """Names and texts to the class of each text and its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *_, ids, real = _known_sets(batch.column(1), n, least_words)
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), batch.column(0).take(pa.array(real))], ["id", "name"])

    return run


def _spoken(n: int, least_words: int, marks: np.ndarray, bits: int):
    """Texts to ``(class, text)``, once per task, of the classes that ``marks`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            *_, ids, real = _known_sets(batch.column(0), n, least_words)
            at = (ids >> np.uint64(ID_BITS - bits)).astype(np.int64)
            asked = np.flatnonzero(marks[at >> 3] >> (at & 7) & 1)
            asked = asked[_fresh(ids[asked], seen)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[asked].astype(np.int64)), batch.column(0).take(pa.array(real[asked]))], ["id", "_text"])

    return run


def _marks(pairs: DataFrame, parts: int) -> tuple[np.ndarray, int]:
    """A bitmap of the ids in ``pairs``, by their upper bits, and how many bits these are."""
    places = max(1, pairs.count()) * 2 * PLACES
    bits = min(MOST_BITS, max(LEAST_BITS, places.bit_length()))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))

    def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy() >> (ID_BITS - bits))
            for portion in np.unique(at >> PORTION_BITS).tolist():
                own = held.setdefault(portion, np.zeros(1 << (PORTION_BITS - 3), np.uint8))
                place = at[at >> PORTION_BITS == portion] & ((1 << PORTION_BITS) - 1)
                np.bitwise_or.at(own, place >> 3, (1 << (place & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["portion", "marks"])

    marks = np.zeros(1 << (bits - 3), np.uint8)
    step = 1 << (PORTION_BITS - 3)
    for portion, own in ids.repartition(parts, F.shiftright("id", ID_BITS - bits + PORTION_BITS)).mapInArrow(portions, "portion long, marks binary").collect():
        marks[portion * step : (portion + 1) * step] |= np.frombuffer(own, np.uint8)
    return marks, bits


def _grouped(sig: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids sorted by signature, and where each signature begins (with the end)."""
    order = np.lexsort((ids, sig))
    sig, ids = sig[order], ids[order]
    first = np.r_[True, (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])] if len(sig) else np.zeros(0, bool)
    sig, ids = sig[first], ids[first]
    return ids, np.r_[np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]), len(sig)] if len(sig) else np.zeros(1, np.int64)


def _pairs_of(ids: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of different ids under one signature, in bounded portions."""
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    left, right, count = [], [], 0
    alive, step = np.arange(len(ids)), 1
    while len(alive):
        alive = alive[alive + step < len(ids)]
        alive = alive[group[alive] == group[alive + step]]
        left.append(ids[alive])
        right.append(ids[alive + step])
        count += len(alive)
        step += 1
        if count >= PAIRS_AT_ONCE:
            yield _distinct(np.concatenate(left), np.concatenate(right))
            left, right, count = [], [], 0
    if count:
        yield _distinct(np.concatenate(left), np.concatenate(right))


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return a[first], b[first]


def _rows_by_kind(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    data = batch.column(2)
    return batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), data


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blobs, sorted by bucket, to pairs ``(key, other)``, smaller id first, and where
    a signature has many ids to members of its blocks; the rest passes."""

    def pairs(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, edges = _grouped(*(np.concatenate(x) for x in zip(*map(_unpacked, blobs))))
        held = np.diff(edges)
        for g in np.flatnonzero(held > BLOCK).tolist():
            own = ids[edges[g] : edges[g + 1]]
            rows = np.empty((len(own), 3), "<u8")
            # Signatures with the same classes have the same cells.
            rows[:, 0], rows[:, 1], rows[:, 2] = mix64(own).sum(dtype=np.uint64), np.arange(len(own)) // CELL, -(-len(own) // CELL)
            yield _batch(own.astype(np.int64), np.full(len(own), MEMBER), _binary(rows.view(np.uint8)))
        few = held <= BLOCK
        keep = np.repeat(few, held)
        for a, b in _pairs_of(ids[keep], np.r_[0, np.cumsum(held[few])]):
            yield _batch(a.astype(np.int64), b.astype(np.int64), pa.nulls(len(a), pa.binary()))

    bucket, blobs = None, []
    for batch in batches:
        key, other, data = _rows_by_kind(batch)
        rest = np.flatnonzero(other != BLOB)
        if len(rest):
            yield batch.take(pa.array(rest))
        for i in np.flatnonzero(other == BLOB).tolist():
            if key[i] != bucket and blobs:
                yield from pairs(blobs)
                blobs = []
            bucket = key[i]
            blobs.append(data[i].as_py())
    if blobs:
        yield from pairs(blobs)


class _Sorted:
    """Walks rows sorted by key, a bitmap before the members and pairs of its key,
    and keeps the last bitmap from one batch to the next."""

    def __init__(self) -> None:
        self.key, self.row = None, None
        self.last = (None, None)

    def read(self, batch: pa.RecordBatch):
        """First rows of bitmaps, members and pairs that are new, and the bitmap of each of these."""
        key, other, data = _rows_by_kind(batch)
        width = 4 + BITS // 8
        maps = np.flatnonzero(other == MAP)
        held = _stacked(data, maps, width)
        own_key = key[maps]
        if self.key is not None:
            held, own_key = np.concatenate([self.row[None], held]), np.r_[self.key, own_key]
            maps = np.r_[-1, maps]
        pairs = np.flatnonzero((other >= 0) | (other == MEMBER))
        new = np.r_[True, (key[1:] != key[:-1]) | (other[1:] != other[:-1])]
        if len(key) and (key[0], other[0]) == self.last:
            new[0] = False
        pairs = pairs[new[pairs] | (other[pairs] == MEMBER)]
        at = np.searchsorted(maps, pairs, side="right") - 1
        good = at >= 0
        good[good] = own_key[at[good]] == key[pairs[good]]
        pairs, at = pairs[good], at[good]
        fresh = maps[(maps >= 0) & np.r_[True, own_key[1:] != own_key[:-1]]] if len(maps) else maps
        if len(maps):
            self.key, self.row = own_key[-1], held[-1]
        if len(key):
            self.last = (key[-1], other[-1])
        return key, other, fresh, pairs, held[at] if len(pairs) else np.zeros((0, width), np.uint8)


def _cells(ids: np.ndarray, members: np.ndarray, maps: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Members with their bitmaps to each of the cells of their blocks: id, place in
    the cell (0 or 1, 2 where a block meets itself), bitmap."""
    group, block, blocks = members.T
    ends = np.cumsum(blocks.astype(np.int64))
    total = int(ends[-1]) if len(ends) else 0
    for first in range(0, total, CELL_ROWS):
        row = np.arange(first, min(total, first + CELL_ROWS))
        at = np.searchsorted(ends, row, side="right")
        own, met = block[at], (row - (ends[at] - blocks[at].astype(np.int64))).astype(np.uint64)
        key = mix64(group[at] + mix64(np.minimum(own, met) * np.uint64(1_000_003) + np.maximum(own, met) + np.uint64(29)))
        place = np.where(own == met, 2, own > met).astype(np.uint8)
        data = np.concatenate([ids[at].astype("<i8")[:, None].view(np.uint8), place[:, None], maps[at]], axis=1)
        yield _batch(key.astype(np.int64), np.full(len(row), INCELL), _binary(data))


def _attached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs, sorted by their first id, take its bitmap along to their second id, members theirs to their cells."""
    walk = _Sorted()
    for batch in batches:
        key, other, fresh, pairs, maps = walk.read(batch)
        if len(fresh):
            yield batch.take(pa.array(fresh, pa.int64()))
        member = other[pairs] == MEMBER
        if member.any():
            rows = _stacked(batch.column(2), pairs[member], 24).view("<u8").reshape(-1, 3)
            yield from _cells(key[pairs[member]], rows, maps[member])
        pairs, maps = pairs[~member], maps[~member]
        if len(pairs):
            yield _batch(other[pairs], key[pairs], _binary(maps))


def _within_cell(rows: np.ndarray, most_apart: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a cell that pass the bound."""
    ids = np.ascontiguousarray(rows[:, :8]).view("<i8").ravel()
    sides = []
    for place in (0, 1, 2):
        mine = np.flatnonzero(rows[:, 8] == place)
        mine = mine[np.unique(ids[mine], return_index=True)[1]]
        size = np.ascontiguousarray(rows[mine, 9:13]).view("<u4").ravel().astype(np.int64)
        sides.append((ids[mine], size, np.ascontiguousarray(rows[mine, 13:]).view(np.uint64)))
    for (a, size_a, bits_a), (b, size_b, bits_b), itself in ((sides[0], sides[1], False), (sides[2], sides[2], True)):
        step = max(1, COMPARED // max(1, len(b)))
        for s in range(0, len(a) if len(b) else 0, step):
            apart = np.zeros((len(a[s : s + step]), len(b)), np.uint16)
            for word in range(bits_a.shape[1]):
                apart += np.bitwise_count(bits_a[s : s + step, word, None] ^ bits_b[None, :, word])
            x, y = np.nonzero(apart <= (size_a[s : s + step, None] + size_b[None, :]) * most_apart + 1e-9)
            x, y = a[s + x], b[y]
            good = x < y if itself else x != y
            yield np.minimum(x, y)[good], np.maximum(x, y)[good]


def _bounded(threshold: float):
    """Pairs, single or of a cell, whose symmetric difference may be small enough, by the bitmaps' bound."""
    most_apart = (1 - threshold) / (1 + threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Sorted()
        cell, held = None, []

        def closed() -> Iterator[pa.RecordBatch]:
            for a, b in _within_cell(np.concatenate(held), most_apart):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            key, other, _, pairs, y = walk.read(batch)
            members = np.flatnonzero(other == INCELL)
            if len(members):
                rows, keys = _stacked(batch.column(2), members, 9 + y.shape[1]), key[members]
                edges = np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)]
                for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    if keys[s] != cell and held:
                        yield from closed()
                        held = []
                    cell = keys[s]
                    held.append(rows[s:e])
            if len(pairs):
                x = _stacked(batch.column(2), pairs, y.shape[1])
                size = sum(np.ascontiguousarray(v[:, :4]).view("<u4").ravel().astype(np.int64) for v in (x, y))
                apart = np.bitwise_count(x[:, 4:] ^ y[:, 4:]).sum(axis=1, dtype=np.int64)
                good = pairs[apart <= size * most_apart + 1e-9]
                yield pa.RecordBatch.from_arrays([pa.array(other[good], pa.int64()), pa.array(key[good], pa.int64())], ["a", "b"])
        if held:
            yield from closed()

    return run


def _verified(n: int, least_words: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            gram_a, own_a = shingle_sets(batch.column("_text_a"), n, least_words)
            gram_b, own_b = shingle_sets(batch.column("_text_b"), n, least_words)
            gram, own = np.concatenate([gram_a, gram_b]), np.concatenate([own_a, own_b])
            order = np.lexsort((gram, own))
            gram, own = gram[order], own[order]
            twice = np.flatnonzero((own[1:] == own[:-1]) & (gram[1:] == gram[:-1])) if len(own) else np.zeros(0, np.int64)
            both = np.bincount(own[twice], minlength=count)
            union = np.bincount(own, minlength=count) - both
            good = pa.array(np.flatnonzero((union > 0) & (both >= threshold * union)))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(good), batch.column("b").take(good)], ["a", "b"])

    return run


def near_classes(records: DataFrame, name: str, text: str, shingle: int = 5, threshold: float = 0.8, least_words: int = 0) -> tuple[DataFrame, DataFrame]:
    """Links between classes of texts, and the classes' members.

    A class holds the texts with one and the same shingle set.  Returns ``(links,
    members)``: ``links(a, b)`` has each pair of classes, ``a < b``, whose sets
    have a Jaccard similarity of at least ``threshold``; ``members(id, name)``
    has every name in each of its classes.  Rows with a null name or text, and
    texts of fewer than ``least_words`` words or without a shingle, are in no
    class.  Repeated rows count once; a name with several texts is in several
    classes.  Further columns are ignored; whole texts are read, whatever their
    length; an empty table gives two empty results.
    """
    docs = records.select(F.col(name).cast("string").alias("_name"), F.col(text).alias("_text")).filter("_name IS NOT NULL AND _text IS NOT NULL")
    rows, volume = docs.agg(F.count("*"), F.sum(F.octet_length("_text"))).first()
    parts = max(records.sparkSession.sparkContext.defaultParallelism, -(-(volume or 0) // PART_BYTES))
    plan = allocation(threshold, max(3, len(str(rows)) - 1))
    signed = docs.select("_text").mapInArrow(_signatures(shingle, least_words, 4 * parts, plan), MIXED)
    routed = signed.repartition(parts, "key").sortWithinPartitions("key", "other").mapInArrow(_candidates, MIXED)
    routed = routed.repartition(parts, "key").sortWithinPartitions("key", "other").mapInArrow(_attached, MIXED)
    routed = routed.repartition(parts, "key").sortWithinPartitions("key", "other").mapInArrow(_bounded(threshold), "a long, b long")
    close = cut(routed.distinct())
    # Columns that can't be null get no filters of their own, so all that read members or texts share one exchange by id.
    sure = lambda c, none: F.coalesce(F.col(c), F.lit(none)).alias(c)
    members = docs.mapInArrow(_named(shingle, least_words), "id long, name string").select(sure("id", 0), sure("name", "")).repartition("id").distinct()
    spoken = docs.select("_text").mapInArrow(_spoken(shingle, least_words, *_marks(close, parts)), "id long, _text string")
    # Texts of one class have the same set, so any of them stands for it.
    classes = spoken.select(sure("id", 0), sure("_text", "")).repartition("id").dropDuplicates(["id"])
    first = classes.select(F.col("id").alias("a"), F.col("_text").alias("_text_a"))
    second = classes.select(F.col("id").alias("b"), F.col("_text").alias("_text_b"))
    met = close.join(first, "a").join(second, "b").select("a", "b", "_text_a", "_text_b")
    links = met.mapInArrow(_verified(shingle, least_words, threshold), "a long, b long").distinct()
    return links, members


def near_pairs(records: DataFrame, name: str, text: str, shingle: int = 5, threshold: float = 0.8, least_words: int = 0) -> DataFrame:
    """Pairs of different names whose texts' shingle sets are alike: ``(a, b)`` with
    ``a < b``, each pair once; the links of ``near_classes`` and the classes
    themselves, written out over their members."""
    links, members = near_classes(records, name, text, shingle, threshold, least_words)
    left, right = members.select(F.col("id").alias("a"), F.col("name").alias("_x")), members.select(F.col("id").alias("b"), F.col("name").alias("_y"))
    across = links.join(left, "a").join(right, "b").select("_x", "_y")
    within = left.join(right, F.col("a") == F.col("b")).select("_x", "_y").filter("_x < _y")
    return across.union(within).filter("_x <> _y").select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b")).distinct()


def alike_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of content hashes whose bodies, of 60 words or more, share half of
    their distinct sequences of three words."""
    skills = table(spark, sf_dir, "skills")
    pairs = near_pairs(skills, "content_hash", "body", shingle=3, threshold=0.5, least_words=60)
    return pairs.withColumnsRenamed({"a": "content_hash_a", "b": "content_hash_b"})
