"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = 0xFFFFFFFFFFFFFFFF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Where that is
    unset, a local session (tests, a laptop) takes a folder of its own; a session
    on several machines is refused, as no folder of one machine serves the others.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusloom-"))
    return df.checkpoint(eager=True)


def current_rows(skills: DataFrame, *columns: str) -> DataFrame:
    """The latest state of each ``skill_id``; ties are settled by the other
    columns, so the choice does not depend on the order of rows.  Rows without
    an id are dropped; a missing ``updated_at`` counts as the earliest."""
    rest = [c for c in columns if c not in ("skill_id", "updated_at")]
    latest = F.max(F.struct("updated_at", *rest)).alias("_row")
    return (
        skills.filter(F.col("skill_id").isNotNull())
        .groupBy("skill_id")
        .agg(latest)
        .select("skill_id", *[F.col(f"_row.{c}").alias(c) for c in ("updated_at", *rest) if c in columns])
    )


def clean_source(column: Column | str) -> Column:
    """Sources compare without case and outer blanks."""
    return F.lower(F.trim(F.col(column) if isinstance(column, str) else column))


def usable_score(column: Column | str) -> Column:
    """The score where it lies on the 0-1 scale, else null."""
    score = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(score) & score.between(0.0, 1.0), score)


def trust_table(registry: DataFrame) -> DataFrame:
    """One row ``(_src, trust)`` per source; repeated entries keep the highest weight."""
    return registry.groupBy(clean_source("source").alias("_src")).agg(F.max("source_weight").alias("trust"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(size: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of an odd number modulo 2**64 and their inverses."""
    if cache.get("size", -1) < size:
        base = 0x9E3779B97F4A7C15
        power = np.full(size + 1, base, np.uint64)
        inverse = np.full(size + 1, pow(base, -1, 1 << 64), np.uint64)
        power[0] = inverse[0] = 1
        cache.update(size=size, tables=(np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)))
    power, inverse = cache["tables"]
    return power, inverse


_CHUNK = 1 << 20
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_WORDBYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


class Words:
    """Word hashes of a batch of texts, flat, with their owners and places.

    Words are maximal runs of letters and digits, ignoring case.  Nothing loops
    over words: runs are found in the UTF-8 buffer and hashed as differences of
    one cumulative polynomial over it.
    """

    def __init__(self, texts: pa.Array) -> None:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        plain = pc.string_is_ascii(texts)
        if not pc.all(plain).as_py():
            # Multi-byte characters that are neither letters nor digits become blanks; the others count as word bytes.
            texts = pc.if_else(plain, texts, pc.replace_substring_regex(pc.if_else(plain, "", texts), r"[^\x00-\x7F\p{L}\p{N}]", " "))
        self.texts = len(texts)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(ends) > 1 else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        word = _WORDBYTE[raw]
        first = np.zeros(len(raw) + 1, bool)
        first[ends] = True
        before = np.r_[False, word[:-1]] if len(raw) else word
        after = np.r_[word[1:], False] if len(raw) else word
        start = np.flatnonzero(word & (~before | first[:-1]))
        stop = np.flatnonzero(word & (~after | first[1:])) + 1
        power, inverse = _power_tables(_CHUNK)
        self.hash = np.zeros(len(start), np.uint64)
        done = 0
        while done < len(start):
            # Eight-byte values only for a few MB of text at a time, however long a text is.
            base = start[done]
            upto = max(done + 1, int(np.searchsorted(stop, base + _CHUNK, side="right")))
            part = raw[base : stop[upto - 1]]
            if len(part) > _CHUNK:
                power, inverse = _power_tables(len(part))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * power[: len(part)], dtype=np.uint64)])
            low, high = start[done:upto] - base, stop[done:upto] - base
            self.hash[done:upto] = mix64((total[high] - total[low]) * inverse[low] + (high - low).astype(np.uint64))
            done = upto
        self.raw, self.start, self.stop = raw, start, stop
        self.offset = np.searchsorted(start, ends)
        self.count = np.diff(self.offset)
        self.owner = np.repeat(np.arange(self.texts), self.count)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, owner and first word's place of every run of ``n`` words."""
        size = len(self.hash) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        acc = self.hash[:size].copy()
        for k in range(1, n):
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + (self.hash[k : k + size] ^ (acc >> np.uint64(29)))
        at = np.flatnonzero(self.owner[:size] == self.owner[n - 1 :])
        return mix64(acc[at]), self.owner[at], at

    def text(self, first: int, last: int) -> str:
        """The words from place ``first`` to before ``last``, in lower case, joined by blanks."""
        return " ".join(self.raw[self.start[i] : self.stop[i]].tobytes().decode("utf-8", "replace") for i in range(first, last))


#: Texts per portion and bits of a shingle's hash; together they fill 64 bits.
_PORTION_BITS, _GRAM_BITS = 14, 50


def shingle_sets(texts: pa.Array, n: int, least_words: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it: ``(hash, owner)``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    grams, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for s in range(0, len(texts), 1 << _PORTION_BITS):
        words = Words(texts.slice(s, 1 << _PORTION_BITS))
        gram, owner, _ = words.grams(n)
        if least_words:
            keep = words.count[owner] >= least_words
            gram, owner = gram[keep], owner[keep]
        both = (owner.astype(np.uint64) << np.uint64(_GRAM_BITS)) | (gram >> np.uint64(64 - _GRAM_BITS))
        both = np.sort(both)
        if len(both):
            both = both[np.r_[True, both[1:] != both[:-1]]]
        grams.append(both << np.uint64(64 - _GRAM_BITS))
        owners.append((both >> np.uint64(_GRAM_BITS)).astype(np.int64) + s)
    return np.concatenate(grams), np.concatenate(owners)
