"""Lexical search: document frequencies and BM25 rankings.

Nulls: a null text has no terms; rows with a null key are dropped.  A document
without terms still counts in the number of documents and in the mean length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import ranker


def document_frequency(docs: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``(term, df)``: documents that hold each term."""
    return docs.filter(F.col(key).isNotNull()).select(F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def bm25(
    requests: DataFrame, request: str, terms: Column, docs: DataFrame, key: str, tokens: Column, k: int,
    repeated: bool = False, stop_share: float | None = None, stop_from: int = 10, pad: bool = False, digits: int = 6,
    carry: list[str] = (), bring: list[str] = (), others: int = 0,
) -> DataFrame:
    """The ``k`` best documents of every request: ``(request, key, score, rank)``.

    Terms of a request count once, or as often as they occur if ``repeated``.  With
    ``stop_share``, terms in more than this share of the documents are ignored
    once there are ``stop_from`` documents.  Scores are rounded to ``digits``, ties
    go by key.  With ``pad`` a request always has ``k`` documents: those without
    any term follow with score 0, in the order of their keys.  Requests with a
    null id are dropped; repeated requests must be made distinct before.  ``carry``
    and ``bring`` are further columns of requests and documents to be kept.  With
    ``others`` there are so many rows of documents outside the list, as in ``search``.
    """
    channel = ranker.Channel(terms, tokens, k, repeated, stop_share, stop_from, pad, digits)
    best = ranker.search(requests, request, docs, key, [channel], carry, bring, others=others)
    return best.select(request, key, F.col("score0").alias("score"), F.col("rank0").alias("rank"), *carry, *bring, *(["other"] if others else []))
