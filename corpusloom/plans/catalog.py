"""All queries of the core library and their SQL."""

from corpusloom.plans import corpus_queries, curation_queries, evaluation_queries, search_queries, stream_queries

QUERIES: dict = {}
SQL: dict = {}
for _part in (corpus_queries, search_queries, curation_queries, evaluation_queries, stream_queries):
    QUERIES |= _part.QUERIES
    SQL |= _part.SQL
