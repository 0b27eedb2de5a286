"""corpusloom: curation, retrieval and evaluation analytics for document corpora on Spark."""
