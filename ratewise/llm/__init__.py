"""Training-data operators: deduplication, scoring, mixing and tokenisation of documents.

Nothing outside this subpackage imports it.  Every operator takes a DataFrame of
documents and returns a DataFrame; ``queries`` holds the thin registered queries.
"""
