"""Operators of a training-data pipeline: extraction, de-duplication, quality, mixing, encoding.

Nothing outside this package (and corpus_pipeline.py) imports it. Every module has one operator
with a general interface; queries.py has the thin queries over the given tables.
"""
