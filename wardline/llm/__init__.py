"""Operators of a training-data pipeline: cleaning, deduplication, mixing, scoring, search.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
