"""Operators for preparing language-model training data (deduplication, filtering, scoring, packing).

Each module holds one operator with its own general interface; ``queries`` applies them to
the driver tables. Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
