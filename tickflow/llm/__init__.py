"""Operators for preparing training data: filtering, de-duplication, mixing, packing.

Each module holds one operator with a general interface; ``queries`` has the
thin registered queries and ``corpus_pipeline.py`` at the repository top
chains five of them.
"""
