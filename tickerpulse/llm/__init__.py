"""Operators for large training-data corpora.

Nothing else in the library imports this subpackage. Each ``opN_*`` module
holds one operator with a general interface; ``queries`` registers one thin
query per operator, and ``corpus_pipeline.py`` at the repository top chains
five of them.
"""
