"""Training-data operators: tokenising, mixing, filtering, deduplication and scoring of text corpora.

Nothing else in the library imports this subpackage.
"""
