"""Operators of a training-data pipeline: scoring, deduplication, archives, extraction, mixing, tokenising.

Nothing else in the library imports this subpackage; ``queries`` registers its queries.
"""
