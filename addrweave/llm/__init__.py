"""Operators of a training-data pipeline: de-duplication, mixing, tokenizing, scoring and filtering.

Nothing else in the library imports this subpackage. ``queries.py`` registers one query per operator.
"""
