"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; ``queries.py`` registers
one query per operator, ``__spark_entry__`` adds them when it is present.
"""
