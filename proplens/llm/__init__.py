"""Operators of a large-scale training-data pipeline, each a job over whole tables.

Nothing else in the library imports this subpackage.
"""
