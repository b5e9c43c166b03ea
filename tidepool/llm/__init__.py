"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` holds the thin registered queries.
Nothing else in the library imports this subpackage.
"""
