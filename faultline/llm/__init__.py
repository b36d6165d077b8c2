"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` binds them to the tables.  Nothing else
in the library imports this package.
"""
