"""Operators of a large-scale training-data pipeline (see ``queries`` for their bindings).

Nothing else in the library imports this package.
"""
