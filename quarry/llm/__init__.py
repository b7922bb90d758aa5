"""Operators of a training-data pipeline: ten jobs over whole document tables.

Nothing else in the package imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_<name>`` queries and their SQL.
"""
