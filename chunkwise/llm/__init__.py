"""Operators a training-data pipeline needs, one module each.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries, ``sql`` their DuckDB counterparts.
"""
