"""Operators that prepare training data: filters, near duplicates, mixing, sharding, archives and chat texts.

Nothing else in the library imports this subpackage. `registry` holds the queries over the test tables.
"""
