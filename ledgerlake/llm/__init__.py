"""Operators for building training corpora: dedup, scoring, filtering, sharding, packing.

Nothing else in ``ledgerlake`` imports this subpackage. ``registry`` holds
the registered queries.
"""
