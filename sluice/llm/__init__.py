"""Operators for large text corpora (deduplication, filtering, formatting).

Nothing outside this package imports it.  Each operator is a module with a
general function; ``queries.py`` registers the ``opN_<name>`` queries.
"""
