"""Training-data operators: archives, deduplication, sharding, scans, scoring and mixing.

Nothing outside this subpackage imports it. Every module holds one operator with a general
interface; ``queries.py`` holds the thin ``opN_<name>`` queries over the standard tables.
"""
