"""Training-data operators: scoring, scanning, extraction, deduplication, decontamination, filtering and packing.

Every module holds one operator with a general interface over DataFrames; ``queries`` holds the thin ``opN_<name>``
queries over the given tables and their SQL.  Nothing else in the library imports this subpackage.
"""
