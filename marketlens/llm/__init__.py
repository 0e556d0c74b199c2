"""Training-data operators: scoring, deduplication, extraction, search, counting, packing.

One module per operator, each with a general interface over any DataFrame; ``queries.py``
binds them to the driver's tables. Nothing outside this subpackage imports it.
"""
