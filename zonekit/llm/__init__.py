"""Training-data operators: cleaning, deduplication, mixing, packing, archives.

Nothing outside this subpackage imports it.  ``queries.QUERIES`` holds the
registered queries, ``oracle.ORACLE_SQL`` their DuckDB equivalents.
"""
