"""Training-data operators: near-dedup, archives, extraction, scoring, tokenising.

Nothing outside this package imports it.  Queries are in ``queries``, their DuckDB SQL in
``sql``; every other module holds one operator or a helper shared by several.
"""
