"""Independent DuckDB SQL for every registered query (the correctness gate)."""

from quorum.oracle.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
