"""DuckDB SQL equivalents of the registered queries (the correctness oracle)."""

from oracle.sql import oracle_queries  # noqa: F401
