"""DuckDB twins of the registered Spark queries (the correctness oracle)."""

from .queries import ORACLE  # noqa: F401
