"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from saleslens.llm.catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
