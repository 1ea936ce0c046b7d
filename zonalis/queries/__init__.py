"""Every operator as a query over the driver's tables, next to the SQL that must give the same rows."""

from zonalis.queries.registry import oracles, queries

__all__ = ["oracles", "queries"]
