"""Registered queries: each a Spark callable, most with the same result as DuckDB SQL."""

from registry.core import REGISTRY, Query, query

from registry import analysis, io, jobs, preparing, quality, ratings, trends  # noqa: F401,E402

__all__ = ["REGISTRY", "Query", "query"]
