"""Expanding all queries of all topics with one expander."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def expand_queries(
    queries: DataFrame, expander: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Apply any expander, a function on ``(query_id, query_text, ...)``; none leaves the queries."""
    return queries if expander is None else expander(queries)
