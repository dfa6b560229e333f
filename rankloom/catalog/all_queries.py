"""Imports every module of registered queries."""

from rankloom.catalog import (  # noqa: F401
    corpus_queries,
    evaluation_queries,
    expand_queries,
    report_queries,
    search_queries,
    text_queries,
    vector_queries,
)
from rankloom.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
