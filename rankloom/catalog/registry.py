"""Names, callables and SQL of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


class Registered(NamedTuple):
    build: Builder
    covers: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a function under its own name. ``covers`` lists ids of the operator inventory."""

    def add(build: Builder) -> Builder:
        if build.__name__ in REGISTRY:
            raise ValueError(f"query {build.__name__} is registered twice")
        REGISTRY[build.__name__] = Registered(build, tuple(covers.split()), sql)
        return build

    return add
