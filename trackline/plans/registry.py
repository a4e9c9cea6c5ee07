"""A query of the catalogue: how to build it on Spark and the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None = None


class Catalogue(dict[str, Query]):
    """Queries by name."""

    def add(self, name: str, sql: str | None = None) -> Callable[[Build], Build]:
        def register(build: Build) -> Build:
            if name in self:
                raise ValueError(f"query {name} exists already")
            self[name] = Query(name, build, sql)
            return build

        return register
