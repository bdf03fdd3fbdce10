"""Shared pieces of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Group:
    """A group of registered queries, each with its SQL twin where SQL can say the same."""

    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None):
        def register(fn):
            if name in self.queries:
                raise KeyError(f"query {name} registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables. The registered queries read times as UTC, whatever the session had."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")
