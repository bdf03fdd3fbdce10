"""Reads: type scans over a hierarchy, bucket scans, dynamic records, bound queries."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.predicates import Where
from recordlake.model import TypeSet


def scan_type(types: TypeSet, name: str, where: Where | Column | None = None) -> DataFrame:
    """All records of a type and its subtypes, with a ``type`` column naming the concrete type."""
    parts = [
        types.tables[t].withColumn("type", F.lit(t)) for t in types.closure(name) if t in types.tables
    ]
    if not parts:
        raise ValueError(f"type {name} has no table behind it")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if where is None:
        return out
    return where.apply(out) if isinstance(where, Where) else out.where(where)


def write_buckets(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str = "overwrite", bucket_of: Column | None = None
) -> None:
    """Write a table partitioned by ``_bucket``: ``bucket_of``, or the key hash modulo ``buckets``.

    Range partitioning on (bucket, key) gives a large bucket several files instead of one long task.
    """
    bucket = bucket_of if bucket_of is not None else F.pmod(F.xxhash64(*keys), F.lit(buckets))
    placed = df.withColumn("_bucket", bucket.cast("int"))
    placed.repartitionByRange("_bucket", *keys).write.mode(mode).partitionBy("_bucket").parquet(path)


def scan_bucket(df: DataFrame, bucket: int, column: str = "_bucket") -> DataFrame:
    """One physical bucket; on a table partitioned by ``_bucket`` only that partition is read."""
    return df.where(F.col(column) == bucket)


def count_type(types: TypeSet, name: str, where: Where | Column | None = None) -> DataFrame:
    return scan_type(types, name, where).agg(F.count(F.lit(1)).alias("n"))


def read_records(
    df: DataFrame, json_column: str, rid: Column | None = None, type_name: Column | str | None = None
) -> DataFrame:
    """JSON text to dynamic records: ``rid``, ``type`` and a map of dynamic values.

    Text that is not a JSON object gives null properties; the row stays.
    """
    kind = F.lit(type_name) if isinstance(type_name, str) else type_name
    # Reading a non-object as a map gives null, as does broken text.
    properties = F.try_variant_get(F.try_parse_json(F.col(json_column)), "$", "map<string,variant>")
    return df.select(
        (rid if rid is not None else F.lit(None).cast("string")).alias("rid"),
        (kind if kind is not None else F.lit(None).cast("string")).alias("type"),
        properties.alias("properties"),
    )


def query_bound(spark: SparkSession, text: str, args: dict | list | None = None, limit: int | None = None, **views: DataFrame) -> DataFrame:
    """SQL text with named parameters, never string-interpolated; optional row limit."""
    out = spark.sql(text, args=args, **views) if args is not None else spark.sql(text, **views)
    return out.limit(limit) if limit is not None else out


def within_time(spark: SparkSession, time_limit_ms: int, action: Callable[[], object]):
    """Run an action (a write, a count) and cancel its jobs from the time limit on.

    Only jobs of this call are in its group; the watcher ends and the group is left with the call.
    """
    group, context, done = f"timed-{uuid.uuid4().hex}", spark.sparkContext, threading.Event()

    def watch() -> None:
        if not done.wait(time_limit_ms / 1000):
            while not done.wait(0.2):  # jobs that the action starts later are over time as well
                context.cancelJobGroup(group)

    context.setJobGroup(group, "timed action", interruptOnCancel=True)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        return action()
    finally:
        done.set()
        watcher.join()
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(name, None)
