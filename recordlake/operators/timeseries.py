"""Time-series samples: ingest, retention, compaction layout and downsampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.values import duration_ms_of
from recordlake.model import TimeseriesSpec
from recordlake.sources.ranged import Merged, RangedTable

# Precision names and the unit timestamps are cut to.
PRECISIONS = {"SECOND": "second", "MILLISECOND": "millisecond", "MICROSECOND": "microsecond", "MINUTE": "minute"}
# Spark times are microseconds, so a nanosecond series keeps its values as they are.
FINER = ("NANOSECOND",)


def ts_ingest(df: DataFrame, spec: TimeseriesSpec, shards: int | None = None) -> DataFrame:
    """Samples of a declared series: timestamp cut to the precision, ``day`` and ``shard`` added.

    The shard is the tag-set hash, so a tag set stays together; a day is the pruning unit. A sample
    without a time cannot be placed: ``ts_rejected`` gives those rows.
    """
    ts = F.col(spec.timestamp)
    if spec.precision and spec.precision not in FINER:
        cut = F.date_trunc(PRECISIONS[spec.precision], ts).cast(df.schema[spec.timestamp].dataType)
    else:
        cut = ts
    count = shards or spec.shards or 1
    out = df.select(cut.alias(spec.timestamp), *spec.tags, *spec.fields).where(F.col(spec.timestamp).isNotNull())
    shard = F.pmod(F.xxhash64(*spec.tags), F.lit(count)) if spec.tags else F.lit(0)
    return out.withColumn("day", F.to_date(spec.timestamp)).withColumn("shard", shard.cast("int"))


def ts_rejected(df: DataFrame, spec: TimeseriesSpec) -> DataFrame:
    """The rows that ``ts_ingest`` leaves out, whole, with a ``code``."""
    return df.where(F.col(spec.timestamp).isNull()).withColumn("code", F.lit("null_timestamp"))


def write_series(df: DataFrame, spec: TimeseriesSpec, path: str, mode: str = "append") -> None:
    """Partition by day and shard. Range partitioning splits a hot shard over several files."""
    keys = ["day", "shard", *spec.tags, spec.timestamp]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).partitionBy("day", "shard").parquet(path)


def ts_retention(df: DataFrame, spec: TimeseriesSpec, now: Column) -> DataFrame:
    """Drop samples older than the retention; with a ``day`` partition column whole days are pruned."""
    age = duration_ms_of(spec.retention)
    if age is None:
        return df
    oldest = now - F.make_dt_interval(secs=F.lit(age / 1000).cast("decimal(18,6)"))
    kept = df.where(F.col(spec.timestamp) >= oldest)
    return kept.where(F.col("day") >= F.to_date(oldest)) if "day" in df.columns else kept


def interval_start(ts: Column, width: str) -> Column:
    """Start of the tumbling interval (``<n> UNIT`` text) holding the timestamp, from the epoch."""
    micros = duration_ms_of(width) * 1000
    since = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(since - F.pmod(since, F.lit(micros)))


def ts_compact(df: DataFrame, spec: TimeseriesSpec, width: str | None = None) -> DataFrame:
    """Samples laid out by compaction interval, ordered by tags and time; values are unchanged.

    Range partitioning on (interval, tags, time) splits an interval or tag set of any size.
    """
    out = df.withColumn("compacted", interval_start(F.col(spec.timestamp), width or spec.compaction))
    keys = ["compacted", *spec.tags, spec.timestamp]
    return out.repartitionByRange(*keys).sortWithinPartitions(*keys)


def ts_downsample(df: DataFrame, spec: TimeseriesSpec, width: str, tie: Sequence[str] = ()) -> DataFrame:
    """Tumbling count, min, max, avg, first and last of every field per tag set.

    ``tie`` orders samples of equal time for first and last. Everything aggregates map-side first.
    """
    order = F.struct(spec.timestamp, *tie)
    bucket = interval_start(F.col(spec.timestamp), width).alias("window_start")
    aggregates = [F.count(F.lit(1)).alias("samples")]
    for f in spec.fields:
        # Averages come from an exact decimal sum, so partial order does not show in the result.
        aggregates += [
            F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max"),
            (F.sum(F.col(f).cast("decimal(28,6)")).cast("double") / F.count(f)).alias(f"{f}_avg"),
            F.min_by(f, order).alias(f"{f}_first"), F.max_by(f, order).alias(f"{f}_last"),
        ]
    return df.groupBy(bucket, *spec.tags).agg(*aggregates)


# ---- rollups --------------------------------------------------------------------------------


def ts_partials(df: DataFrame, spec: TimeseriesSpec, width: str, tie: Sequence[str] = ()) -> DataFrame:
    """One row per interval and tag set that merges with others of it: counts, extremes, exact sums, and the
    first and last value with their places. Tags must not be null."""
    order = [F.col(spec.timestamp).alias("at"), *[F.col(t) for t in tie]]
    aggregates = [F.count(F.lit(1)).alias("samples")]
    for f in spec.fields:
        placed = F.struct(*order, F.col(f).alias("value"))
        aggregates += [F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max"), F.sum(F.col(f).cast("decimal(28,6)")).cast("decimal(38,6)").alias(f"{f}_sum"),
                       F.count(f).alias(f"{f}_n"), F.min(placed).alias(f"{f}_head"), F.max(placed).alias(f"{f}_tail")]
    return df.groupBy(interval_start(F.col(spec.timestamp), width).alias("window_start"), *spec.tags).agg(*aggregates)


def ts_widen(partials: DataFrame, spec: TimeseriesSpec, width: str) -> DataFrame:
    """Partials of a wider interval, of which the narrower one is a divisor, from narrower ones."""
    aggregates = [F.sum("samples").alias("samples")]
    for f in spec.fields:
        aggregates += [F.min(f"{f}_min").alias(f"{f}_min"), F.max(f"{f}_max").alias(f"{f}_max"), F.sum(f"{f}_sum").cast("decimal(38,6)").alias(f"{f}_sum"),
                       F.sum(f"{f}_n").alias(f"{f}_n"), F.min(f"{f}_head").alias(f"{f}_head"), F.max(f"{f}_tail").alias(f"{f}_tail")]
    return partials.groupBy(interval_start(F.col("window_start"), width).alias("window_start"), *spec.tags).agg(*aggregates)


def ts_finish(partials: DataFrame, spec: TimeseriesSpec) -> DataFrame:
    """The rows of ``ts_downsample`` from partials."""
    out = [F.col("window_start"), *[F.col(t) for t in spec.tags], F.col("samples")]
    for f in spec.fields:
        out += [F.col(f"{f}_min"), F.col(f"{f}_max"), (F.col(f"{f}_sum").cast("double") / F.col(f"{f}_n")).alias(f"{f}_avg"),
                F.col(f"{f}_head.value").alias(f"{f}_first"), F.col(f"{f}_tail.value").alias(f"{f}_last")]
    return partials.select(*out)


class Rollup:
    """Stored partials of one interval width, in order of interval and tags.

    ``add`` merges new samples, late ones too, into their intervals and writes anew only files that hold
    one of them. Samples must be added once; a stream of them goes through ``streaming.ingest`` first.
    ``read`` gives any wider interval without a look at the samples.
    """

    def __init__(self, spark, root: str, spec: TimeseriesSpec, width: str, tie: Sequence[str], samples: DataFrame, rows_per_file: int = 1_000_000):
        """``samples`` gives the types; none of its rows is read."""
        self.spec, self.width, self.tie = spec, width, list(tie)
        schema = ts_partials(samples.limit(0), spec, width, tie).schema
        self.table = RangedTable(spark, root, ["window_start", *spec.tags], schema, rows_per_file)

    def add(self, samples: DataFrame) -> Merged:
        changes = {"samples": F.col("samples") + F.col("_new.samples")}
        for f in self.spec.fields:
            for name, merged in (("min", F.least), ("head", F.least), ("max", F.greatest), ("tail", F.greatest)):
                changes[f"{f}_{name}"] = merged(F.col(f"{f}_{name}"), F.col(f"_new.{f}_{name}"))
            changes[f"{f}_sum"] = F.coalesce(F.col(f"{f}_sum") + F.col(f"_new.{f}_sum"), f"{f}_sum", f"_new.{f}_sum").cast("decimal(38,6)")
            changes[f"{f}_n"] = F.col(f"{f}_n") + F.col(f"_new.{f}_n")
        return self.table.merge(ts_partials(samples, self.spec, self.width, self.tie), changes)

    def read(self, width: str | None = None) -> DataFrame:
        partials = self.table.read()
        return ts_finish(partials if width is None else ts_widen(partials, self.spec, width), self.spec)
