"""Streamed reads: stop between micro-batches, decode with two sinks, series aggregation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.values import duration_ms_of
from recordlake.model import RecordSpec, TimeseriesSpec
from recordlake.operators.codec import decode_columns, split_errors


class _Stopped(Exception):
    """Ends a stream before the batch it is raised in is committed."""


def stream_until(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], bool]) -> dict:
    """Hand micro-batches to ``handle`` until it returns False or the input ends.

    The batch that asks to stop is counted and committed. The next one is refused before it is
    committed, so a later read with the same checkpoint starts with it. Returns batches, rows and truncated.
    """
    seen = {"batches": 0, "rows": 0, "truncated": False}

    def apply(batch: DataFrame, batch_id: int) -> None:
        if seen["truncated"]:
            raise _Stopped(f"the read stopped before batch {batch_id}")
        seen["batches"] += 1
        seen["rows"] += batch.count()
        if not handle(batch, batch_id):
            seen["truncated"] = True

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if not seen["truncated"] or "_Stopped" not in str(e):
            raise
    return seen


def stream_decode(records: DataFrame, spec: RecordSpec, root: str):
    """Decode a record stream into ``<root>/decoded``, rows with their errors; a retried batch overwrites its
    own files. ``decoded_rows`` gives the good and the bad side."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        decode_columns(batch, spec).write.mode("overwrite").parquet(f"{root}/decoded/batch={batch_id}")

    return records.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def decoded_rows(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The decoded rows without errors, and one row per bad field of the others."""
    return split_errors(spark.read.parquet(f"{root}/decoded").drop("batch"))


def stream_downsample(samples: DataFrame, spec: TimeseriesSpec, width: str, lateness: str) -> DataFrame:
    """Streaming tumbling aggregates: count, min, max and sum per window and tag set.

    Rows older than the watermark (the largest time seen less ``lateness``) are dropped by Spark,
    which reports them as ``numRowsDroppedByWatermark``. Zone-less timestamps become UTC instants.
    """
    ts = F.col(spec.timestamp).cast("timestamp")
    timed = samples.withColumn(spec.timestamp, ts).withWatermark(spec.timestamp, f"{duration_ms_of(lateness)} milliseconds")
    window = F.window(spec.timestamp, f"{duration_ms_of(width)} milliseconds")
    aggregates = [F.count(F.lit(1)).alias("samples")]
    for f in spec.fields:
        aggregates += [F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max"),
                       F.sum(F.col(f).cast("decimal(28,6)")).cast("double").alias(f"{f}_sum")]
    measures = [f"{f}_{s}" for f in spec.fields for s in ("min", "max", "sum")]
    return timed.groupBy(window, *spec.tags).agg(*aggregates).select(
        F.col("window.start").alias("window_start"), *spec.tags, "samples", *measures)


def stream_to(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Write a stream to Parquet until the available input is used up."""
    return df.writeStream.format("parquet").outputMode(mode).option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
