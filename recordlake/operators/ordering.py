"""Dense row numbers without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.session import durable


def dense_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    group_by: Sequence[str] = (),
    name: str = "row_no",
    start: int = 0,
) -> DataFrame:
    """Number rows from ``start`` in ``order_by`` order, per ``group_by`` group when given.

    Rows are range-partitioned on (group, order), so a group of any size spreads over many tasks.
    Each row keeps its place inside its partition; the partitions' sizes, one row each, give the
    offsets. The placed rows are written out first, since both passes must see the same partitions.
    ``order_by`` must be a total order and group values must not be null.
    """
    keys = [*group_by, *order_by]
    return _numbered(df.repartitionByRange(*keys).sortWithinPartitions(*keys), group_by, name, start)


def number_in_groups(df: DataFrame, group_by: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Number the rows of each group from ``start`` without gaps, in no particular order.

    Rows stay in their partitions: each is sorted by group, counted per partition and group, and the prefix
    sums of these counts place it. No row is exchanged. There must be few groups, which must not be null.
    """
    return _numbered(df.sortWithinPartitions(*group_by), group_by, name, start)


def _numbered(ordered: DataFrame, group_by: Sequence[str], name: str, start: int) -> DataFrame:
    part, pos = "_part_no", "_part_pos"
    placed = durable(ordered.withColumn(part, F.spark_partition_id()).withColumn(
        pos, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    runs = placed.groupBy(part, *group_by).agg(
        F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_first")
    )
    before = Window.partitionBy(*group_by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        part, *group_by,
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + F.lit(start)).alias("_offset"),
    )
    # One offset row per partition and group: bounded by the number of partitions.
    return (
        placed.join(F.broadcast(offsets), [part, *group_by])
        .withColumn(name, (F.col(pos) + F.col("_offset")).cast("bigint"))
        .drop(part, pos, "_offset")
    )
