"""Lookups, scalar reads, batches, pages, ordering and latest-row reads."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.predicates import Where
from recordlake.operators.ordering import dense_index
from recordlake.operators.ranges import MOST, By, Ordered, counted, rows_at
from recordlake.operators.skew import join_to_one
from recordlake.session import stored, work_path


def lookup_by_key(df: DataFrame, keys: DataFrame | dict, columns: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """Rows equal on a key. A dict asks for one key; a frame of keys gets one row per key.

    ``order`` names the column whose smallest value picks the row when a key has several. Without it the
    smallest row does, or where rows hold maps or VARIANT, which have no order, the one of the smallest hash.
    """
    if isinstance(keys, dict):
        if not keys:
            raise ValueError("a lookup needs at least one key column")
        where = Where()
        for name, value in keys.items():
            where = where.eq(name, value)
        found = where.apply(df)
        return (found.orderBy(order) if order else found).limit(1)
    if not columns:
        raise ValueError("a lookup needs at least one key column")
    wanted = keys.select(*columns).distinct()
    rest = [c for c in df.columns if c not in columns]
    matching = join_to_one(df, wanted, columns, "left_semi")
    if order:
        pick = F.min_by(F.struct(*rest), F.col(order))
    elif any(word in df.select(*rest).schema.simpleString() for word in ("map<", "variant")):
        pick = F.min_by(F.struct(*rest), F.xxhash64(F.to_json(F.struct(*rest))))
    else:
        pick = F.min(F.struct(*rest))
    best = matching.groupBy(*columns).agg(pick.alias("_row"), F.lit(True).alias("found"))
    return wanted.join(best, list(columns), "left").select(
        *columns, "_row.*", F.coalesce("found", F.lit(False)).alias("found")
    )


def lookup_by_rid(df: DataFrame, rids: DataFrame, rid: str = "rid") -> DataFrame:
    """The record at each asked rid, with a ``found`` flag."""
    return join_to_one(rids.select(rid), df.withColumn("_hit", F.lit(True)), [rid], "left").withColumn(
        "found", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def query_scalar(df: DataFrame) -> DataFrame:
    """The only column of the first row; any other width is an error, no row gives no row."""
    if len(df.columns) != 1:
        raise ValueError(f"a scalar query has one column, this has {len(df.columns)}")
    return df.limit(1)


def fetch_one(df: DataFrame, strict: bool = True) -> DataFrame:
    """The first row. The strict form fails at run time when there is none."""
    first = df.limit(1)
    if not strict:
        return first
    # A global count gives one row even for no input, so the check runs either way.
    packed = first.agg(
        F.first(F.struct(*first.columns)).alias("_row"),
        F.assert_true(F.count(F.lit(1)) > 0, "no row where one was required").alias("_check"),
    )
    return packed.where(F.col("_check").isNull()).select("_row.*")


def scalar_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def number_batches(df: DataFrame, order_by: Sequence[str | Column], size: int) -> DataFrame:
    """Contiguous ``row_no`` from 0 and ``batch_no`` = row_no div size."""
    return dense_index(df, order_by).withColumn("batch_no", F.floor(F.col("row_no") / F.lit(size)).cast("bigint"))


def consume_batches(
    df: DataFrame, order_by: Sequence[str | By], size: int, stop: Column, unique: bool = False, rows_per_range: int = MOST
) -> tuple[DataFrame, DataFrame]:
    """Read in batches until one satisfies ``stop``, an aggregate over the batch's rows.

    The batch that asks to stop is still counted. Returns the rows read and a one-row summary:
    batches, rows, running_total, is_last, truncated.

    The order is read range by range (about ``rows_per_range`` rows each): a range is sorted when it is
    reached, so a stop leaves the rest unsorted. Rows of a batch that reaches into the next range are kept
    for it. Rows equal in the order go by a hash of the whole row unless it is said to be ``unique``.
    """
    spark, rows = df.sparkSession, Ordered(df, order_by, unique)
    path, whole, at, batches, taken, stopped = work_path(spark, "batches"), df.count(), 0, 0, 0, False
    rest = None
    for low, high, n in counted(rows, max(size, rows_per_range)):
        ranged = rows.numbered(low, high, at, "row_no").withColumn("batch_no", F.floor(F.col("row_no") / F.lit(size)).cast("bigint"))
        ranged = ranged if rest is None else rest.unionByName(ranged)
        at += n
        full = -(-at // size) if at == whole else at // size
        if full == batches:
            rest = stored(ranged, "rest")
            continue
        here = ranged.where(F.col("batch_no") < full)
        first = here.groupBy("batch_no").agg(stop.alias("_stop")).where("_stop").agg(F.min("batch_no").alias("b")).first()["b"]
        if first is not None:
            here, full, stopped = here.where(F.col("batch_no") <= first), first + 1, True
        here.write.mode("append").parquet(path)
        batches, taken = full, min(full * size, at)
        if stopped:
            break
        rest = stored(ranged.where(F.col("batch_no") >= full), "rest")
    schema = T.StructType([*df.schema.fields, T.StructField("row_no", T.LongType()), T.StructField("batch_no", T.LongType())])
    read = spark.read.schema(schema).parquet(path) if batches else spark.createDataFrame([], schema)
    every = -(-whole // size)
    summary = spark.createDataFrame([(batches, taken, taken, batches == every and every > 0, stopped)],
                                    "batches bigint, rows bigint, running_total bigint, is_last boolean, truncated boolean")
    return read, summary


def materialized(df: DataFrame) -> DataFrame:
    """Compute everything once and keep it on executor disks; lost blocks are computed again."""
    return df.persist(StorageLevel.DISK_ONLY)


def read_pages(df: DataFrame, key: str, size: int, last=None, mode: str = "keyset", page: int = 0) -> DataFrame:
    """One page in key order. ``keyset`` continues after ``last``; ``offset`` skips whole pages."""
    if mode == "keyset":
        source = df if last is None else df.where(F.col(key) > F.lit(last))
        return source.orderBy(key).limit(size)
    if mode == "offset":
        return rows_at(df, [By(key)], page * size, size)
    raise ValueError(f"unknown page mode {mode!r}")


def iterate_pages(df: DataFrame, key: str, size: int, rows_per_range: int = MOST) -> Iterator[DataFrame]:
    """Every row, page by page in key order, null keys first; keys may repeat.

    Rows of one key stand in the order of a hash of the whole row. Each range of the order is numbered and
    written once, when its first page is asked for; a page is a filter on one or two such ranges.
    """
    rows, at, page, open_ = Ordered(df, [By(key)]), 0, 0, []
    name = "_row" if "_row" not in df.columns else "_row_"

    def pages(last: bool) -> Iterator[DataFrame]:
        nonlocal page, open_
        while (page + 1) * size <= at or (last and page * size < at):
            low, high = page * size, (page + 1) * size
            parts = [r.where((F.col(name) >= low) & (F.col(name) < high)) for r, a, b in open_ if a < high and b > low]
            page += 1
            open_ = [x for x in open_ if x[2] > page * size]
            yield reduce(DataFrame.unionByName, parts).orderBy(name).drop(name)

    for low, high, n in counted(rows, max(size, rows_per_range)):
        open_.append((rows.numbered(low, high, at, name), at, at + n))
        at += n
        yield from pages(False)
    yield from pages(True)


def order_limit(df: DataFrame, order_by: Sequence[str | By | Column], limit: int, skip: int = 0) -> DataFrame:
    """The first ``limit`` rows of an order after ``skip``. Names and ``By`` columns reach any depth by
    counted ranges; with sort expressions skip and limit rows are gathered."""
    if skip and not any(isinstance(o, Column) for o in order_by):
        return rows_at(df, order_by, skip, limit)
    ordered = df.orderBy(*[o.order if isinstance(o, By) else o for o in order_by])
    return (ordered.offset(skip) if skip else ordered).limit(limit)


def latest_row(df: DataFrame, keys: Sequence[str], newest: str | Column, tie: str | None = None) -> DataFrame:
    """The newest row per key, by aggregation: a key with any number of rows needs no sort."""
    rest = [c for c in df.columns if c not in keys]
    by = newest if isinstance(newest, Column) else F.col(newest)
    order = F.struct(by, F.col(tie)) if tie else by
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")


def update_stats(outcome: DataFrame) -> DataFrame:
    """Nodes and edges created or deleted and properties set, from an outcome with those columns."""

    def total(kind: str, action: str) -> Column:
        return F.count(F.when((F.col("kind") == kind) & (F.col("action") == action), F.lit(1)))

    return outcome.agg(
        total("vertex", "created").alias("nodes_created"),
        total("vertex", "deleted").alias("nodes_deleted"),
        total("edge", "created").alias("edges_created"),
        total("edge", "deleted").alias("edges_deleted"),
        F.coalesce(F.sum("properties_set"), F.lit(0)).cast("bigint").alias("properties_set"),
    )
