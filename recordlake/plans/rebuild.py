"""Verified rebuild of a table into a new shape, and seeding."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.operators.change import row_changes
from recordlake.operators.load import bulk_load
from recordlake.operators.ordering import dense_index
from recordlake.operators.skew import join_to_one
from recordlake.operators.update import WriteResult, one_of_each
from recordlake.session import stored
from recordlake.sources import snapshots


REPORT = "source_rows bigint, target_rows bigint, missing_keys bigint, verified boolean"


class CopyMismatch(Exception):
    """The copy holds fewer rows than its source, or lacks some of its keys."""


def verify_copy(source_count: DataFrame | int, target: DataFrame, source: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """One row: source_rows, target_rows, missing_keys, verified.

    ``source_count`` is the count taken before the copy, so a copy that filters rows away is caught.
    With keys, every source key must be in the target.
    """
    before = source_count.scalar() if isinstance(source_count, DataFrame) else F.lit(source_count).cast("bigint")
    out = target.agg(F.count(F.lit(1)).alias("target_rows")).withColumn("source_rows", before)
    if keys:
        absent = join_to_one(source.select(*keys), target.select(*keys).distinct(), keys, "left_anti")
        out = out.withColumn("missing_keys", absent.agg(F.count(F.lit(1)).alias("n")).scalar())
    else:
        out = out.withColumn("missing_keys", F.lit(0).cast("bigint"))
    verified = (F.col("target_rows") >= F.col("source_rows")) & (F.col("missing_keys") == 0)
    return out.select("source_rows", "target_rows", "missing_keys", verified.alias("verified"))


def rebuild(
    spark: SparkSession, root: str, convert: Callable[[DataFrame], DataFrame], keys: Sequence[str] = (), label: str = "rebuild"
) -> DataFrame:
    """Copy a published table to a new shape, verify the copy, then switch the pointer.

    The old version stays readable throughout; a copy that fails verification is never published. A
    finished copy of the same ``label`` is not repeated. Returns the verification row, which is kept
    with the marker of a finished copy.

    With ``keys`` (unique, and kept by ``convert``, which then must work row by row), versions that others
    publish while the copy runs are caught up with: what they changed since the version copied is
    converted, replaces its rows of the copy, and the keys that are gone leave it. This is repeated
    until nothing new was published. A copy lies beside the versions until it is whole, and becomes the first free
    one then, so that it never meets a writer's. Without keys a version published meanwhile fails the rebuild.
    """
    done = f"{root}/DONE-{label}"
    version = snapshots.current_version(spark, root)
    if version is None:
        raise ValueError(f"no published version under {root}")
    marker = snapshots.read_text(spark, done)
    if marker is not None:
        verified = json.loads(marker)
        verified = verified if isinstance(verified, dict) else {"version": verified}  # a marker without its row
        copied = verified.pop("version")
        if copied > version:
            # The copy was verified, but the run stopped before the switch.
            snapshots.publish(spark, root, copied)
        if not verified:
            target = spark.read.parquet(snapshots.version_path(root, copied))
            return verify_copy(target.count(), target)
        return spark.createDataFrame([tuple(verified.values())], REPORT)
    source = spark.read.parquet(snapshots.version_path(root, version))
    beside = f"{root}/copy-{label}-{uuid.uuid4().hex}"
    target, copies = _copy(spark, convert(source), f"{beside}/0"), 1
    while (latest := snapshots.current_version(spark, root)) != version:
        if not keys:
            raise CopyMismatch(f"version {latest} was published while version {version} was copied, and there are no keys to catch up by")
        now = spark.read.parquet(snapshots.version_path(root, latest))
        changed, gone = row_changes(source, now, keys)
        changed, gone = stored(changed, "changed"), stored(gone, "gone")
        kept = target.join(changed.select(*keys).unionByName(gone), list(keys), "left_anti")
        target, copies = _copy(spark, kept.unionByName(convert(changed)), f"{beside}/{copies}"), copies + 1
        version, source = latest, now
    report = verify_copy(source.count(), target, source, keys)
    row = report.first()
    if not row["verified"]:
        snapshots.remove(spark, beside)
        raise CopyMismatch(f"copied {row['target_rows']} of {row['source_rows']} rows, {row['missing_keys']} keys missing")
    copied = version + 1
    while snapshots.exists(spark, snapshots.version_path(root, copied)):
        copied += 1
    snapshots.move(spark, f"{beside}/{copies - 1}", snapshots.version_path(root, copied))
    snapshots.remove(spark, beside)
    snapshots.write_text(spark, done, json.dumps({"version": copied, **row.asDict()}))
    snapshots.publish(spark, root, copied)
    return spark.createDataFrame([tuple(row)], REPORT)


def _copy(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def seed(base: DataFrame, rows: DataFrame, keys: Sequence[str], order: str | None = None) -> WriteResult:
    """Merge reference rows in on every run; a second run changes nothing.

    ``order`` says which row of a repeated key is last; without it a repeated key fails the run.
    """
    if order is not None:
        numbered = dense_index(rows, [order, *keys], name="row_index").drop(order)
    else:
        numbered = one_of_each(rows, keys).withColumn("row_index", F.monotonically_increasing_id())
    # Rows and result are written, so that a task holds the sorts of one merge and not those of all runs before it.
    done = bulk_load(base, stored(numbered, "numbered"), keys, "UPDATE")
    return WriteResult(stored(done.snapshot, "seeded"), done.outcome)
