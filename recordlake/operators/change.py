"""Snapshot differences and their application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.operators.update import WriteResult, update_partial
from recordlake.session import stored


def comparable(column: Column, data_type: T.DataType) -> Column:
    """A form ``<=>`` accepts: maps as sorted entries, VARIANT as its JSON text."""
    if isinstance(data_type, T.MapType):
        entries = F.map_entries(column)
        if isinstance(data_type.valueType, T.VariantType):
            entries = F.transform(entries, lambda e: F.struct(e["key"], F.to_json(e["value"])))
        return F.array_sort(entries)
    if isinstance(data_type, T.VariantType):
        return F.to_json(column)
    return column


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: ``changed`` column names and the new values of every shared non-key column.

    A value that appeared counts; one that became null does not, nor does a column the new side
    lacks. Keys without a change, and keys on one side only, give no row. Keys are unique per side.
    """
    shared = [f for f in new.schema.fields if f.name in old.columns and f.name not in keys]
    before = old.select(*keys, *[F.col(f.name).alias(f"_old_{f.name}") for f in shared])
    after = new.select(*keys, *[F.col(f.name) for f in shared])

    def differs(f: T.StructField) -> Column:
        now = comparable(F.col(f.name), f.dataType)
        was = comparable(F.col(f"_old_{f.name}"), f.dataType)
        return F.col(f.name).isNotNull() & ~now.eqNullSafe(was)

    changed = F.array_compact(F.array(*[F.when(differs(f), F.lit(f.name)) for f in shared]))
    return (
        after.join(before, list(keys))
        .withColumn("changed", changed)
        .where(F.size("changed") > 0)
        .select(*keys, "changed", *[f.name for f in shared])
    )


#: Buckets that keys are digested in, and rows that a bucket is meant to have.
BUCKETS, BUCKET_ROWS = 1 << 20, 1000


def _digested(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """Count and order-free digests of the rows of each key bucket, in one scan without a row exchanged."""
    row = F.struct(*[comparable(F.col(f"`{c}`"), df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate((*keys, *columns))])
    # Nulls do not enter a hash of columns: the JSON text tells them from other values.
    one = F.xxhash64(F.to_json(row, {"ignoreNullFields": "false"}))
    two = F.xxhash64(one, F.lit(7))
    return df.select(_bucket(keys, buckets), one.alias("one"), two.alias("two")).groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("one").alias("x"), F.sum(F.col("two").cast("decimal(38,0)")).alias("s"))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")


def differing(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in key buckets whose digests differ; every key that differs is among them.

    Both sides are digested where they lie. A bucket comes back as two numbers and a count, and only the
    rows of buckets that differ are given: they follow the changed share, not the tables.
    """
    if buckets is None:
        buckets = max(256, min(BUCKETS, new.count() // BUCKET_ROWS))
    sides = [_digested(df, keys, columns, buckets) for df in (old, new)]
    both = sides[0].withColumnsRenamed({c: f"_{c}" for c in ("n", "x", "s")}).join(sides[1], "_bucket", "full")
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("x").eqNullSafe(F.col("_x")) & F.col("s").eqNullSafe(F.col("_s"))
    apart = stored(both.where(~same).select("_bucket"), "apart")  # at most ``BUCKETS`` numbers
    old_rows, new_rows = (df.withColumn("_bucket", _bucket(keys, buckets)).join(F.broadcast(apart), "_bucket", "left_semi").drop("_bucket") for df in (old, new))
    return old_rows, new_rows


def digest_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``snapshot_diff`` that joins only the key buckets whose digests differ."""
    shared = [f.name for f in new.schema.fields if f.name in old.columns and f.name not in keys]
    before, after = differing(old.select(*keys, *shared), new.select(*keys, *shared), keys, shared, buckets)
    return snapshot_diff(before, after, keys)


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """What a table became: its rows that are new or other than before, and the keys that are gone."""
    columns = [c for c in new.columns if c not in keys]
    before, after = differing(old.select(*new.columns), new, keys, columns, buckets)
    one = F.struct(*[comparable(F.col(f"`{c}`"), new.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(columns)]) if columns else F.lit(True)
    was = before.select(*keys, one.alias("_was"), F.lit(True).alias("_there"))
    changed = after.join(was, list(keys), "left").where(F.col("_there").isNull() | ~one.eqNullSafe(F.col("_was"))).select(*new.columns)
    return changed, before.select(*keys).join(after.select(*keys), list(keys), "left_anti")


def changed_params(diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The difference as a name-to-value map (dynamic values) holding the changed columns only."""
    names = [c for c in diff.columns if c not in keys and c != "changed"]
    pairs = [x for c in names for x in (F.lit(c), _as_variant(diff, c))]
    params = F.map_filter(F.create_map(*pairs), lambda k, v: F.array_contains("changed", k))
    return diff.select(*keys, params.alias("params"))


def _as_variant(df: DataFrame, name: str) -> Column:
    nested = isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType))
    return F.to_variant_object(F.col(name)) if nested else F.col(name).cast("variant")


def apply_changes(old: DataFrame, diff: DataFrame, keys: Sequence[str]) -> WriteResult:
    """Write a difference onto the old snapshot: every reportable change is reproduced."""
    if len(keys) == 1:
        return update_partial(old, diff, keys[0], present="changed")
    packed = F.struct(*keys)
    result = update_partial(
        old.withColumn("_key", packed), diff.withColumn("_key", packed).drop(*keys), "_key", present="changed"
    )
    return WriteResult(result.snapshot.drop("_key"), result.outcome)
