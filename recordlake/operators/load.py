"""Bulk load: conflict modes, merge on key, per-row outcomes and tallies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.links import link_text, make_link
from recordlake.functions.predicates import Where
from recordlake.model import RecordSpec
from recordlake.operators.ordering import number_in_groups
from recordlake.operators.skew import join_to_one
from recordlake.operators.update import WriteResult
from recordlake.session import stored
from recordlake.sources.ranged import Merged, RangedTable

MODES = ("ERROR", "IGNORE", "UPDATE", "ABORT")
OUTCOME = ("row_index", "status", "code", "field", "message")


def bulk_load(
    base: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    mode: str = "ERROR",
    update_cols: Sequence[str] = (),
    validate_only: bool = False,
    row_index: str = "row_index",
) -> WriteResult:
    """Load ``incoming`` into ``base`` on ``keys``, as if its rows came one by one.

    ``row_index`` is unique and gives the order. Repeats inside the batch follow that order: the
    first row of a new key inserts, later ones meet an existing record. Per mode, a row that meets
    one is ``ignored``, ``updated``, or ``failed`` (ERROR: it alone; ABORT: the whole batch fails and
    the snapshot is unchanged). A null in a key column fails the row (``null_key``). UPDATE writes
    ``update_cols``, or every non-key column when none are listed, and a null incoming value keeps
    the stored one.

    Keys are summarised before anything is joined, so a key repeated many times reaches the join
    once. Stored keys are cut down to those the batch meets before they are brought together, and
    stored rows meet the collapsed batch in a left join: a batch under the broadcast threshold moves no
    stored row.
    """
    if not keys:
        raise ValueError("bulk load needs at least one key column")
    if mode not in MODES:
        raise ValueError(f"unknown conflict mode {mode!r}")
    keys = list(keys)
    data = [c for c in incoming.columns if c != row_index]
    missing = [k for k in keys if k not in data or k not in base.columns]
    if missing:
        raise ValueError(f"key columns not present on both sides: {missing}")
    asked = incoming.where(~_has_null(keys)).select(*keys).distinct()
    known = base.select(*keys).join(asked, keys, "left_semi").distinct().withColumn("_stored", F.lit(True))
    marked = _mark_rows(incoming, known, keys, row_index)
    if mode == "ABORT":  # read by the count of conflicts, by the rows and by the outcome
        marked = stored(marked, "marked")
    outcome = _outcome(marked, keys, mode, row_index)
    if validate_only:
        return WriteResult(base, outcome)
    if mode == "UPDATE":
        return WriteResult(_merge(base, known, incoming, keys, list(update_cols), row_index), outcome)
    fresh = marked.where(F.col("_fresh")).select(*data)
    if mode == "ABORT":
        conflicts = marked.where(~F.col("_fresh")).agg(F.count(F.lit(1)).alias("n")).scalar()
        fresh = fresh.where(conflicts == 0)
    return WriteResult(base.unionByName(_conform(fresh, base)), outcome)


def _has_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _mark_rows(incoming: DataFrame, known: DataFrame, keys: list[str], row_index: str) -> DataFrame:
    """Every incoming row with ``_fresh``: true when it is the one that creates its key."""
    firsts = incoming.where(~_has_null(keys)).groupBy(*keys).agg(F.min(row_index).alias("_first"))
    state = firsts.join(known, keys, "left")
    return join_to_one(incoming, state, keys, "left").withColumn(
        "_fresh", F.coalesce(F.col("_stored").isNull() & (F.col(row_index) == F.col("_first")), F.lit(False))
    )


def _outcome(marked: DataFrame, keys: list[str], mode: str, row_index: str) -> DataFrame:
    null_field = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    key_text = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    is_null = null_field.isNotNull()
    met = {"ERROR": "failed", "IGNORE": "ignored", "UPDATE": "updated", "ABORT": "failed"}[mode]
    status = F.when(is_null, F.lit("failed")).when(F.col("_fresh"), F.lit("inserted")).otherwise(F.lit(met))
    code = F.when(is_null, F.lit("null_key"))
    if met == "failed":
        code = code.when(~F.col("_fresh"), F.lit("duplicate_key"))
    if mode == "ABORT":
        conflicts = marked.where(~F.col("_fresh")).agg(F.count(F.lit(1)).alias("n")).scalar()
        status = F.when(conflicts > 0, F.lit("failed")).otherwise(status)
        code = code.when(conflicts > 0, F.lit("aborted"))
    field = F.when(is_null, null_field).when(code == "duplicate_key", F.lit(",".join(keys)))
    message = (
        F.when(code == "null_key", F.concat(F.lit("key column is null: "), field))
        .when(code == "duplicate_key", F.concat(F.lit("key already present: "), key_text))
        .when(code == "aborted", F.lit("batch rejected"))
    )
    return marked.select(
        F.col(row_index).alias("row_index"), status.alias("status"), code.alias("code"),
        field.alias("field"), message.alias("message"),
    )


def _merge(base: DataFrame, known: DataFrame, incoming: DataFrame, keys: list[str], listed: list[str], row_index: str) -> DataFrame:
    """Stored rows with the collapsed incoming row of their key, and the collapsed rows of new keys."""
    given, written, batch = _collapse(incoming, keys, listed, row_index)
    changed = base.join(batch, keys, "left").select(
        *[F.coalesce(F.col(f"_new_{f.name}").cast(f.dataType), F.col(f.name)).alias(f.name) if f.name in written else F.col(f.name)
          for f in base.schema.fields])
    fresh = batch.join(known, keys, "left_anti")
    return changed.unionByName(_conform(fresh.withColumnsRenamed({f"_new_{c}": c for c in given}), base))


def _collapse(incoming: DataFrame, keys: list[str], listed: list[str], row_index: str) -> tuple[list[str], list[str], DataFrame]:
    """The batch's non-key columns, those it writes, and one row per key with column ``c`` as ``_new_c``."""
    given = [c for c in incoming.columns if c not in keys and c != row_index]
    written = listed or given
    unknown = [c for c in written if c not in given]
    if unknown:
        raise ValueError(f"update columns not in the batch: {unknown}")
    order = F.col(row_index)

    def collapsed(c: str) -> Column:
        if c not in written:
            # Only the row that creates the key supplies the columns outside the update list.
            return F.min_by(F.struct(F.col(c)), order)[c].alias(f"_new_{c}")
        # The aggregate skips rows whose ordering is null: the last non-null value per column.
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"_new_{c}")

    if not given:
        return given, written, incoming.where(~_has_null(keys)).select(*keys).distinct()
    return given, written, incoming.where(~_has_null(keys)).groupBy(*keys).agg(*[collapsed(c) for c in given])


def _conform(rows: DataFrame, base: DataFrame) -> DataFrame:
    return rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in base.schema.fields]
    )


def load_records(base: DataFrame, incoming: DataFrame, spec: RecordSpec, mode: str = "UPDATE", **options) -> WriteResult:
    """Bulk load keyed by the record class; a class without key columns is refused up front."""
    if not spec.key_columns:
        raise ValueError(f"record class {spec.name} declares no key columns")
    return bulk_load(base, incoming, spec.key_columns, mode, **options)


def ranged_load(target: RangedTable, incoming: DataFrame, mode: str = "UPDATE", update_cols: Sequence[str] = (), row_index: str = "row_index") -> tuple[DataFrame, Merged]:
    """``bulk_load`` into a stored table in key order: the outcome, and what was written.

    Only files that hold a key of the batch are read whole and written anew; the others keep their names,
    whatever the size of the batch. New rows become files of their own. The rules are those of ``bulk_load``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown conflict mode {mode!r}")
    keys = list(target.keys)
    data = [c for c in incoming.columns if c != row_index]
    asked = incoming.where(~_has_null(keys)).select(*keys).distinct()
    hits = target.holding(asked)
    marked = stored(_mark_rows(incoming, hits.select(*keys).distinct().withColumn("_stored", F.lit(True)), keys, row_index), "marked")
    outcome = stored(_outcome(marked, keys, mode, row_index), "outcome")
    if mode == "UPDATE":
        given, written, batch = _collapse(incoming, keys, list(update_cols), row_index)
        names = [c for c in target.schema.names if c in written]
        done = target.merge(batch, {c: F.coalesce(F.col(f"_new._new_{c}"), F.col(f"`{c}`")) for c in names}, {c: F.col(f"_new_{c}") for c in given}, hits)
        return outcome, done
    fresh = marked.where("_fresh").select(*data)
    if mode == "ABORT" and not marked.where("NOT _fresh").isEmpty():
        fresh = fresh.limit(0)
    return outcome, target.merge(fresh, {}, None, hits)


def tallies(outcome: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Received, inserted, updated, ignored and failed, overall or per group."""

    def count_of(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, F.lit(1))).alias(status)

    frame = outcome.groupBy(*by) if by else outcome.groupBy()
    return frame.agg(
        F.count(F.lit(1)).alias("received"), *[count_of(s) for s in ("inserted", "updated", "ignored", "failed")]
    )


def insert_select(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Append a projection of another table; columns it lacks are null."""
    return base.unionByName(_conform(rows, base))


def move_records(source: DataFrame, target: DataFrame, where: Where, converts: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Drain matching rows of one type into another, converting columns on the way."""
    frame, test, extra = where.flagged(source)
    moved = where.apply(source).select(
        *[converts[c].alias(c) if c in converts else F.col(c) for c in source.columns],
        *[e.alias(c) for c, e in converts.items() if c not in source.columns],
    )
    stay = frame.where(~F.coalesce(test, F.lit(False))).drop(*extra).select(*source.columns)
    return stay, target.unionByName(_conform(moved, target))


def assign_rids(
    rows: DataFrame, keys: Sequence[str], buckets: int, next_pos: dict[int, int] | None = None, rid: str = "rid"
) -> DataFrame:
    """Give each row a link: bucket by key hash, position dense inside the bucket. Rows are numbered where they lie.

    ``next_pos`` holds the first free position per bucket (at most ``buckets`` entries).
    """
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    numbered = number_in_groups(placed, ["_bucket"], "_pos")
    start = F.lit(0)
    for bucket, pos in sorted((next_pos or {}).items()):
        start = F.when(F.col("_bucket") == bucket, F.lit(pos)).otherwise(start)
    link = make_link(F.col("_bucket"), F.col("_pos") + start)
    return numbered.withColumn(rid, link_text(link)).drop("_bucket", "_pos")


def create_records(base: DataFrame, incoming: DataFrame, keys: Sequence[str], buckets: int = 8) -> WriteResult:
    """Insert rows and hand out rids that continue after the stored ones."""
    taken = (
        base.where(F.col("rid").isNotNull())
        .select(F.regexp_extract("rid", r"^#(\d+):", 1).cast("int").alias("b"),
                F.regexp_extract("rid", r":(\d+)$", 1).cast("bigint").alias("p"))
        .where(F.col("b") < buckets)
        .groupBy("b").agg(F.max("p").alias("p"))
    )
    next_pos = {r["b"]: r["p"] + 1 for r in taken.collect()}  # at most one row per bucket
    created = assign_rids(incoming, keys, buckets, next_pos)
    outcome = created.select(*keys, "rid", F.lit("inserted").alias("status"))
    return WriteResult(base.unionByName(created, allowMissingColumns=True), outcome)
