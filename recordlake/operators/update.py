"""Update algebra over a snapshot: assignments, removals, replacement, and writes by rid."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.predicates import Where
from recordlake.operators.skew import join_to_one


@dataclass
class WriteResult:
    """The new snapshot and one outcome row per incoming row (or per touched row)."""

    snapshot: DataFrame
    outcome: DataFrame


class Set:
    """Immutable list of assignments. A later assignment to a column replaces an earlier one."""

    def __init__(self, steps: tuple[tuple[str, Column], ...] = (), appends: tuple[tuple[str, tuple], ...] = ()):
        self._steps = steps
        self._appends = appends

    def _add(self, name: str, value: Column) -> "Set":
        return Set((*self._steps, (name, value)), self._appends)

    def set(self, name: str, value) -> "Set":
        return self._add(name, value if isinstance(value, Column) else F.lit(value))

    def set_opt(self, name: str, value) -> "Set":
        """None leaves the column alone; a column value does so row by row."""
        if value is None:
            return self
        if isinstance(value, Column):
            return self._add(name, F.coalesce(value, F.col(name)))
        return self.set(name, value)

    def set_when(self, flag: bool, name: str, value) -> "Set":
        return self.set(name, value) if flag else self

    def set_raw(self, name: str, expression: str, **values) -> "Set":
        """A caller expression with named values, written ``:name``.

        One pass: names are whole words outside quoted text, and a value is never looked into again.
        """

        def put(found: re.Match) -> str:
            key = found.group("name")
            return _sql_literal(values[key]) if key in values else found.group()

        return self._add(name, F.expr(_QUOTED_OR_NAME.sub(put, expression)))

    def set_expr(self, name: str, expression: str) -> "Set":
        return self._add(name, F.expr(expression))

    def set_or_null(self, name: str, value) -> "Set":
        """None clears the column."""
        return self._add(name, F.lit(None)) if value is None else self.set(name, value)

    def append(self, name: str, value) -> "Set":
        """Add to the end of a list; a null list counts as empty; repeated appends merge."""
        merged = dict(self._appends)
        merged[name] = (*merged.get(name, ()), value)
        return Set(self._steps, tuple(merged.items()))

    def append_if_absent(self, name: str, value) -> "Set":
        item = value if isinstance(value, Column) else F.lit(value)
        present = F.coalesce(F.array_contains(F.col(name), item), F.lit(False))
        grown = F.when(F.col(name).isNull(), F.array(item)).otherwise(F.array_append(F.col(name), item))
        return self._add(name, F.when(present, F.col(name)).otherwise(grown))

    def remove(self, name: str) -> "Set":
        return self._add(name, F.lit(None))

    def remove_item(self, name: str, value) -> "Set":
        return self._add(name, F.array_remove(F.col(name), value))

    def apply_if(self, value, step: Callable[["Set", object], "Set"]) -> "Set":
        return self if value is None else step(self, value)

    def is_empty(self) -> bool:
        return not self._steps and not self._appends

    def assignments(self) -> dict[str, Column]:
        out = dict(self._steps)
        for name, values in self._appends:
            if name in out:
                raise ValueError(f"column {name} is both set and appended to")
            items = F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])
            out[name] = F.when(F.col(name).isNull(), items).otherwise(F.concat(F.col(name), items))
        return out


# Quoted text, which is left alone, or a named value.
_QUOTED_OR_NAME = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|(?<!:):(?P<name>[A-Za-z_]\w*)")


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def update_where(base: DataFrame, where: Where, sets: Set, returning: str | None = None):
    """Apply ``sets`` to matching rows in one scan. All assignments see the old row.

    ``returning``: None gives the new snapshot; ``before``/``after`` the matched rows' old or new
    image; ``count`` one row with the number of matched rows.
    """
    changes = sets.assignments()
    if returning == "count":
        return where.apply(base).agg(F.count(F.lit(1)).alias("affected"))
    if returning == "before":
        return where.apply(base)
    types = {f.name: f.dataType for f in base.schema.fields}

    def image(touched: Column | None) -> list[Column]:
        out = []
        for c in base.columns:
            if c not in changes:
                out.append(F.col(c))
                continue
            value = changes[c].cast(types[c])
            out.append((value if touched is None else F.when(touched, value).otherwise(F.col(c))).alias(c))
        for c in changes:
            if c not in types:
                value = changes[c]
                out.append((value if touched is None else F.when(touched, value)).alias(c))
        return out

    if returning == "after":
        return where.apply(base).select(*image(None))
    if returning is not None:
        raise ValueError(f"unknown return form {returning!r}")
    frame, test, _ = where.flagged(base)
    return frame.select(*image(F.coalesce(test, F.lit(False))))


def upsert_where(base: DataFrame, key: dict, sets: Set) -> DataFrame:
    """Update the rows equal on ``key``; where there is none, insert one row of key plus sets."""
    if not key:
        raise ValueError("an upsert needs a key")
    where = Where()
    for name, value in key.items():
        where = where.eq(name, value)
    updated = update_where(base, where, sets)
    matched = base.where(where.column()).agg(F.count(F.lit(1)).alias("n")).scalar()
    blank = base.sparkSession.range(1)
    types = {f.name: f.dataType for f in base.schema.fields}
    row = blank.select(*[F.lit(key.get(c)).cast(types[c]).alias(c) for c in base.columns])
    fresh = update_where(row, Where(), sets).where(matched == 0)
    return updated.unionByName(fresh, allowMissingColumns=True)


def delete_where(base: DataFrame, where: Where) -> WriteResult:
    """Drop matching rows; rows where the test is unknown stay. A predicate is required."""
    if where.is_empty():
        raise ValueError("delete_where needs a predicate")
    frame, test, extra = where.flagged(base)
    outcome = where.apply(base).agg(F.count(F.lit(1)).alias("deleted"))
    return WriteResult(frame.where(~F.coalesce(test, F.lit(False))).drop(*extra).select(*base.columns), outcome)


def delete_by_rid(base: DataFrame, rids: DataFrame, rid: str = "rid") -> WriteResult:
    """Delete by id; one outcome row per asked id, ``deleted`` false where there was none."""
    wanted = rids.select(rid).distinct()
    snapshot = join_to_one(base, wanted, [rid], "left_anti")
    present = base.select(rid).withColumn("_hit", F.lit(True))
    outcome = join_to_one(rids.select(rid), present, [rid], "left").select(
        rid, F.coalesce("_hit", F.lit(False)).alias("deleted")
    )
    return WriteResult(snapshot, outcome)


def update_partial(
    base: DataFrame, patches: DataFrame, rid: str = "rid", present: str | None = None, order: str | None = None
) -> WriteResult:
    """Overwrite only the given properties of rows found by id.

    ``present`` names an array column listing the properties each patch row gives (so a listed null
    clears); without it a non-null value counts as given. Patches of one id are applied in ``order``;
    without an order column a repeated id fails the write, and so does a null order. An unknown id
    changes nothing and reports ``updated`` false.
    """
    given = [c for c in patches.columns if c not in (rid, present, order)]
    if order is None:
        single = one_of_each(patches, [rid])
    else:
        def listed(c: str) -> Column:
            return F.array_contains(present, c) if present else F.col(c).isNotNull()

        # The aggregate skips rows without the property: the last row that gives it.
        last = [F.max_by(F.struct(F.col(c)), F.when(listed(c), _place(order)))[c].alias(c) for c in given]
        both = [F.array_distinct(F.flatten(F.collect_set(present))).alias(present)] if present else []
        single = patches.groupBy(rid).agg(*last, *both)
    new = single.select(
        rid,
        *[F.col(c).alias(f"_new_{c}") for c in given],
        *([F.col(present).alias("_given")] if present else []),
        F.lit(True).alias("_patched"),
    )
    joined = base.join(new, [rid], "left")

    def pick(c: str) -> Column:
        if c not in given:
            return F.col(c)
        if present:
            listed = F.coalesce(F.array_contains("_given", c), F.lit(False))
            return F.when(listed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        return F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c)

    snapshot = joined.select(*[pick(c) for c in base.columns])
    known = base.select(rid).withColumn("_hit", F.lit(True))
    placed = F.lit(True) if order is None else _place(order).isNotNull()
    outcome = patches.select(rid, placed.alias("_placed")).join(known, [rid], "left").select(
        rid, (F.col("_placed") & F.coalesce("_hit", F.lit(False))).alias("updated")
    )
    return WriteResult(snapshot, outcome)


def _place(order: str) -> Column:
    """The order column; a null, which has no place among the rows of its key, fails at run time."""
    return F.when(F.col(order).isNull(), F.raise_error(F.lit(f"an incoming row has no {order}"))).otherwise(F.col(order))


def one_of_each(rows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the last by ``order``; without it a repeated key fails at run time, as does a null order."""
    rest = [c for c in rows.columns if c not in (*keys, order)]
    packed = F.struct(*[F.col(c) for c in rest])
    if order is not None:
        return rows.groupBy(*keys).agg(F.max_by(packed, _place(order)).alias("_row")).select(*keys, "_row.*")
    text = F.concat(F.lit("more than one incoming row for "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
    single = rows.groupBy(*keys).agg(F.any_value(packed).alias("_row"), F.count(F.lit(1)).alias("_n"))
    checked = F.when(F.col("_n") > 1, F.raise_error(text)).otherwise(F.col("_row"))
    return single.select(*keys, checked.alias("_row")).select(*keys, "_row.*")


def replace_content(base: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Whole-record replacement: matched rows take every non-key column from the incoming row.

    Of several incoming rows of a key the last by ``order`` counts; without an order they fail, as does a null order.
    """
    incoming = one_of_each(incoming, keys, order)
    rest = [c for c in base.columns if c not in keys]
    new = incoming.select(
        *keys, F.struct(*[F.col(c) if c in incoming.columns else F.lit(None).alias(c) for c in rest]).alias("_new")
    )
    return base.join(new, list(keys), "left").select(
        *[F.col(c) if c in keys else F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
          for c in base.columns]
    )


def merge_maps(old: Column, new: Column) -> Column:
    """Top-level merge of two property maps; the new side wins, keys it lacks are kept."""
    empty = F.map_filter(F.coalesce(old, new), lambda k, v: F.lit(False))
    left, right = F.coalesce(old, empty), F.coalesce(new, empty)
    return F.map_concat(F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k)), right)


def merge_record(base: DataFrame, incoming: DataFrame, keys: Sequence[str], column: str = "properties") -> DataFrame:
    """Merge an incoming property map into matched rows; a key with two incoming maps fails."""
    incoming = one_of_each(incoming.select(*keys, column), keys)
    new = incoming.select(*keys, F.col(column).alias("_new"))
    return base.join(new, list(keys), "left").withColumn(
        column, F.when(F.col("_new").isNull(), F.col(column)).otherwise(merge_maps(F.col(column), F.col("_new")))
    ).drop("_new")


def write_returning(result: DataFrame, strict: bool = False) -> DataFrame:
    """The stored row a write gave back; the strict form fails when there is none."""
    from recordlake.operators.read import fetch_one

    return fetch_one(result, strict=strict)
