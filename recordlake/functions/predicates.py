"""Predicate builder: every pushed test is AND-joined; an empty builder filters nothing.

Nulls follow SQL: a test on a null column (or null collection) is unknown, so the row is dropped,
for ``not_in`` and ``not_contains_any`` too. A null among the values of a list makes every miss
unknown: ``in_list`` still finds its matches, ``not_in`` lets no row through. Lists follow this rule
at any length, and as a Python list or a table alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.operators.skew import join_to_one

def like_pattern(pattern: str) -> str:
    """A ``%``/``?`` pattern as a Spark LIKE pattern (where ``_`` is the one-character wildcard)."""
    return pattern.replace("\\", "\\\\").replace("_", "\\_").replace("?", "_")


def _col(column: str | Column) -> Column:
    return column if isinstance(column, Column) else F.col(f"`{column}`" if "." not in column else column)


class Where:
    """Immutable builder; ``column()`` gives the predicate, ``apply(df)`` the filtered frame."""

    def __init__(self, tests: tuple[Column, ...] = (), lists: tuple[tuple[str, DataFrame, bool], ...] = ()):
        self._tests = tests
        self._lists = lists

    def _push(self, test: Column) -> "Where":
        return Where((*self._tests, test), self._lists)

    # comparisons
    def eq(self, c, v) -> "Where":
        return self._push(_col(c) == v)

    def ne(self, c, v) -> "Where":
        return self._push(_col(c) != v)

    def lt(self, c, v) -> "Where":
        return self._push(_col(c) < v)

    def lte(self, c, v) -> "Where":
        return self._push(_col(c) <= v)

    def gt(self, c, v) -> "Where":
        return self._push(_col(c) > v)

    def gte(self, c, v) -> "Where":
        return self._push(_col(c) >= v)

    def between(self, c, low, high) -> "Where":
        return self._push(_col(c).between(low, high))

    def is_null(self, c) -> "Where":
        return self._push(_col(c).isNull())

    def is_not_null(self, c) -> "Where":
        return self._push(_col(c).isNotNull())

    # membership
    def in_list(self, c: str, values: Iterable | DataFrame) -> "Where":
        return self._membership(c, values, True)

    def not_in(self, c: str, values: Iterable | DataFrame) -> "Where":
        return self._membership(c, values, False)

    def _membership(self, c, values, wanted: bool) -> "Where":
        if isinstance(values, DataFrame):
            return Where(self._tests, (*self._lists, (c, values, wanted)))
        values = list(values)
        if not values:
            return self._push(F.lit(False) if wanted else _col(c).isNotNull())
        test = _col(c).isin(values)
        return self._push(test if wanted else ~test)

    # collections
    def contains(self, c, v) -> "Where":
        """One equal element; a list on the right is looked for as one nested element."""
        return self._push(F.array_contains(_col(c), _literal(v)))

    def contains_all(self, c, values: Iterable) -> "Where":
        tests = [F.array_contains(_col(c), F.lit(v)) for v in values]
        return self._push(reduce(Column.__and__, tests, _col(c).isNotNull()))

    def contains_any(self, c, values: Iterable) -> "Where":
        return self._push(F.arrays_overlap(_col(c), _literal(list(values))))

    def not_contains_any(self, c, values: Iterable) -> "Where":
        return self._push(~F.arrays_overlap(_col(c), _literal(list(values))))

    # text
    def like(self, c, pattern: str) -> "Where":
        return self._push(_col(c).like(like_pattern(pattern)))

    def ilike(self, c, pattern: str) -> "Where":
        return self._push(_col(c).ilike(like_pattern(pattern)))

    # composition
    def filter(self, expression: str | Column) -> "Where":
        return self._push(expression if isinstance(expression, Column) else F.expr(expression))

    def filter_when(self, flag: bool, expression: str | Column) -> "Where":
        return self.filter(expression) if flag else self

    def apply_if(self, value, step: Callable[["Where", object], "Where"]) -> "Where":
        return self if value is None else step(self, value)

    def is_empty(self) -> bool:
        return not self._tests and not self._lists

    def column(self) -> Column:
        if self._lists:
            raise ValueError("a filter against a table of values is a join: use apply(df) or flagged(df)")
        return reduce(Column.__and__, self._tests, F.lit(True)) if self._tests else F.lit(True)

    def flagged(self, df: DataFrame) -> tuple[DataFrame, Column, list[str]]:
        """The frame joined to the tables of values, the predicate over it, and the columns to drop.

        For callers that keep the rows that fail, such as updates and deletes.
        """
        test, extra = reduce(Column.__and__, self._tests, F.lit(True)), []
        for i, (column, values, wanted) in enumerate(self._lists):
            name = f"_listed_{i}"
            keys, has_null = _list_of(values, column)
            df = join_to_one(df, keys.withColumn(name, F.lit(True)), [column], "left")
            inside = F.when(_col(column).isNull(), F.lit(None)).when(F.col(name), F.lit(True)).when(has_null, F.lit(None)).otherwise(F.lit(False))
            test, extra = test & (inside if wanted else ~inside), [*extra, name]
        return df, test, extra

    def apply(self, df: DataFrame) -> DataFrame:
        out = df.where(reduce(Column.__and__, self._tests)) if self._tests else df
        for column, values, wanted in self._lists:
            keys, has_null = _list_of(values, column)
            # A null column value matches nothing; for the negative form it is unknown, so dropped.
            probe = out.where(_col(column).isNotNull())
            out = join_to_one(probe if wanted else probe.where(~has_null), keys, [column], "left_semi" if wanted else "left_anti")
        return out


def _list_of(values: DataFrame, column: str) -> tuple[DataFrame, Column]:
    """Distinct values under the column's name, and whether a null is among them (a scalar)."""
    source = F.col(f"`{values.columns[0]}`")
    has_null = values.agg(F.coalesce(F.max(source.isNull()), F.lit(False)).alias("n")).scalar()
    return values.select(source.alias(column)).where(F.col(column).isNotNull()).distinct(), has_null


def _literal(value) -> Column:
    if isinstance(value, (list, tuple, set)):
        return F.array(*[_literal(v) for v in value])
    return F.lit(value)
