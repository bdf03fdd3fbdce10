"""Reads in key order that touch only the ranges they need: counted ranges instead of a global sort.

The bounds of a range come from a bounded sample of the keys, its size from a count; narrowing a range down
repeats both inside it. So the rows around any place of the order are found by a few counting scans of the
key columns, which Parquet's statistics narrow as well, and only they are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.operators.ordering import dense_index

#: Ranges that a range is cut into, keys sampled for each, and rows that need no further cut.
PARTS = 32
SAMPLED = 40
MOST = 200_000

Bound = tuple[str | None, ...]


@dataclass(frozen=True)
class By:
    """A sort column. Nulls come first when ascending and last when descending, as in Spark."""

    name: str
    descending: bool = False

    @property
    def column(self) -> Column:
        return F.col(f"`{self.name}`")

    @property
    def order(self) -> Column:
        return self.column.desc_nulls_last() if self.descending else self.column.asc_nulls_first()


class Ordered:
    """A frame in an order. Rows that are equal in it stand in the order of a hash of the whole row, unless
    the order is said to be ``unique``."""

    def __init__(self, df: DataFrame, order: Sequence[str | By], unique: bool = False):
        self.columns = df.columns
        by = [By(o) if isinstance(o, str) else o for o in order]
        if not unique:
            tie = "_tie"
            while tie in df.columns:
                tie += "_"
            df = df.withColumn(tie, F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
            by.append(By(tie))
        self.df, self.by = df, by
        self.types = [df.schema[b.name].dataType for b in by]

    # Bounds travel as text: what a type prints is read back as the same value.
    def _value(self, i: int, text: str) -> Column:
        return F.lit(text).cast(self.types[i])

    def after(self, bound: Bound) -> Column:
        """Whether a row stands at a bound or after it."""
        test = F.lit(True)
        for i in reversed(range(len(self.by))):
            k, text = self.by[i].column, bound[i]
            if text is None:
                beyond = F.lit(False) if self.by[i].descending else k.isNotNull()
                equal = k.isNull()
            else:
                v = self._value(i, text)
                beyond = F.coalesce(k < v, F.lit(True)) if self.by[i].descending else F.coalesce(k > v, F.lit(False))
                equal = F.coalesce(k == v, F.lit(False))
            test = beyond | (equal & test)
        return test

    def between(self, low: Bound | None, high: Bound | None) -> DataFrame:
        """The rows from ``low`` to before ``high``. The plain test of the first column reaches the scan."""
        rows, k, down = self.df, self.by[0].column, self.by[0].descending
        if low is not None:
            if low[0] is not None:
                v = self._value(0, low[0])
                rows = rows.where((k <= v) | k.isNull() if down else k >= v)
            rows = rows.where(self.after(low))
        if high is not None:
            if high[0] is not None:
                v = self._value(0, high[0])
                rows = rows.where(k >= v if down else (k <= v) | k.isNull())
            rows = rows.where(~self.after(high))
        return rows

    def cut(self, low: Bound | None, high: Bound | None, n: int, parts: int) -> list[Bound]:
        """Inner bounds of a range of ``n`` rows, from a sample of its keys."""
        share = min(1.0, SAMPLED * parts / max(n, 1))
        keys = self.between(low, high).select(*[b.column for b in self.by])
        keys = (keys if share == 1.0 else keys.sample(share, 17)).orderBy(*[b.order for b in self.by]).limit(4 * SAMPLED * parts)
        rows = [tuple(r) for r in keys.select(*[b.column.cast("string") for b in self.by]).collect()]
        picked = [rows[i * len(rows) // parts] for i in range(1, parts)] if rows else []
        return [b for b in dict.fromkeys(picked) if b != low and (not rows or b != rows[0])]

    def counts(self, low: Bound | None, high: Bound | None, bounds: Sequence[Bound]) -> list[int]:
        """Rows of each of the ranges that the bounds make of one."""
        number = reduce(Column.__add__, [self.after(b).cast("int") for b in bounds], F.lit(0))
        found = {r["r"]: r["n"] for r in self.between(low, high).groupBy(number.alias("r")).agg(F.count(F.lit(1)).alias("n")).collect()}
        return [found.get(i, 0) for i in range(len(bounds) + 1)]

    def sorted(self, low: Bound | None, high: Bound | None) -> DataFrame:
        return self.between(low, high).orderBy(*[b.order for b in self.by])

    def numbered(self, low: Bound | None, high: Bound | None, start: int, name: str) -> DataFrame:
        """The rows of a range with their numbers in the whole order, sorted and written once."""
        return dense_index(self.between(low, high), [b.order for b in self.by], name=name, start=start).select(*self.columns, name)


def rows_at(df: DataFrame, order: Sequence[str | By], skip: int, limit: int, unique: bool = False, most: int = MOST) -> DataFrame:
    """``limit`` rows after the first ``skip`` in an order, of which only a range of about ``most`` rows is sorted."""
    rows, low, high, before = Ordered(df, order, unique), None, None, 0
    n = df.count()
    while n > max(most, 2 * limit):
        bounds = rows.cut(low, high, n, PARTS)
        sizes = rows.counts(low, high, bounds)
        edges: list[Bound | None] = [low, *bounds, high]
        first, at = 0, before
        while first < len(sizes) - 1 and at + sizes[first] <= skip:
            at += sizes[first]
            first += 1
        last, end = first, at + sizes[first]
        while last < len(sizes) - 1 and end < skip + limit:
            last += 1
            end += sizes[last]
        if end - at > 0.9 * n:
            break
        low, high, before, n = edges[first], edges[last + 1], at, end - at
    if limit <= most and skip - before <= most:
        return rows.sorted(low, high).offset(skip - before).limit(limit).select(*rows.columns)
    name = "_at" if "_at" not in df.columns else "_at_"
    numbered = rows.numbered(low, high, before, name)
    return numbered.where(F.col(name).between(skip, skip + limit - 1)).drop(name)


def counted(rows: Ordered, target: int) -> Iterator[tuple[Bound | None, Bound | None, int]]:
    """Consecutive ranges (low, high, rows) of about ``target`` rows; a range is only cut when it is reached."""

    def walk(low: Bound | None, high: Bound | None, n: int) -> Iterator[tuple[Bound | None, Bound | None, int]]:
        if n <= 2 * target:
            yield low, high, n
            return
        bounds = rows.cut(low, high, n, min(PARTS, -(-n // target)))
        if not bounds:
            yield low, high, n
            return
        edges = [low, *bounds, high]
        for (a, b), size in zip(zip(edges, edges[1:]), rows.counts(low, high, bounds)):
            if size:
                yield from walk(a, b, size)

    total = rows.df.count()
    if total:
        yield from walk(None, None, total)
