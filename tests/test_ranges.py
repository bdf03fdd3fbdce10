"""Counted ranges against a sorted list: any place, any direction, nulls, ties, and how much is read."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordlake.operators import ranges, read
from recordlake.operators.ranges import By

SCHEMA = "id int, k int, s string, d double, t timestamp, m decimal(9,2)"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(i, rng.choice([None, *range(9)]), rng.choice([None, "a", "B", "é", ""]), rng.choice([None, rng.random(), 1e-9, -1e12]),
             rng.choice([None, dt.datetime(2020, 1, 1, 2, 3, 4, 567891) + dt.timedelta(hours=rng.randint(0, 50))]),
             rng.choice([None, Decimal(rng.randint(-500, 500)) / 100])) for i in range(1500)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("order", [["id"], [By("k", True), "id"], ["s", By("d", True), "id"], [By("t"), By("m", True), By("id", True)]])
def test_any_place(frame, order):
    by = [o if isinstance(o, By) else By(o) for o in order]
    want = [r["id"] for r in frame.orderBy(*[b.order for b in by]).collect()]
    for skip, limit in ((0, 5), (7, 40), (750, 3), (1490, 30), (2000, 5)):
        got = [r["id"] for r in ranges.rows_at(frame, order, skip, limit, unique=True, most=60).collect()]
        assert got == want[skip:skip + limit]
    big = ranges.rows_at(frame, order, 400, 500, unique=True, most=60)
    assert sorted(r["id"] for r in big.collect()) == sorted(want[400:900])


def test_only_a_range_is_sorted(frame):
    """Half the way down of 1500 rows, the sort sees about as many rows as asked for."""
    seen = []
    whole = ranges.Ordered.sorted
    try:
        def watched(self, low, high):
            seen.append(self.between(low, high).count())
            return whole(self, low, high)

        ranges.Ordered.sorted = watched
        assert ranges.rows_at(frame, ["id"], 750, 10, unique=True, most=60).count() == 10
    finally:
        ranges.Ordered.sorted = whole
    assert seen and seen[0] <= 60


def test_ties_are_whole(spark):
    same = spark.range(3000).select((F.col("id") % 2).alias("k"), F.lit("x").alias("v"))
    at = read.order_limit(same, ["k"], 10, skip=1495)
    assert [r["k"] for r in at.collect()] == [0] * 5 + [1] * 5
    pages = [p.collect() for p in read.iterate_pages(same, "k", 700, rows_per_range=300)]
    assert [len(p) for p in pages] == [700] * 4 + [200]
    assert [sorted({r["k"] for r in p}) for p in pages] == [[0], [0], [0, 1], [1], [1]]


def test_pages_over_ranges(frame, rows):
    pages = [[r["id"] for r in p.collect()] for p in read.iterate_pages(frame, "k", 130, rows_per_range=200)]
    assert [len(p) for p in pages] == [130] * 11 + [70]
    assert sorted(i for p in pages for i in p) == list(range(1500))
    k = {r[0]: -1 if r[1] is None else r[1] for r in rows}
    for a, b in zip(pages, pages[1:]):
        assert max(k[i] for i in a) <= min(k[i] for i in b)
    assert list(read.iterate_pages(frame.where("id < 0"), "k", 10)) == []


def test_a_stop_reads_the_first_range_only(frame, monkeypatch):
    read_rows = []
    whole = ranges.Ordered.numbered

    def watched(self, low, high, start, name):
        out = whole(self, low, high, start, name)
        read_rows.append(out.count())
        return out

    monkeypatch.setattr(ranges.Ordered, "numbered", watched)
    taken, summary = read.consume_batches(frame, ["id"], 50, F.max("id") >= 0, unique=True, rows_per_range=100)
    assert sorted(r["id"] for r in taken.collect()) == list(range(50)) and tuple(summary.first()) == (1, 50, 50, False, True)
    assert len(read_rows) == 1 and read_rows[0] <= 200
    taken, summary = read.consume_batches(frame, ["id"], 70, F.max("id") >= 500, unique=True, rows_per_range=100)
    assert sorted(r["id"] for r in taken.collect()) == list(range(560)) and tuple(summary.first()) == (8, 560, 560, False, True)
    _, summary = read.consume_batches(frame, ["id"], 400, F.max("id") > 5000, unique=True, rows_per_range=100)
    assert tuple(summary.first()) == (4, 1500, 1500, True, False)
