"""Hard negatives against scores of all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import negatives

SCHEMA = "vec_id long, label int, vector array<double>, score double, rank string"


def by_hand(rows, is_anchor, low=30, high=90):
    live = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, label, x in {(i, label, tuple(v)) for i, label, v in live if is_anchor(i)}:
        scored = sorted((-sum(p * q for p, q in zip(x, v)), i, other) for i, other, v in live if len(v) == len(x))
        for s, p, _ in [r for r in scored if r[2] == label and r[1] != a][:5]:
            ranked = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:10]
            out += [(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(ranked, 1)]
    return sorted(out)


def vectors(seed, n=300, d=6, labels=3):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(labels), [rng.gauss(0, 0.3) for _ in range(d)]) for i in range(n)]
    rows += [(n + i, rng.randrange(labels), [rng.choice([0.0, 0.25, -0.25]) for _ in range(d)]) for i in range(60)]  # many ties
    return rows + [
        (None, 1, [0.1] * d), (1000, None, [0.1] * d), (1001, 1, None), (1002, 1, [0.1] * (d - 1) + [None]), (1003, 1, [float("nan")] + [0.1] * (d - 1)),
        (1004, 2, [float("inf")] + [0.1] * (d - 1)), (1010, 1, []), (1011, 1, []), (1012, 2, []), (1020, 0, [0.5] * (d + 2)), (1021, 0, [0.5] * (d + 2)),
        (1022, 1, [0.3] * (d + 2)), (1030, 0, [0.0] * d), (10, 1, [0.2] * d), (20, *rows[20][1:]), (20, *rows[20][1:]), (2, *rows[2][1:])]


@pytest.mark.parametrize("options", [{}, {"block_rows": 40}, {"block_rows": 7, "pass_bytes": 20_000}])
def test_mine(spark, options):
    given = vectors(len(options))
    frame = spark.createDataFrame([(*r, 0.5, "x") for r in given], SCHEMA).repartition(3)
    rows = negatives.whole_numbers(frame, 256)
    got = negatives.mine(rows, F.col("vec_id") % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = by_hand(given, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 500


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    given = [(i, i % 2, [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(10, 22) for _ in range(4)]) for i in range(60)]
    rows = negatives.whole_numbers(spark.createDataFrame([(*r, 0.5, "x") for r in given], SCHEMA), 256)
    assert sorted(tuple(r) for r in negatives.mine(rows, F.col("vec_id") % 10 == 0).collect()) == by_hand(given, lambda i: i % 10 == 0)


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(negatives.whole_numbers(none, 256), F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(10, 1, [0.5], 0.5, "x")], SCHEMA)
    assert negatives.mine(negatives.whole_numbers(one, 256), F.col("vec_id") % 10 == 0).count() == 0


def test_search_stops_early_and_strictly():
    """A skewed block is left early; a tie at the threshold is still looked at."""
    rng = np.random.default_rng(3)
    v = np.zeros((4000, 8))
    v[:40] = rng.integers(50, 90, (40, 8))
    v[40:] = rng.integers(0, 20, (3960, 8))
    block = negatives.Block(np.arange(4000), np.zeros(4000), v)
    anchor = np.array([3, 1, 2, 5, 1, 1, 4, 2.0])
    kept = negatives.Kept(10)
    seen = block.search(anchor, np.ones(4000, bool), [kept])
    scores = v @ anchor
    want = sorted(zip(-scores, range(4000)))[:10]
    assert [(-s, i) for s, i in zip(kept.scores, kept.ids)] == want and seen < 2000
    same = negatives.Block(np.arange(100)[::-1].copy(), np.zeros(100), np.ones((100, 2)))
    kept = negatives.Kept(3)
    same.search(np.array([1.0, 1.0]), np.ones(100, bool), [kept])
    assert kept.ids == [0, 1, 2]
