"""Rollups, digests, catch-up and numbering: what is merged, joined and moved, and that results stay the same."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recordlake.model import TimeseriesSpec
from recordlake.operators import change, load, timeseries
from recordlake.operators.ordering import number_in_groups
from recordlake.plans import rebuild as plans
from recordlake.session import work_path
from recordlake.sources import snapshots


def test_rollups_take_late_samples(spark):
    rng = random.Random(5)
    spec = TimeseriesSpec("ts", ("tag",), ("v", "w"))
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 20_000)), rng.choice("ab"), rng.choice([None, round(rng.random(), 3)]), None) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, tag string, v double, w double")
    minutes = timeseries.Rollup(spark, work_path(spark, "minutes"), spec, "1 MINUTES", ["id"], df, rows_per_file=40)
    minutes.add(df.where("id >= 100"))
    done = minutes.add(df.where("id < 100 and ts < timestamp'2024-01-01 01:00:00'"))
    assert done.kept > 0  # hours without a late sample keep their files
    minutes.add(df.where("id < 100 and ts >= timestamp'2024-01-01 01:00:00'"))
    for width in ("1 MINUTES", "1 HOURS"):
        want = timeseries.ts_downsample(df, spec, width, ["id"])
        got = minutes.read(None if width == "1 MINUTES" else width)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("buckets", [None, 4, 4096])
def test_digests_find_every_change(spark, buckets):
    rng = random.Random(6)
    old = {i: (rng.choice([None, 1, 2]), rng.choice([None, "", "x"]), {"a": 1, "b": None}) for i in range(3000)}
    new = dict(old)
    for i in rng.sample(range(3000), 40):
        new[i] = rng.choice([(None, "", {"a": 1, "b": None}), (1, None, {"b": None, "a": 1}), (1, "1", {}), (2, "x", {"a": 2})])
    for i in rng.sample(range(3000), 5):
        new.pop(i, None)
    new[5000] = (1, "n", None)
    schema = "k int, v int, s string, m map<string,int>"
    a, b = (spark.createDataFrame([(k, *v) for k, v in rows.items()], schema) for rows in (old, new))
    text = lambda df: sorted(map(str, df.collect()))
    assert text(change.digest_diff(a, b, ["k"], buckets)) == text(change.snapshot_diff(a, b, ["k"]))
    changed, gone = change.row_changes(a, b, ["k"], buckets)
    assert {r["k"] for r in changed.collect()} == {k for k, v in new.items() if old.get(k) != v}
    assert {r["k"] for r in gone.collect()} == set(old) - set(new)
    assert change.row_changes(a, a, ["k"], buckets)[0].count() == 0
    if buckets == 4096:
        moved = change.differing(a, b, ["k"], ["v", "s", "m"], buckets)
        assert 0 < moved[1].count() < 150


def test_rebuild_catches_up_twice(spark):
    root, state, calls = work_path(spark, "t"), {i: "a" for i in range(20)}, []
    frame = lambda: spark.createDataFrame(sorted(state.items()), "k int, v string")
    snapshots.commit(frame(), root)

    def convert(df):
        calls.append(df.count())
        if len(calls) <= 2:  # a writer goes on while the copy and the first catch-up run
            state.pop(len(calls))
            state[100 + len(calls)] = "new"
            state[10] = f"b{len(calls)}"
            snapshots.commit(frame(), root)
        return df.withColumn("v", F.upper("v"))

    report = plans.rebuild(spark, root, convert, ["k"]).first()
    assert {r["k"]: r["v"] for r in snapshots.read_current(spark, root).collect()} == {k: v.upper() for k, v in state.items()}
    assert report["verified"] and report["source_rows"] == 20 and calls == [20, 2, 2]


def test_rebuild_without_keys_does_not_lose_writes(spark):
    root = work_path(spark, "t")
    snapshots.commit(spark.range(5), root)

    def convert(df):
        snapshots.commit(spark.range(6), root)
        return df

    with pytest.raises(plans.CopyMismatch, match="no keys"):
        plans.rebuild(spark, root, convert)
    assert snapshots.read_current(spark, root).count() == 6


def test_numbers_without_an_exchange(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("g", F.pmod("id", F.lit(3)))
    numbered = number_in_groups(df, ["g"], "n", 10)
    for g in range(3):
        mine = [r["n"] for r in numbered.where(F.col("g") == g).select("n").collect()]
        assert sorted(mine) == list(range(10, 10 + len(mine))) and len(mine) >= 333
    seen = spark.createDataFrame([], "x int").sparkSession.range(3)
    assert load.assign_rids(seen, ["id"], 2).select("rid").distinct().count() == 3
