"""Bulk load against a row-by-row model."""

import random

import pytest
from pyspark.sql import functions as F

from recordlake.model import FieldSpec, RecordSpec
from recordlake.operators import change, load

SCHEMA = "k1 int, k2 string, a int, b string"


def model(base, rows, mode, update_cols=()):
    """Rows one by one: (snapshot, statuses)."""
    store = {(r[0], r[1]): list(r) for r in base}
    statuses = {}
    for i, row in rows:
        key = (row[0], row[1])
        if None in key:
            statuses[i] = "failed"
        elif key not in store:
            store[key] = list(row)
            statuses[i] = "inserted"
        elif mode == "UPDATE":
            for pos, name in ((2, "a"), (3, "b")):
                if row[pos] is not None and (not update_cols or name in update_cols):
                    store[key][pos] = row[pos]
            statuses[i] = "updated"
        else:
            statuses[i] = "ignored" if mode == "IGNORE" else "failed"
    if mode == "ABORT" and any(s == "failed" for s in statuses.values()):
        return [tuple(r) for r in base], {i: "failed" for i in statuses}
    return [tuple(r) for r in store.values()], statuses


def data(seed):
    rnd = random.Random(seed)
    base = [(k, "x", rnd.choice([None, k]), f"b{k}") for k in range(20)]
    rows = []
    for i in range(200):
        # One key holds a third of the batch; a few keys are null.
        k1 = 3 if rnd.random() < 0.34 else rnd.choice([None, *range(40)])
        rows.append((i, (k1, rnd.choice(["x", "x", "y", None]), rnd.choice([None, rnd.randrange(100)]), rnd.choice([None, f"v{i}"]))))
    return base, rows


def text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("mode,cols", [("IGNORE", ()), ("UPDATE", ()), ("UPDATE", ("a",)), ("ERROR", ()), ("ABORT", ())])
@pytest.mark.parametrize("joins", ["small", "large"])
def test_load_equals_the_model(spark, request, mode, cols, joins):
    if joins == "large":
        request.getfixturevalue("no_broadcast")
    base, rows = data(5)
    inc = spark.createDataFrame([(i, *r) for i, r in rows], "row_index bigint, " + SCHEMA).repartition(8)
    result = load.bulk_load(spark.createDataFrame(base, SCHEMA), inc, ["k1", "k2"], mode, cols)
    want, statuses = model(base, rows, mode, cols)
    assert {r["row_index"]: r["status"] for r in result.outcome.collect()} == statuses
    assert text(tuple(r) for r in result.snapshot.collect()) == text(want)
    t = load.tallies(result.outcome).first()
    assert t["received"] == t["inserted"] + t["updated"] + t["ignored"] + t["failed"] == len(rows)


def test_insert_is_rerunnable(spark):
    base, rows = data(6)
    inc = spark.createDataFrame([(i, *r) for i, r in rows], "row_index bigint, " + SCHEMA)
    first = load.bulk_load(spark.createDataFrame(base, SCHEMA), inc, ["k1", "k2"], "IGNORE").snapshot
    again = load.bulk_load(first, inc, ["k1", "k2"], "IGNORE")
    assert load.tallies(again.outcome).first()["inserted"] == 0
    assert text(map(tuple, again.snapshot.collect())) == text(map(tuple, first.collect()))


def test_keys_are_required(spark):
    df = spark.createDataFrame([(0, 1, "x", 1, "b")], "row_index bigint, " + SCHEMA)
    with pytest.raises(ValueError):
        load.bulk_load(df, df, [], "IGNORE")
    with pytest.raises(ValueError):
        load.load_records(df, df, RecordSpec("r", (FieldSpec("a"),)))


def test_outcome_codes(spark):
    base = spark.createDataFrame([(1, "x", 1, "b")], SCHEMA)
    inc = spark.createDataFrame([(0, 1, "x", 5, "n"), (1, None, "x", 5, "n"), (2, 2, "x", 5, "n")], "row_index bigint, " + SCHEMA)
    out = {r["row_index"]: (r["status"], r["code"], r["field"]) for r in load.bulk_load(base, inc, ["k1", "k2"]).outcome.collect()}
    assert out == {0: ("failed", "duplicate_key", "k1,k2"), 1: ("failed", "null_key", "k1"), 2: ("inserted", None, None)}


def test_created_rids_continue(spark):
    empty = spark.createDataFrame([], "rid string, k int")
    first = load.create_records(empty, spark.range(100).select(F.col("id").cast("int").alias("k")), ["k"], buckets=4)
    stored = first.snapshot.select("rid", "k")
    second = load.create_records(stored, spark.range(100, 200).select(F.col("id").cast("int").alias("k")), ["k"], buckets=4)
    rids = [r["rid"] for r in second.snapshot.collect()]
    assert len(rids) == len(set(rids)) == 200


def test_diff_round_trip(spark):
    schema = "id int, s string, n int, m map<string,int>"
    old = spark.createDataFrame([(1, "a", 1, {"x": 1, "y": 2}), (2, "b", None, None), (3, "c", 3, {}), (4, "d", 4, None)], schema)
    new = spark.createDataFrame([(1, "a", 1, {"y": 2, "x": 1}), (2, "b", 5, None), (3, None, 3, {"z": 1}), (5, "n", 1, None)], schema)
    diff = change.snapshot_diff(old, new, ["id"])
    found = {r["id"]: r["changed"] for r in diff.collect()}
    assert found == {2: ["n"], 3: ["m"]}
    applied = {r["id"]: r for r in change.apply_changes(old, diff, ["id"]).snapshot.collect()}
    assert applied[2]["n"] == 5 and applied[3]["s"] == "c" and applied[3]["m"] == {"z": 1}
    assert change.snapshot_diff(spark.createDataFrame(list(applied.values()), schema), new, ["id"]).count() == 0


def test_a_small_batch_moves_no_stored_row(spark):
    """Stored rows are only filtered and joined where they are read."""
    base = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    batch = spark.sql("SELECT * FROM VALUES (0L, 1L, 'a'), (1L, 9999L, 'b') AS t(row_index, k, v)")
    result = load.bulk_load(base, batch, ["k"], "UPDATE")
    plan = result.snapshot._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert result.snapshot.count() == 5001 and result.snapshot.where("v <> 'x'").count() == 2
