"""Tables in key order: what a merge leaves, writes anew and adds, and that rows are those of a plain merge."""

import random

import pytest
from pyspark.sql import functions as F

from recordlake.operators import graph, load
from recordlake.session import work_path
from recordlake.sources import ranged
from recordlake.sources.ranged import RangedTable


def plain(rows, batch):
    """UPDATE, one row after the other; a null keeps what is stored."""
    for k, s, v in batch:
        old = rows.get((k, s))
        rows[k, s] = v if v is not None or old is None else old


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_merges_touch_only_their_files(spark, broadcast):
    before_conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rng = random.Random(7)
        rows = {(k, s): k for k in range(0, 3000, 3) for s in ("a", "é")}
        schema = "k int, s string, v int"
        base = spark.createDataFrame([(k, s, v) for (k, s), v in rows.items()], schema)
        table = RangedTable(spark, work_path(spark, "ranged"), ["k", "s"], base.schema, rows_per_file=100)
        assert table.create(base).added == 20
        for low in (100, 2900, -50):
            batch = [(rng.randrange(low, low + 200), rng.choice("aéz"), rng.choice([None, *range(9)])) for _ in range(150)]
            frame = spark.createDataFrame([(i, *r) for i, r in enumerate(batch)], "row_index long, k int, s string, v int")
            names = {r["file"] for r in table.files().collect()}
            held = {r["file"] for r in table.holding(frame.select("k", "s").distinct()).collect()}
            outcome, done = load.ranged_load(table, frame)
            after = {r["file"] for r in table.files().collect()}
            # Only files that hold a key of the batch are gone; a fold of small runs may take more of the added ones.
            first_run = {r["file"] for r in table.files().where("run = 0").collect()}
            assert done.rewritten == len(held) < 8 and len(names & after & first_run) >= 20 - len(held)
            known = set(rows)
            plain(rows, batch)
            assert {(r["k"], r["s"]): r["v"] for r in table.read().collect()} == rows and table.read().count() == len(rows)
            seen = set(known)
            want = {}
            for i, (k, s, _) in enumerate(batch):
                want[i] = "updated" if (k, s) in seen else "inserted"
                seen.add((k, s))
            assert {r["row_index"]: r["status"] for r in outcome.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before_conf)


def test_modes_and_edges(spark):
    schema = "k int, v string"
    rows = spark.createDataFrame([(i, "old") for i in range(10)], schema)
    batch = spark.createDataFrame([(0, 3, "new"), (1, 20, "new"), (2, None, "x"), (3, 20, "again")], "row_index long, k int, v string")

    def fresh():
        table = RangedTable(spark, work_path(spark, "ranged"), ["k"], rows.schema, rows_per_file=4)
        table.create(rows)
        return table

    def of(mode):
        table = fresh()
        outcome, done = load.ranged_load(table, batch, mode)
        return {r["k"]: r["v"] for r in table.read().collect()}, [r["status"] for r in outcome.orderBy("row_index").collect()], done

    old = dict.fromkeys(range(10), "old")
    assert of("IGNORE")[:2] == (old | {20: "new"}, ["ignored", "inserted", "failed", "ignored"])
    assert of("ERROR")[:2] == (old | {20: "new"}, ["failed", "inserted", "failed", "failed"])
    assert of("ABORT")[:2] == (old, ["failed"] * 4)
    rows_, status, done = of("UPDATE")
    assert (rows_, status) == (old | {3: "new", 20: "again"}, ["updated", "inserted", "failed", "updated"]) and done.rewritten == 1 and done.kept == 2
    empty = RangedTable(spark, work_path(spark, "ranged"), ["k"], rows.schema)
    assert empty.read().count() == 0
    load.ranged_load(empty, batch.limit(0))
    assert empty.read().count() == 0
    load.ranged_load(empty, batch)
    assert {r["k"]: r["v"] for r in empty.read().collect()} == {3: "new", 20: "again"}


def test_runs_fold(spark):
    schema = "k int, v int"
    table = RangedTable(spark, work_path(spark, "ranged"), ["k"], spark.createDataFrame([], schema).schema, rows_per_file=50)
    table.create(spark.createDataFrame([(i * 10, 0) for i in range(400)], schema))
    for n in range(5):
        table.merge(spark.createDataFrame([(i * 10 + n + 1, n) for i in range(20)], schema), {"v": F.col("_new.v")})
    runs = [r["run"] for r in table.files().select("run").distinct().collect()]
    assert len(runs) <= 3 and table.read().count() == 500 == table.read().select("k").distinct().count()


def test_filters_keep_all_and_drop_most(spark):
    base = spark.range(0, 40_000, 2).withColumn("v", F.lit(1))
    table = RangedTable(spark, work_path(spark, "ranged"), ["id"], base.schema, rows_per_file=5000)
    table.create(base)
    manifest = table.files()
    asked = spark.range(0, 20_000)
    kept = table._filtered(table._located(asked, manifest), manifest)
    odd = kept.where("id % 2 = 1").count()
    assert kept.where("id % 2 = 0").count() == 10_000 and odd < 1000
    assert table.holding(asked).count() == 10_000


def test_stored_edges(spark):
    edges = RangedTable(spark, work_path(spark, "edges"), ["out", "in"], spark.createDataFrame([], "out string, in string, w int").schema)
    edges.create(spark.createDataFrame([("a", "b", 1), ("b", "c", None)], "out string, in string, w int"))
    incoming = spark.createDataFrame([(0, "a", "b", None), (1, "c", "a", 3), (2, "b", "c", 2)], "row_index long, out string, in string, w int")
    graph.upsert_stored_edges(edges, incoming)
    assert {tuple(r) for r in edges.read().collect()} == {("a", "b", 1), ("b", "c", 2), ("c", "a", 3)}


def test_has_bit(spark):
    got = spark.range(0, 70000, 7).selectExpr("bitmap_bit_position(id) AS at", "bitmap_bucket_number(id) AS b").groupBy("b").agg(
        F.expr("bitmap_construct_agg(at)").alias("bits"))
    asked = spark.range(0, 70000).selectExpr("id", "bitmap_bit_position(id) AS at", "bitmap_bucket_number(id) AS b").join(got, "b")
    assert asked.where(ranged.has_bit(F.col("bits"), F.col("at")) != (F.col("id") % 7 == 0)).count() == 0
