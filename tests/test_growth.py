"""Steps whose work grew faster than their input: how often they move or meet their rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T
from recordlake.operators import load, postings
from recordlake.plans import rebuild as plans
from recordlake.session import work_path
from recordlake.sources.ranged import RangedTable


def jobs_of(spark, name, run) -> int:
    """Jobs that Spark runs for a call; each exchange of an adaptive plan is one."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_index_build_moves_entries_once(spark, no_broadcast):
    vectors = spark.range(500).select(
        F.col("id").alias("rid"), F.array(*[F.concat(F.lit("t"), F.col("id") % m) for m in (2, 3, 5, 7)]).alias("tokens"),
        F.array(*[F.lit(w) for w in (1.0, 2.0, 3.0, 4.0)]).alias("weights"))
    # Vectors, the counts of the classes in two, the entries' exchange, the blocks, the type of ids.
    assert jobs_of(spark, "sparse", lambda: postings.SparseIndex.build(vectors, work_path(spark, "sparse"), range_rows=50)) <= 6


def numbers(spark, of, value):
    return spark.createDataFrame([(i, k, value) for i, k in enumerate(of)], "row_index long, k int, v string")


def test_large_batches_meet_the_stored_keys_at_once(spark, monkeypatch):
    table = RangedTable(spark, work_path(spark, "ranged"), ["k"], T.StructType.fromDDL("k int, v string"), rows_per_file=5)
    made = table.create(numbers(spark, range(1000), "old").drop("row_index"))
    files = sorted((r["least"]["k"], r["greatest"]["k"], r["rows"]) for r in table.files().collect())
    # More files than tasks: they still follow each other and none is larger than asked for.
    assert made.added == len(files) >= 200 and all(a[1] < b[0] for a, b in zip(files, files[1:])) and max(f[2] for f in files) <= 5
    assert {r["file"] for r in table.holding(numbers(spark, [7, 5000], "").select("k")).collect()} == {
        r["file"] for r in table.files().where("least.k <= 7 AND greatest.k >= 7").collect()}

    def unwanted(*_):
        raise AssertionError("every key was placed and looked up in a filter")

    monkeypatch.setattr(RangedTable, "_located", unwanted)
    outcome, done = load.ranged_load(table, numbers(spark, [*range(400), *range(2000, 2050)], "new"))
    assert done.rewritten == sum(f[0] < 400 for f in files)
    assert outcome.where("status = 'updated'").count() == 400 and outcome.where("status = 'inserted'").count() == 50
    assert {r["k"]: r["v"] for r in table.read().collect()} == {
        k: "new" if k < 400 or k >= 2000 else "old" for k in [*range(1000), *range(2000, 2050)]}


def test_seeds_do_not_pile_up(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    rows = spark.createDataFrame([(2, "new"), (3, None)], "k int, v string")
    once = plans.seed(base, rows, ["k"]).snapshot
    twice = plans.seed(once, rows, ["k"]).snapshot
    for made in (once, twice):
        assert sorted((r["k"], r["v"]) for r in made.collect()) == [(1, "a"), (2, "new"), (3, None)]
        assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
