"""Skew-safe joins and dense numbering, on data where one key holds a large share."""

import pytest
from pyspark.sql import functions as F

from recordlake.operators import skew
from recordlake.operators.ordering import dense_index


@pytest.fixture
def sides(spark):
    many = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(7)).when(F.col("id") < 1400, F.lit(None)).otherwise(F.col("id") % 50).cast("bigint").alias("k"), "id")
    one = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return many, one


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [[(7,)], [(7,), (None,)], []])
def test_salted_join_equals_plain_join(sides, how, hot):
    many, one = sides
    plain = sorted(many.join(one, ["k"], how).select(many.columns).collect(), key=lambda r: r["id"])
    salted = skew.join_to_one(many, one, ["k"], how, salts=5, hot=hot)
    assert sorted(salted.select(many.columns).collect(), key=lambda r: r["id"]) == plain


def test_salt_spreads_equal_rows(spark, sides):
    """A hot key joins on several tasks."""
    many, one = sides
    joined = skew.join_to_one(many.repartition(8).select("k"), one, ["k"], "inner", salts=16, hot=[(7,)])
    plan = joined._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_hot_keys_found(spark):
    many = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    assert (1,) in skew.hot_keys(many, ["k"])
    assert len(skew.hot_keys(many, ["k"])) <= skew.MAX_HOT_KEYS


def test_no_job_runs_while_a_join_is_planned(spark, no_broadcast):
    many = spark.range(120_000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000).alias("k"), "id")
    one = spark.range(900).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    group = "planning-a-join"
    spark.sparkContext.setJobGroup(group, group)
    out = skew.join_to_one(many, one, ["k"], "left")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.count() == 120_000
    assert out.where("v IS NOT NULL").count() == many.where("k < 900").count()


def test_dense_index_is_contiguous(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("x"))
    rows = dense_index(df, ["x"]).collect()
    assert sorted((r["x"], r["row_no"]) for r in rows) == [(i, i) for i in range(5000)]


def test_dense_index_per_group_with_a_hot_group(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id") % 5).alias("g"), "id")
    rows = dense_index(df, ["id"], ["g"], start=1).collect()
    by_group = {}
    for r in rows:
        by_group.setdefault(r["g"], []).append((r["id"], r["row_no"]))
    for members in by_group.values():
        assert [n for _, n in sorted(members)] == list(range(1, len(members) + 1))


def test_dense_index_spreads_a_hot_group(spark):
    df = spark.range(4000).select(F.lit(0).alias("g"), "id")
    placed = dense_index(df, ["id"], ["g"])
    assert placed.select(F.spark_partition_id().alias("p")).distinct().count() > 1
