"""Registered queries on tables whose keys are larger than those of the smallest copy."""

import __spark_entry__ as entry
import pytest
from parity import compare, duck
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """Events of users past 16 and 17 bits; the other tables as they are."""
    folder = str(tmp_path_factory.mktemp("large"))
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    events.withColumn("user_id", F.col("user_id") + F.when(F.col("event_id") % 2 == 0, 65_000).otherwise(200_000)).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.fixture(scope="module")
def con(large):
    con = duck(FOLDER)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{large}/events.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", ["d1_decode_bad", "d1_decode_good", "x5_stream_decode"])
def test_users_past_16_bits(spark, large, con, name):
    assert compare(spark, con, large, entry.queries()[name], entry.oracle_sql()[name]) is None
