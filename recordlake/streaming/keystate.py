"""The keyed state kept between micro-batches of a command stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.operators.keystate import final_state, kv_replay
from recordlake.operators.read import latest_row
from recordlake.operators.skew import join_to_one
from recordlake.session import stored
from recordlake.sources import snapshots


STATE = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("state_kind", T.StringType()),
    T.StructField("state_value", T.StringType()), T.StructField("state_expiry", T.LongType())])


def state_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The latest state of every key that earlier micro-batches left; a key without a kind is gone."""
    if not snapshots.exists(spark, f"{root}/state"):
        return spark.createDataFrame([], STATE)
    rows = spark.read.schema(T.StructType([*STATE.fields, T.StructField("batch", T.LongType())])).parquet(f"{root}/state")
    return latest_row(rows.where(F.col("batch") < batch_id), ["key"], "batch").drop("batch").where("state_kind IS NOT NULL")


def apply_commands(batch: DataFrame, root: str, batch_id: int) -> None:
    """Replay one micro-batch on the state before it. Only the keys it ran on are written, to the batch's own
    folder, which a retry overwrites."""
    spark = batch.sparkSession
    fixed = stored(batch, "commands")
    before = join_to_one(state_before(spark, root, batch_id), fixed.select("key").distinct(), ["key"], "left_semi")
    replayed = stored(kv_replay(fixed, before), "replayed")
    replayed.write.mode("overwrite").parquet(f"{root}/results/batch={batch_id}")
    ran = replayed.where("key IS NOT NULL AND (code IS NULL OR code NOT IN ('malformed', 'batch_rejected'))").select("key").distinct()
    ran.join(final_state(replayed), "key", "left").select(*STATE.names).write.mode("overwrite").parquet(f"{root}/state/batch={batch_id}")


def stream_commands(commands: DataFrame, root: str):
    """Run a command stream until its available input is used up; returns the query."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_commands(batch, root, batch_id)

    return commands.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def read_results(spark, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/results").drop("batch")
