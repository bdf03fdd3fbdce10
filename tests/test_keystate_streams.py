"""Keyed state against a sequential model; chunked ingest, streamed reads, rebuilds."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recordlake.model import FieldSpec, RecordSpec, Scalar, TimeseriesSpec
from recordlake.operators import keystate
from recordlake.plans import rebuild as plans
from recordlake.session import work_path
from recordlake.sources import snapshots
from recordlake.sources.tables import read_records
from recordlake.streaming import ingest, reads
from recordlake.streaming import keystate as streamed

START = dt.datetime(2024, 1, 1)
LOG = "key string, ts timestamp, seq bigint, command string, value string, ttl bigint"


def log_rows(seed, n=1500):
    rnd = random.Random(seed)
    rows, now = [], 0
    for seq in range(n):
        now += rnd.choice([0, 0, 1, 5, 40])
        # One key takes half of the commands.
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(12)}"
        command = rnd.choice(["SET", "GET", "GET", "GETDEL", "EXISTS", "EXISTS", "INCR", "INCR", "INCR"])
        if key == "hot" and command in ("SET", "GETDEL") and rnd.random() < 0.97:
            command = "INCR"  # long runs without a command that fixes the state
        ttl = rnd.choice([None, 0, 10, 100]) if command == "SET" else None
        rows.append((key, START + dt.timedelta(seconds=now), seq, command, f"v{seq}" if command == "SET" else None, ttl))
    return rows


def sequential(rows):
    state, out = {}, {}
    for key, ts, seq, command, value, ttl in rows:
        now = int((ts - dt.datetime(1970, 1, 1)).total_seconds())
        state[key], result, code = keystate.step(state.get(key), command, value, ttl, now)
        out[seq] = (result, code)
    return out, {k: s for k, s in state.items() if s}


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_replay_equals_the_sequential_run(spark, seed):
    rows = log_rows(seed)
    replayed = keystate.kv_replay(spark.createDataFrame(rows, LOG))
    want, states = sequential(rows)
    assert {r["seq"]: (r["result"], r["code"]) for r in replayed.collect()} == want
    final = {r["key"]: r["state_value"] for r in keystate.final_state(replayed).collect()}
    assert final == {k: str(s[1]) for k, s in states.items()}


def test_the_hot_key_is_spread(spark):
    rows = [("hot", START + dt.timedelta(seconds=i), i, "INCR", None, None) for i in range(2000)]
    replayed = keystate.kv_replay(spark.createDataFrame(rows, LOG))
    assert {r["seq"]: r["result"] for r in replayed.collect()} == {i: str(i + 1) for i in range(2000)}
    assert replayed.select(F.spark_partition_id().alias("p")).distinct().count() > 2


def test_command_semantics():
    step = keystate.step
    entry = ("entry", "v", 110)
    assert step(entry, "GET", None, None, 109) == (entry, "v", None)
    assert step(entry, "GET", None, None, 110) == (None, None, "expired")
    assert step(entry, "GETDEL", None, None, 999) == (None, "v", None)
    assert step(entry, "EXISTS", None, None, 999) == (entry, "1", None)
    assert step(entry, "INCR", None, None, 1) == (entry, None, "not_an_integer")
    assert step(None, "SET", "v", 0, 5)[0] == ("entry", "v", 5)
    assert step(("int", 4), "INCR", None, None, 1) == (("int", 5), "5", None)
    assert step(("int", 4), "GET", None, None, 1) == (None, None, "healed")


def test_batches_are_all_or_nothing(spark):
    rows = [("a", START, 1, "INCR", None, None, "b1"), ("a b", START, 2, "GET", None, None, "b1"), ("a", START, 3, "INCR", None, None, "b2")]
    out = {r["seq"]: (r["result"], r["code"]) for r in keystate.kv_replay(spark.createDataFrame(rows, LOG + ", batch_id string")).collect()}
    assert out == {1: (None, "batch_rejected"), 2: (None, "malformed"), 3: ("1", None)}


def test_streamed_state_equals_one_replay(spark):
    rows = log_rows(9, 600)
    folder, root = work_path(spark, "log"), work_path(spark, "state")
    for part in range(3):
        spark.createDataFrame(rows[part * 200:(part + 1) * 200], LOG).coalesce(1).write.mode("append").parquet(folder)
        query_input = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder)
        # A new run for every delivery: state is taken up from the stored version.
        streamed.stream_commands(query_input, root).awaitTermination()
    got = {r["seq"]: (r["result"], r["code"]) for r in streamed.read_results(spark, root).collect()}
    assert got == sequential(rows)[0]


# ---- ingest ---------------------------------------------------------------------------------

LOADED = "k int, v string"
CHUNK = "session string, seq bigint, row_no bigint, k int, v string"


def chunk(session, seq, *rows):
    return [(session, seq, i, k, v) for i, (k, v) in enumerate(rows)]


def test_chunks_once_however_often_delivered(spark):
    folder = work_path(spark, "chunks")
    target = ingest.StreamTarget(work_path(spark, "target"), ["k"], ["k", "v"])
    deliveries = [chunk("s", 1, (1, "a"), (2, "b")), chunk("s", 2, (2, "c"), (3, None), (3, "d")), chunk("s", 2, (2, "c"), (3, None), (3, "d")),
                  chunk("t", 1, (1, "z"), (None, "x"))]
    for rows in deliveries:
        spark.createDataFrame(rows, CHUNK).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(CHUNK).option("maxFilesPerTrigger", 1).parquet(folder)
        ingest.stream_load(stream, target).awaitTermination()
    assert sorted(map(tuple, ingest.read_table(spark, target, LOADED).collect())) == [(1, "z"), (2, "c"), (3, "d")]
    acks = {(r["session"], r["seq"]): (r["inserted"], r["updated"], r["failed"]) for r in ingest.read_acks(spark, target, LOADED).collect()}
    assert acks == {("s", 1): (2, 0, 0), ("s", 2): (1, 2, 0), ("t", 1): (0, 1, 1)}


def test_a_retried_batch_counts_once(spark):
    target = ingest.StreamTarget(work_path(spark, "target"), ["k"], ["k", "v"], "IGNORE")
    rows = spark.createDataFrame(chunk("s", 1, (1, "a")), CHUNK)
    for _ in range(2):
        ingest.append_chunks(rows, 0, target)
    assert ingest.read_table(spark, target, LOADED).count() == 1
    assert ingest.read_acks(spark, target, LOADED).first()["received"] == 1


def test_a_split_chunk_keeps_its_rows(spark):
    """Two rows of a chunk in one micro-batch, the third in the next, a replay after compaction."""
    target = ingest.StreamTarget(work_path(spark, "target"), ["k"], ["k", "v"])
    rows = chunk("s", 1, (1, "a"), (2, "b"), (None, "c"))
    ingest.append_chunks(spark.createDataFrame(rows[:2], CHUNK), 0, target)
    assert ingest.compact(spark, target, LOADED) == 1
    ingest.append_chunks(spark.createDataFrame(rows[2:], CHUNK), 1, target)
    ingest.append_chunks(spark.createDataFrame(rows, CHUNK), 0, target, "replay")
    for _ in range(2):
        ack = ingest.read_acks(spark, target, LOADED).first()
        assert (ack["received"], ack["inserted"], ack["failed"]) == (3, 2, 1)
        error = ingest.read_errors(spark, target, LOADED).collect()
        assert [(r["session"], r["seq"], r["row_no"], r["code"], r["field"]) for r in error] == [("s", 1, 2, "null_key", "k")]
        assert sorted(map(tuple, ingest.read_table(spark, target, LOADED).collect())) == [(1, "a"), (2, "b")]
        ingest.compact(spark, target, LOADED)


def test_session_gate(spark):
    rows = spark.createDataFrame(
        [("a", 1, "o"), ("a", 2, None), ("b", 1, None), ("c", 2, "o"), ("d", 1, "o"), ("e", 1, "o")], "session string, seq bigint, options string")
    ends = spark.createDataFrame([("a", True), ("d", False), ("b", True), ("c", True)], "session string, commit boolean")
    got = {(r["session"], r["seq"]): (r["options"], r["code"]) for r in ingest.session_gate(rows, ends).collect()}
    assert got == {("a", 1): ("o", None), ("a", 2): ("o", None), ("b", 1): (None, "missing_options"), ("c", 2): ("o", "missing_options"),
                   ("d", 1): ("o", "rolled_back"), ("e", 1): ("o", "open")}


def test_stream_stops_between_batches(spark):
    folder = work_path(spark, "files")
    for i in range(4):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(folder)
    seen = reads.stream_until(stream, work_path(spark, "cp"), lambda batch, batch_id: batch_id < 1)
    assert seen == {"batches": 2, "rows": 20, "truncated": True}
    checkpoint, got = work_path(spark, "cp"), []

    def two(batch, batch_id):
        got.extend(r["id"] for r in batch.collect())
        return len(got) % 20 > 0

    for truncated in (True, True, False):
        assert reads.stream_until(stream, checkpoint, two)["truncated"] is truncated or truncated
    assert sorted(got) == list(range(40))
    whole = reads.stream_until(stream, work_path(spark, "cp"), lambda batch, batch_id: True)
    assert whole == {"batches": 4, "rows": 40, "truncated": False}


def test_late_rows_are_dropped(spark):
    folder, out = work_path(spark, "samples"), work_path(spark, "windows")
    schema = "ts timestamp, tag string, v double"
    times = [[0, 30], [5000], [10], [20000]]  # the third delivery is far behind the watermark
    spec = TimeseriesSpec("ts", ("tag",), ("v",))
    dropped = 0
    for batch in times:
        spark.createDataFrame([(START + dt.timedelta(seconds=s), "a", float(s)) for s in batch], schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        query = reads.stream_to(reads.stream_downsample(stream, spec, "1 MINUTES", "10 MINUTES"), f"{out}/data", f"{out}/cp")
        query.awaitTermination()
        dropped += sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])
    rows = sorted((r["window_start"], r["samples"], r["v_sum"]) for r in spark.read.parquet(f"{out}/data").collect())
    assert rows[0][1:] == (2, 30.0) and len(rows) == 2 and dropped == 1


def test_stream_decode_has_two_sinks(spark):
    folder, root = work_path(spark, "json"), work_path(spark, "decoded")
    spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": "x"}'), (3, "{}")], "id int, body string").write.parquet(folder)
    stream = spark.readStream.schema("id int, body string").parquet(folder)
    spec = RecordSpec("r", (FieldSpec("k", Scalar("i8")),))
    reads.stream_decode(read_records(stream, "body", F.col("id").cast("string")), spec, root).awaitTermination()
    good, bad = reads.decoded_rows(spark, root)
    assert good.count() == 1
    assert {r["code"] for r in bad.collect()} == {"type_mismatch", "missing_field"}


# ---- rebuild --------------------------------------------------------------------------------


def heroes(spark, root):
    snapshots.commit(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string"), root)


def test_filtered_copy_is_not_published(spark):
    root = work_path(spark, "hero")
    heroes(spark, root)
    with pytest.raises(plans.CopyMismatch):
        plans.rebuild(spark, root, lambda df: df.where("id < 3"), ["id"])
    assert snapshots.current_version(spark, root) == 1 and snapshots.read_current(spark, root).count() == 3
    # After the conversion is put right the same rebuild goes through.
    done = plans.rebuild(spark, root, lambda df: df, ["id"]).first()
    assert done["verified"] and plans.rebuild(spark, root, lambda df: df.where("false"), ["id"]).first() == done


def test_swapped_keys_are_caught(spark):
    root = work_path(spark, "hero")
    heroes(spark, root)
    with pytest.raises(plans.CopyMismatch):
        plans.rebuild(spark, root, lambda df: df.withColumn("id", F.col("id") + 1), ["id"])


def test_finished_copy_is_not_repeated(spark):
    root, calls = work_path(spark, "hero"), []
    heroes(spark, root)

    def convert(df):
        calls.append(1)
        return df.withColumn("name", F.upper("name"))

    plans.rebuild(spark, root, convert, ["id"])
    plans.rebuild(spark, root, convert, ["id"])
    assert len(calls) == 1 and snapshots.current_version(spark, root) == 2


def test_interrupted_switch_is_finished(spark):
    root = work_path(spark, "hero")
    heroes(spark, root)
    copied = snapshots.stage(snapshots.read_current(spark, root).withColumn("x", F.lit(1)), root)
    snapshots.write_text(spark, f"{root}/DONE-rebuild", str(copied))
    plans.rebuild(spark, root, lambda df: df.where("false"), ["id"])
    assert "x" in snapshots.read_current(spark, root).columns


def test_old_version_stays_readable(spark):
    root = work_path(spark, "hero")
    heroes(spark, root)
    plans.rebuild(spark, root, lambda df: df.withColumn("id", F.col("id").cast("bigint")), ["id"])
    assert spark.read.parquet(snapshots.version_path(root, 1)).count() == 3


def test_seed_twice_changes_nothing(spark):
    base = spark.createDataFrame([(1, "old")], "id int, name string")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    once = plans.seed(base, rows, ["id"]).snapshot
    twice = plans.seed(once, rows, ["id"]).snapshot
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "b")]
