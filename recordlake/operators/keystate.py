"""Keyed state with expiry: replay of a per-key command log.

Commands: SET (value, optional ttl in seconds), GET, GETDEL, EXISTS, INCR. An entry expires when
stored_at + ttl <= now, in whole seconds. GET on an expired entry, or on a raw counter, removes it
and misses. GETDEL returns an entry whatever its age. EXISTS looks at presence only. INCR counts
from zero and fails on an entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.operators.skew import join_to_one
from recordlake.session import durable

COMMANDS = ("SET", "GET", "GETDEL", "EXISTS", "INCR")
# Internal command that puts back a state carried over from an earlier run.
RESTORE = "_RESTORE"
RESULT = "result string, code string, state_kind string, state_value string, state_expiry bigint"


def step(state, command, value, ttl, now):
    """One command on one key: (new state, result, code). State: None, ('entry', value, expiry) or ('int', n)."""
    kind = state[0] if state else None
    if command == "GET":
        if kind == "entry" and (state[2] is None or state[2] > now):
            return state, state[1], None
        return None, None, {None: None, "entry": "expired", "int": "healed"}[kind]
    if command == "SET":
        return ("entry", value, None if ttl is None else now + ttl), "OK", None
    if command == "GETDEL":
        return None, state[1] if kind == "entry" else None, "healed" if kind == "int" else None
    if command == "EXISTS":
        return state, "1" if state else "0", None
    if command == "INCR":
        if kind == "entry":
            return state, None, "not_an_integer"
        n = state[1] + 1 if kind else 1
        return ("int", n), str(n), None
    if command == RESTORE:
        return restored(value, ttl, now), None, None
    return state, None, "unknown_command"


def restored(value, expiry, _now):
    if value is None:
        return None
    return ("int", int(value[1:])) if value[0] == "i" else ("entry", value[1:], expiry)


@dataclass
class Tail:
    """What the last key's run in a partition does to a state it did not see.

    ``known`` when a command fixed the state; otherwise only GET, EXISTS and INCR came: the largest
    GET time and the INCRs after the last GET (all of them when there was none) tell the outcome.
    """

    key: str
    whole: bool
    known: bool
    state: tuple | None
    max_get: int | None
    incrs: int

    def apply(self, before):
        if self.known:
            return self.state
        if before and before[0] == "entry" and (self.max_get is None or before[2] is None or before[2] > self.max_get):
            return before
        start = before[1] if before and before[0] == "int" and self.max_get is None else 0
        n = start + self.incrs
        return ("int", n) if n else None


def _rows(pdf: pd.DataFrame):
    ttl = [None if pd.isna(t) else int(t) for t in pdf["ttl"]]
    value = [None if pd.isna(v) else v for v in pdf["value"]]
    return zip(pdf["key"].tolist(), pdf["command"].tolist(), value, ttl, pdf["now"].tolist())


def _tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, key, first = None, None, True
    known, state, max_get, incrs = False, None, None, 0
    keys = 0
    for pdf in batches:
        if part is None and len(pdf):
            part = int(pdf["_part"].iloc[0])
        for k, command, value, ttl, now in _rows(pdf):
            if first or k != key:
                key, first = k, False
                keys += 1
                known, state, max_get, incrs = False, None, None, 0
            if not known and command in ("SET", "GETDEL", RESTORE):
                known = True
            if known:
                state, _, _ = step(state, command, value, ttl, now)
            elif command == "GET":
                max_get, incrs = now, 0
            elif command == "INCR":
                incrs += 1
    if part is not None:
        kind, val, expiry = _packed(state)
        yield pd.DataFrame({
            "_part": [part], "key": [key], "whole": [keys == 1], "known": [known], "state_kind": [kind], "state_value": [val],
            "state_expiry": pd.array([expiry], dtype="Int64"), "max_get": pd.array([max_get], dtype="Int64"), "incrs": [incrs]})


def _packed(state):
    if state is None:
        return None, None, None
    return ("entry", state[1], state[2]) if state[0] == "entry" else ("int", str(state[1]), None)


def _replayer(carried: dict[int, tuple], out_columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, first = None, None, True
        for pdf in batches:
            if first and len(pdf):
                # A key cut by the partition border goes on from where the previous one left it.
                key, state = carried.get(int(pdf["_part"].iloc[0]), (None, None))
                first = False
            results = []
            for k, command, value, ttl, now in _rows(pdf):
                if k != key:
                    key, state = k, None
                state, result, code = step(state, command, value, ttl, now)
                results.append((result, code, *_packed(state)))
            found = pd.DataFrame(results, columns=["result", "code", "state_kind", "state_value", "state_expiry"])
            found["state_expiry"] = found["state_expiry"].astype("Int64")
            yield pd.concat([pdf[out_columns].reset_index(drop=True), found], axis=1)

    return run


def kv_replay(commands: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Replay ``key, ts, seq, command, value, ttl`` in (ts, seq) order per key.

    Gives every command with ``result``, ``code`` and the key's state after it. With ``batch_id``, a
    batch holding a malformed command (unknown name, a key that is empty or has white space, SET
    without a value, a negative ttl) is rejected as a whole: none of its commands runs. ``state``
    restores keys from an earlier run.

    The log is range-partitioned on (key, time), so a key with any share of the commands spreads
    over many tasks. A first pass sums up what each partition does to the key cut at its end (one
    row per partition); chaining those rows gives each partition its starting state.
    """
    log = commands if "batch_id" in commands.columns else commands.withColumn("batch_id", F.lit(None).cast("string"))
    bad = (
        ~F.col("command").isin(*COMMANDS) | F.col("key").isNull() | F.col("key").rlike(r"^$|\s")
        | ((F.col("command") == "SET") & F.col("value").isNull()) | F.coalesce(F.col("ttl") < 0, F.lit(False))
    )
    log = log.select("key", "seq", "batch_id", "command", F.col("value").cast("string").alias("value"), F.col("ttl").cast("bigint").alias("ttl"),
                     F.unix_timestamp(F.col("ts").cast("timestamp")).alias("now"), F.coalesce(bad, F.lit(True)).alias("_bad"))
    rejected = log.where(F.col("_bad") & F.col("batch_id").isNotNull()).select("batch_id").distinct().withColumn("_rejected", F.lit(True))
    log = join_to_one(log, rejected, ["batch_id"], "left")
    refused = F.col("_bad") | F.coalesce(F.col("_rejected"), F.lit(False))
    runnable = log.where(~refused).drop("_bad", "_rejected")
    if state is not None:
        packed = F.concat(F.substring("state_kind", 1, 1), F.col("state_value"))
        runnable = runnable.unionByName(state.where("state_kind IS NOT NULL").select(
            "key", F.lit(-1).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("batch_id"), F.lit(RESTORE).alias("command"),
            packed.alias("value"), F.col("state_expiry").alias("ttl"), F.lit(-(2**62)).alias("now")))
    placed = durable(
        runnable.repartitionByRange("key", "now", "seq").sortWithinPartitions("key", "now", "seq").withColumn("_part", F.spark_partition_id()))
    tail_schema = "_part int, key string, whole boolean, known boolean, state_kind string, state_value string, state_expiry bigint, max_get bigint, incrs bigint"
    borders = {r["_part"]: r["first_key"] for r in placed.groupBy("_part").agg(F.min("key").alias("first_key")).collect()}
    tails = {r["_part"]: r for r in placed.mapInPandas(_tails, tail_schema).collect()}
    carried = _chain(borders, tails)
    columns = ["key", "seq", "batch_id", "command", "now"]
    types = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in columns) + ", " + RESULT
    replayed = placed.mapInPandas(_replayer(carried, columns), schema).where(F.col("command") != RESTORE)
    code = F.when(F.col("_bad"), F.lit("malformed")).otherwise(F.lit("batch_rejected"))
    none = F.lit(None).cast("string")
    return replayed.unionByName(log.where(refused).select(
        *columns, none.alias("result"), code.alias("code"), none.alias("state_kind"), none.alias("state_value"),
        F.lit(None).cast("bigint").alias("state_expiry")))


def _chain(borders: dict[int, str], tails: dict) -> dict[int, tuple]:
    """The state each partition starts its first key with; one step per partition."""
    carried, key, state = {}, None, None
    for part in sorted(tails):
        if key is not None and borders[part] == key:
            carried[part] = (key, state)
        row = tails[part]
        own = None
        if row["state_kind"] == "entry":
            own = ("entry", row["state_value"], row["state_expiry"])
        elif row["state_kind"] == "int":
            own = ("int", int(row["state_value"]))
        tail = Tail(row["key"], row["whole"], row["known"], own, row["max_get"], row["incrs"])
        before = state if row["whole"] and row["key"] == key else None
        key, state = row["key"], tail.apply(before)
    return carried


def final_state(replayed: DataFrame) -> DataFrame:
    """The state of every key after the log; keys left empty are dropped."""
    ran = replayed.where("code IS NULL OR code NOT IN ('malformed', 'batch_rejected')")
    last = ran.groupBy("key").agg(F.max_by(F.struct("state_kind", "state_value", "state_expiry"), F.struct("now", "seq")).alias("s"))
    return last.select("key", "s.*").where("state_kind IS NOT NULL")
