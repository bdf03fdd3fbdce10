"""Stream loads with late and repeated chunks: the same with and without compaction, and as row by row."""

import random

import pytest

from recordlake.session import work_path
from recordlake.sources import snapshots
from recordlake.streaming import ingest

LOADED = "k int, v string, w int"
CHUNK = "session string, seq bigint, row_no bigint, k int, v string, w int"


def by_hand(rows, mode, update_cols=()):
    """Rows one by one in the order (session, seq, row)."""
    table, status, codes = {}, {}, {}
    met = {"UPDATE": "updated", "IGNORE": "ignored", "ERROR": "failed", "ABORT": "failed"}[mode]
    for s, q, r, k, v, w in sorted(set(rows), key=lambda x: x[:3]):
        if k is None:
            status[s, q, r], codes[s, q, r] = "failed", "null_key"
        elif k not in table:
            table[k], status[s, q, r] = {"v": v, "w": w}, "inserted"
        else:
            status[s, q, r] = met
            if met == "failed":
                codes[s, q, r] = "duplicate_key"
            if mode == "UPDATE":
                for c, x in (("v", v), ("w", w)):
                    if x is not None and (not update_cols or c in update_cols):
                        table[k][c] = x
    if mode == "ABORT" and "duplicate_key" in codes.values():
        codes = {p: codes.get(p, "aborted") for p in status}
        return {}, dict.fromkeys(status, "failed"), codes
    return table, status, codes


def seen(spark, target):
    table = {r["k"]: {"v": r["v"], "w": r["w"]} for r in ingest.read_table(spark, target, LOADED).collect()}
    acks = {(r["session"], r["seq"]): tuple(r[s] for s in ingest.STATUSES) for r in ingest.read_acks(spark, target, LOADED).collect()}
    errors = {(r["session"], r["seq"], r["row_no"]): r["code"] for r in ingest.read_errors(spark, target, LOADED).collect()}
    return table, acks, errors


def told(rows, mode, update_cols):
    table, status, codes = by_hand(rows, mode, update_cols)
    acks = {}
    for (s, q, _), st in status.items():
        one = acks.setdefault((s, q), dict.fromkeys(ingest.STATUSES, 0))
        one["received"] += 1
        one[st] += 1
    return table, {p: tuple(x[s] for s in ingest.STATUSES) for p, x in acks.items()}, codes


@pytest.mark.parametrize("mode,update_cols", [("UPDATE", ()), ("UPDATE", ("w",)), ("IGNORE", ()), ("ERROR", ()), ("ABORT", ())])
def test_late_and_repeated_chunks(spark, mode, update_cols):
    rng = random.Random(len(mode) + len(update_cols))
    chunks = []
    for s in "ab":
        for q in range(1, 4):
            chunks.append([(s, q, r, rng.choice([None, *range(200 if mode == "ABORT" else 9)]), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2])) for r in range(6)])
    deliveries = chunks + [rng.choice(chunks)[2:] for _ in range(2)]
    rng.shuffle(deliveries)
    target = ingest.StreamTarget(work_path(spark, "target"), ["k"], ["k", "v", "w"], mode, update_cols)
    sent = []
    for i, rows in enumerate(deliveries):
        ingest.append_chunks(spark.createDataFrame(rows, CHUNK), i, target)
        sent += rows
        if i in (2, 5):
            ingest.compact(spark, target, LOADED)
            assert i == 2 or seen(spark, target) == told(sent, mode, update_cols)
    assert seen(spark, target) == told(sent, mode, update_cols)


def test_a_read_lists_only_newer_folders(spark):
    target = ingest.StreamTarget(work_path(spark, "target"), ["k"], ["k", "v", "w"])
    for i in range(3):
        ingest.append_chunks(spark.createDataFrame([("a", i + 1, 0, i, "x", i)], CHUNK), i, target)
    ingest.compact(spark, target, LOADED)
    assert ingest.StreamState(spark, target, LOADED).folders == []
    ingest.append_chunks(spark.createDataFrame([("a", 9, 0, 1, "late", None)], CHUNK), 3, target)
    assert [f.rsplit("/", 1)[1] for f in ingest.StreamState(spark, target, LOADED).folders] == ["batch=3"]
    before = {r["file"] for r in ingest.StreamState(spark, target, LOADED).keyed.files().collect()}
    ingest.compact(spark, target, LOADED)  # removes what the compaction before took in
    assert [f.rsplit("/", 1)[1] for f in snapshots.folders(spark, f"{target.log}/source=*/batch=*")] == ["batch=3"]
    ingest.append_chunks(spark.createDataFrame([("a", 1, 0, 0, "x", 0)], CHUNK), 0, target)  # delivered again, long after
    assert seen(spark, target) == told([("a", 1, 0, 0, "x", 0), ("a", 2, 0, 1, "x", 1), ("a", 3, 0, 2, "x", 2), ("a", 9, 0, 1, "late", None)], "UPDATE", ())
    assert before


def test_sessions_settle_once(spark):
    gated = "session string, seq bigint, row_no bigint, k int, v string, w int, options string, commit boolean"
    target = ingest.StreamTarget(work_path(spark, "target"), ["k"], ["k", "v", "w"], gated=True)

    def send(i, *rows):
        ingest.append_chunks(spark.createDataFrame(rows, gated), i, target)

    send(0, ("a", 1, 0, 1, "x", 1, None, None), ("a", 1, 1, 2, "x", 1, "o", None), ("b", 2, 0, 3, "y", 1, None, None))
    ingest.compact(spark, target, LOADED)
    assert seen(spark, target)[2] == {("a", 1, 0): "open", ("a", 1, 1): "open", ("b", 2, 0): "missing_options"}
    send(1, ("a", None, None, None, None, None, None, True), ("b", 1, 0, 4, "z", 1, "o", None), ("b", None, None, None, None, None, None, True))
    ingest.compact(spark, target, LOADED)
    assert seen(spark, target) == ({1: {"v": "x", "w": 1}, 2: {"v": "x", "w": 1}, 3: {"v": "y", "w": 1}, 4: {"v": "z", "w": 1}},
                                   {("a", 1): (2, 2, 0, 0, 0), ("b", 2): (1, 1, 0, 0, 0), ("b", 1): (1, 1, 0, 0, 0)}, {})
    send(2, ("a", None, None, None, None, None, None, False), ("a", 5, 0, 7, "q", 1, None, None))
    with pytest.raises(Exception, match="two ends of session a"):
        seen(spark, target)


def test_options_that_differ_fail(spark):
    rows = spark.createDataFrame([("a", 1, "o"), ("a", 1, None), ("a", 1, "p")], "session string, seq bigint, options string")
    with pytest.raises(Exception, match="two options for session a"):
        ingest.session_gate(rows).collect()
    assert {r["options"] for r in ingest.session_gate(rows.limit(2)).collect()} == {"o"}
