"""Chunked ingest as a stream: appended micro-batches, replays recognised, sessions, acks and errors.

A micro-batch is only appended to the log. Table, acks and errors are what all chunk rows come to when
each counts once, in the order (session, sequence, row), however chunks were cut into micro-batches,
delivered again, or late.

``compact`` takes log folders into a *state* that merges in any order. It keeps, for each key, the place
of its first row, its number of rows and, for each written column, the last value and the place it came
from; a late chunk therefore finds what it has to be compared with. The state lies in key order
(``sources.ranged``), so a compaction writes anew only the files of keys it meets. Beside it stand: which
rows were taken in (a bit per row of a chunk, appended by each compaction), the rows that are errors by
themselves, the sessions, and the rows that a session holds back. A version names all of these with one
pointer, and the folders it has taken in, which are never listed for reading again; the next compaction
removes them.

A session that is ended in two ways, or opened with two options, fails whatever has been compacted, and
so does a chunk that would take back what its session has loaded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.operators.skew import join_to_one
from recordlake.session import stored
from recordlake.sources import snapshots
from recordlake.sources.ranged import RangedTable, has_bit

PLACE = ["session", "seq", "row_no"]
#: Compactions whose appended parts are read one by one before they are made one.
PARTS = 16
STATUSES = ("received", "inserted", "updated", "ignored", "failed")


@dataclass(frozen=True)
class StreamTarget:
    """Where a stream load keeps its log and its compacted state, and how rows load.

    Log rows are ``session, seq, row_no`` plus ``columns``. A ``gated`` target has ``options`` (text, on a
    session's first chunk) and ``commit`` (on a row without ``row_no`` that ends the session) as well.
    """

    root: str
    keys: Sequence[str]
    columns: Sequence[str]
    mode: str = "UPDATE"
    update_cols: Sequence[str] = ()
    gated: bool = False

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    @property
    def table(self) -> str:
        return f"{self.root}/table"

    @property
    def written(self) -> list[str]:
        """Columns that a later row of a key overwrites."""
        if self.mode != "UPDATE":
            return []
        return [c for c in self.columns if c not in self.keys and (not self.update_cols or c in self.update_cols)]


def append_chunks(batch: DataFrame, batch_id: int, target: StreamTarget, source: str = "main") -> None:
    """Append one micro-batch; a retry of it overwrites its own folder."""
    extra = ["options", "commit"] if target.gated else []
    rows = batch.select(*PLACE, *target.columns, *extra)
    rows.write.mode("overwrite").parquet(f"{target.log}/source={source}/batch={batch_id}")


def stream_load(chunks: DataFrame, target: StreamTarget, source: str = "main"):
    """Start a bounded (available-now) stream that appends chunks; returns the query.

    ``source`` names the stream: each has its own checkpoint and its own part of the log.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        append_chunks(batch, batch_id, target, source)

    return chunks.writeStream.foreachBatch(append).option(
        "checkpointLocation", f"{target.root}/checkpoint-{source}").trigger(availableNow=True).start()


# ---- what merges in any order ---------------------------------------------------------------


def _place() -> Column:
    return F.struct(*PLACE)


def _keyed(rows: DataFrame, target: StreamTarget) -> DataFrame:
    """One row per key of some chunk rows: ``_first``, ``_n``, the columns and where written ones came from."""
    written = target.written
    values = [F.max_by(c, F.when(F.col(c).isNotNull(), _place())).alias(c) if c in written else F.min_by(F.struct(c), _place())[c].alias(c)
              for c in target.columns if c not in target.keys]
    came = [F.max(F.when(F.col(c).isNotNull(), _place())).alias(f"_at_{c}") for c in written]
    return rows.groupBy(*target.keys).agg(F.min(_place()).alias("_first"), F.count(F.lit(1)).alias("_n"), *values, *came)


def _changes(target: StreamTarget) -> dict[str, Column]:
    """What a stored row of ``_keyed`` becomes when it meets ``_new``, another one of its key."""
    out = {"_first": F.least("_first", "_new._first"), "_n": F.col("_n") + F.col("_new._n")}
    for c in target.columns:
        if c in target.written:
            newer = F.coalesce(F.col(f"_new._at_{c}") > F.col(f"_at_{c}"), F.col(f"_new._at_{c}").isNotNull())
            out |= {c: F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(c)), f"_at_{c}": F.greatest(f"_at_{c}", f"_new._at_{c}")}
        elif c not in target.keys:
            out[c] = F.when(F.col("_new._first") < F.col("_first"), F.col(f"_new.{c}")).otherwise(F.col(c))
    return out


def _sessions(rows: DataFrame) -> DataFrame:
    """One row per session: its first chunk, the options on it, and how it ended."""
    nothing = F.lit(None).cast("string")
    seen = rows.select("session", "seq", "options" if "options" in rows.columns else nothing.alias("options"),
                       "commit" if "commit" in rows.columns else F.lit(None).cast("boolean").alias("commit"))
    return _merge_sessions(seen.select("session", F.col("seq").alias("first"), F.col("options").alias("low"), F.col("options").alias("high"),
                                       F.col("commit").alias("ended_low"), F.col("commit").alias("ended_high"), F.lit(False).alias("loaded")))


def _merge_sessions(rows: DataFrame) -> DataFrame:
    ends = [F.min("ended_low").alias("ended_low"), F.max("ended_high").alias("ended_high"), F.max("loaded").alias("loaded")]
    by_chunk = rows.groupBy("session", "first").agg(F.min("low").alias("low"), F.max("high").alias("high"), *ends)
    opened = F.min_by(F.struct("first", "low", "high"), "first").alias("o")
    return by_chunk.groupBy("session").agg(opened, *ends).select("session", "o.*", "ended_low", "ended_high", "loaded")


def _gate(chunks: DataFrame, sessions: DataFrame, ends: bool) -> DataFrame:
    """Chunks with their session's ``options``, and a ``code`` where they may not load."""
    verdict = F.when(F.col("_s.low").isNull() | (F.col("_s.first") != 1), F.lit("missing_options"))
    if ends:
        verdict = verdict.when(F.col("_s.ended_low").isNull(), F.lit("open")).when(~F.col("_s.ended_low"), F.lit("rolled_back"))
    name = F.col("session").cast("string")
    fail = F.when(F.col("_s.low") != F.col("_s.high"), F.raise_error(F.concat(F.lit("two options for session "), name)).cast("string"))
    if ends:
        fail = fail.when(F.col("_s.ended_low") != F.col("_s.ended_high"), F.raise_error(F.concat(F.lit("two ends of session "), name)).cast("string"))
    fail = fail.when(F.col("_s.loaded") & verdict.isNotNull(), F.raise_error(F.concat(F.lit("loaded rows taken back in session "), name)).cast("string"))
    known = sessions.select("session", F.struct(*[c for c in sessions.columns if c != "session"]).alias("_s"))
    return join_to_one(chunks, known, ["session"], "left").withColumn("code", F.coalesce(fail, verdict)).withColumn(
        "options", F.col("_s.low")).drop("_s")


def session_gate(chunks: DataFrame, commits: DataFrame | None = None) -> DataFrame:
    """Chunks with their session's options, and a ``code`` where they may not load.

    The first chunk of a session must carry ``options`` (on any of its rows; two values fail); later ones
    inherit them. ``commits`` (session, commit) ends sessions: a rolled-back one is discarded, one not
    ended yet waits.
    """
    seen = _sessions(chunks.select("session", "seq", "options"))
    if commits is not None:
        ended = _sessions(commits.select("session", F.lit(None).cast("bigint").alias("seq"), "commit"))
        seen = _merge_sessions(seen.unionByName(ended))
    return _gate(chunks, seen, commits is not None)


# ---- state ----------------------------------------------------------------------------------


class StreamState:
    """What the log comes to now: the last compaction, and the folders written since."""

    def __init__(self, spark: SparkSession, target: StreamTarget, schema):
        self.spark, self.target = spark, target
        self.schema = spark.createDataFrame([], schema).schema
        self.version = snapshots.current_version(spark, target.table)
        self.since, state_version, self.taken = 1, 0, []
        if self.version:
            meta = self._part("meta").collect()  # one row
            self.since, state_version, self.taken = meta[0]["since"], meta[0]["state"], list(meta[0]["taken"])
        self.keyed = RangedTable(spark, f"{target.root}/state", list(target.keys), self._keyed_schema(), pinned=state_version)
        gone = set(self.taken)
        self.folders = [f for f in snapshots.folders(spark, f"{target.log}/source=*/batch=*") if f not in gone]

    def _keyed_schema(self) -> T.StructType:
        place = T.StructType([T.StructField("session", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("row_no", T.LongType())])
        by_name = {f.name: f.dataType for f in self.schema.fields}
        others = [c for c in self.target.columns if c not in self.target.keys]
        return T.StructType([*[T.StructField(k, by_name[k]) for k in self.target.keys], T.StructField("_first", place), T.StructField("_n", T.LongType()),
                             *[T.StructField(c, by_name[c]) for c in others], *[T.StructField(f"_at_{c}", place) for c in self.target.written]])

    def _part(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{snapshots.version_path(self.target.table, self.version)}/{name}")

    def _parts(self, name: str) -> DataFrame | None:
        """What the compactions appended under a name."""
        if not self.version:
            return None
        paths = [f"{snapshots.version_path(self.target.table, v)}/{name}" for v in range(self.since, self.version + 1)]
        return self.spark.read.parquet(*paths)

    @cached_property
    def log(self) -> DataFrame:
        """Rows written since, and rows that were held back."""
        extra = [T.StructField("options", T.StringType()), T.StructField("commit", T.BooleanType())] if self.target.gated else []
        schema = T.StructType([*self._keyed_schema()["_first"].dataType.fields, *[f for f in self.schema.fields if f.name in self.target.columns], *extra])
        rows = self.spark.read.schema(schema).parquet(*self.folders) if self.folders else self.spark.createDataFrame([], schema)
        return rows.select(*schema.names)

    @cached_property
    def sessions(self) -> DataFrame:
        seen = _sessions(self.log)
        return stored(_merge_sessions(seen.unionByName(self._part("sessions"))) if self.version else seen, "sessions")

    @cached_property
    def rows(self) -> DataFrame:
        """Each row of the log that no compaction took in, once, with its ``code``."""
        columns = [*PLACE, *self.target.columns]
        chunks = self.log.where("row_no IS NOT NULL").select(*columns)
        if self.version:
            chunks = chunks.unionByName(self._part("held").select(*columns))
        # Of a row that was delivered more than once any copy will do: they are the same.
        once = chunks.groupBy(*PLACE).agg(F.min_by(F.struct(*self.target.columns), F.xxhash64(*self.target.columns)).alias("r")).select(*PLACE, "r.*")
        once = self._unseen(once)
        gated = _gate(once, self.sessions, True).drop("options") if self.target.gated else once.withColumn("code", F.lit(None).cast("string"))
        return stored(gated, "rows")

    def _unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose bit is not set in what was taken in."""
        ledger = self._parts("ledger")
        if ledger is None:
            return rows
        chunk, at = ["session", "seq", "bucket"], F.expr("bitmap_bit_position(row_no)")
        placed = rows.withColumn("bucket", F.expr("bitmap_bucket_number(row_no)"))
        met = ledger.join(placed.select(*chunk).distinct(), chunk, "left_semi").groupBy(*chunk).agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        return join_to_one(placed, met, chunk, "left").where(F.col("bits").isNull() | ~has_bit(F.col("bits"), at)).select(*rows.columns)

    @cached_property
    def held(self) -> DataFrame:
        return self.rows.where("code IS NOT NULL")

    @cached_property
    def loaded(self) -> DataFrame:
        return self.rows.where("code IS NULL").drop("code")

    @cached_property
    def fresh(self) -> DataFrame:
        """The loaded rows that no compaction took in, one row per key."""
        known = [F.col(k).isNotNull() for k in self.target.keys]
        rows = self.loaded
        for test in known:
            rows = rows.where(test)
        return stored(_keyed(rows, self.target), "fresh")

    @cached_property
    def merged(self) -> DataFrame:
        """All keys now: stored rows meet the fresh ones in a left join, which moves no stored row while these are few."""
        keys, changes = list(self.target.keys), _changes(self.target)
        new = self.fresh.select(*keys, F.struct(*self.fresh.columns).alias("_new"))
        base, there = self.keyed.read(), F.col("_new").isNotNull()
        changed = base.join(new, keys, "left").select(*[
            F.when(there, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in base.columns])
        known = self.keyed.holding(self.fresh.select(*keys))
        return changed.unionByName(self.fresh.join(known.select(*keys), keys, "left_anti").select(*base.columns))

    @cached_property
    def conflict(self) -> bool:
        """ABORT: whether a key came twice."""
        return self.target.mode == "ABORT" and not self.merged.where("_n > 1").isEmpty()

    def told(self) -> DataFrame:
        """Loaded rows that may be errors: those without a key, and where repeats fail, all."""
        rows = self.loaded.select(*PLACE, *self.target.keys)
        if self.target.mode in ("ERROR", "ABORT"):
            return rows
        return rows.where(F.greatest(*[F.col(k).isNull() for k in self.target.keys], F.lit(False)))

    def all_told(self) -> DataFrame:
        before = self._parts("told")
        return self.told() if before is None else before.unionByName(self.told())

    def ledger(self) -> DataFrame:
        """A bit for each row that is loaded now."""
        return self.loaded.groupBy("session", "seq", F.expr("bitmap_bucket_number(row_no)").alias("bucket")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(row_no))").alias("bits"))

    def all_ledger(self) -> DataFrame:
        before = self._parts("ledger")
        return self.ledger() if before is None else before.unionByName(self.ledger()).groupBy("session", "seq", "bucket").agg(
            F.expr("bitmap_or_agg(bits)").alias("bits"))


def _no_key(keys: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])


def read_table(spark: SparkSession, target: StreamTarget, schema) -> DataFrame:
    now = StreamState(spark, target, schema)
    rows = now.merged.select(*now.schema.names)
    return rows.limit(0) if now.conflict else rows


def read_acks(spark: SparkSession, target: StreamTarget, schema) -> DataFrame:
    """Tallies of every chunk that is loaded."""
    return _acks(StreamState(spark, target, schema))


def _acks(now: StreamState) -> DataFrame:
    """From the bits of the rows taken in, the rows without a key, and where keys came first."""
    chunk, mode = ["session", "seq"], now.target.mode
    received = now.all_ledger().groupBy(*chunk).agg(F.sum(F.expr("bitmap_count(bits)")).alias("received"))
    keyless = now.all_told().where(_no_key(now.target.keys).isNotNull()).groupBy(*chunk).agg(F.count(F.lit(1)).alias("keyless"))
    first = now.merged.groupBy(F.col("_first.session").alias("session"), F.col("_first.seq").alias("seq")).agg(F.count(F.lit(1)).alias("inserted"))
    rows = received.join(keyless, chunk, "left").join(first, chunk, "left").na.fill(0, ["keyless", "inserted"])
    met = F.col("received") - F.col("keyless") - F.col("inserted")
    nothing, failed = F.lit(0).cast("bigint"), F.col("keyless")
    counts = {"received": F.col("received"), "inserted": F.col("inserted"), "updated": nothing, "ignored": nothing, "failed": failed}
    if mode == "UPDATE":
        counts["updated"] = met
    elif mode == "IGNORE":
        counts["ignored"] = met
    else:
        counts["failed"] = failed + met
    if now.conflict:
        counts |= {"inserted": nothing, "failed": F.col("received")}
    return rows.select(*chunk, *[c.cast("bigint").alias(n) for n, c in counts.items()])


def read_errors(spark: SparkSession, target: StreamTarget, schema) -> DataFrame:
    """One row per chunk row that is not in the table: session, seq, row_no, code, field, message."""
    now, keys = StreamState(spark, target, schema), list(target.keys)
    absent = _no_key(keys)
    text = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    told = now.all_told().withColumn("field", absent)
    nothing = [F.lit(None).cast("string").alias(c) for c in ("field", "message")]
    out = told.where("field IS NOT NULL").select(*PLACE, F.lit("null_key").alias("code"), "field", F.concat(F.lit("key column is null: "), "field").alias("message"))
    if target.mode in ("ERROR", "ABORT"):
        first = now.merged.select(*keys, "_first")
        met = join_to_one(told.where("field IS NULL"), first, keys, "left").withColumn("again", _place() != F.col("_first"))
        out = out.unionByName(met.where("again").select(
            *PLACE, F.lit("duplicate_key").alias("code"), F.lit(",".join(keys)).alias("field"), F.concat(F.lit("key already present: "), text).alias("message")))
        if now.conflict:
            out = out.unionByName(met.where("NOT again").select(
                *PLACE, F.lit("aborted").alias("code"), nothing[0], F.lit("batch rejected").alias("message")))
    return out.unionByName(now.held.select(*PLACE, "code", *nothing))


def read_summary(spark: SparkSession, target: StreamTarget, schema) -> DataFrame:
    """Tallies over all chunks of each session, its state, and the rows it holds back."""
    now = StreamState(spark, target, schema)
    held = now.held.groupBy("session").agg(F.min("code").alias("state"), F.count(F.lit(1)).alias("held"))
    loaded = _acks(now).groupBy("session").agg(*[F.sum(c).alias(c) for c in STATUSES]).withColumn(
        "state", F.lit("loaded")).withColumn("held", F.lit(0).cast("bigint"))
    return loaded.unionByName(held, allowMissingColumns=True).groupBy("session").agg(
        F.min("state").alias("state"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in (*STATUSES, "held")])


def compact(spark: SparkSession, target: StreamTarget, schema) -> int:
    """Take what was written since the last compaction into the state; returns the new version.

    The pointer makes all parts visible together. A compaction that fails leaves the version before it,
    from which the next one goes on. Folders taken in by the version before are removed afterwards.
    """
    now = StreamState(spark, target, schema)
    version = (now.version or 0) + 1
    path = snapshots.version_path(target.table, version)
    state = now.keyed.merge(now.fresh, _changes(target)).version
    whole = not now.version or version - now.since >= PARTS
    for name, new, everything in (("ledger", now.ledger, now.all_ledger), ("told", now.told, now.all_told)):
        (everything() if whole else new()).write.mode("overwrite").parquet(f"{path}/{name}")
    now.held.drop("code").write.mode("overwrite").parquet(f"{path}/held")
    took = now.loaded.select("session").distinct().withColumn("took", F.lit(True))
    now.sessions.join(took, "session", "left").withColumn("loaded", F.col("loaded") | F.coalesce("took", F.lit(False))).drop("took").write.mode(
        "overwrite").parquet(f"{path}/sessions")
    spark.createDataFrame([(state, version if whole else now.since, now.folders)], "state int, since int, taken array<string>").write.mode(
        "overwrite").parquet(f"{path}/meta")
    snapshots.publish(spark, target.table, version)
    for folder in now.taken:
        snapshots.remove(spark, folder)
    return version
