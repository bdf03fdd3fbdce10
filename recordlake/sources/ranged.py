"""Tables kept in key order, of which a write touches only the files that hold its keys.

A table is a few *runs*; each run is a set of Parquet files in key order that do not overlap. The manifest
of a version has a row per file: its run, least and greatest key, number of rows, and the size of its
Bloom filter, whose 4 KB blocks are rows of a table of their own. Files never change.

A merge asks, for each key of the batch, which file of each run can hold it (one sort of the batch with the
files' least keys), then that file's filter, then the key columns of the files that are left. Only files
that do hold a key of the batch are written anew, each to one file with the same keys; the others keep
their names and are not read. New keys become a run of their own, and the latest runs are folded into one
while they are of similar size, so that the number of runs grows with the logarithm of the table.

The driver sees file names and counts, never keys. A reader of an older version is not disturbed. One
writer at a time; a write that fails leaves files no manifest names, and the version before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.session import durable, stored
from recordlake.sources import snapshots

#: Bits of one filter block (what ``bitmap_construct_agg`` makes), bits set per key, and bits spent per key.
BLOCK_BITS = 32768
MARKS = 4
BITS_PER_KEY = 12
#: Files of one write that have a task each; of more, a task writes several.
TASKS = 64
#: A batch with more keys than this share of the table's is joined with all stored keys; filters would save nothing.
LARGE = 0.1
#: A run is folded into the one before it unless that one is this many times larger.
FOLD = 2


@dataclass
class Merged:
    """What a merge did: the new version, and how many files it left, wrote anew, and added."""

    version: int
    kept: int
    rewritten: int
    added: int


@dataclass
class RangedTable:
    """A table under ``root`` with unique, non-null ``keys``; ``schema`` is that of its rows."""

    spark: SparkSession
    root: str
    keys: Sequence[str]
    schema: object
    rows_per_file: int = 1_000_000
    #: The version to read and to go on from in place of the current one; 0 is the empty table.
    pinned: int | None = None

    def version(self) -> int | None:
        if self.pinned is not None:
            return self.pinned or None
        return snapshots.current_version(self.spark, self.root)

    def files(self) -> DataFrame:
        """One row per live file."""
        version = self.version()
        if version is None:
            raise ValueError(f"no published version under {self.root}")
        return self._manifest(version)

    def _manifest(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{snapshots.version_path(self.root, version)}/manifest")

    def read(self) -> DataFrame:
        if self.version() is None:
            return self.spark.createDataFrame([], self.schema)
        return self._open([r["file"] for r in self.files().select("file").collect()])

    def _open(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*names)

    def create(self, rows: DataFrame) -> Merged:
        """Write the first version, or replace the table."""
        made = self._write_run(rows, 0)
        return self._publish(made, 0, 0, made.count())

    def holding(self, asked: DataFrame) -> DataFrame:
        """(keys, file, run) of the asked keys (unique, not null) that are stored."""
        if self.version() is None:
            return asked.select(*self.keys, F.lit("").alias("file"), F.lit(0).alias("run")).limit(0)
        return self._holding(stored(asked.select(*self.keys), "asked"), stored(self.files(), "manifest"))

    def merge(self, batch: DataFrame, changes: Mapping[str, Column], fresh: Mapping[str, Column] | None = None,
              hits: DataFrame | None = None) -> Merged:
        """Bring in rows with unique, non-null keys.

        ``changes`` says what becomes of a stored row whose key the batch has: one expression per
        changed column, over the stored columns and the batch's row as struct ``_new``. New keys are
        written as they are in the batch, or by ``fresh``. ``hits`` is what ``holding`` gave, if it is known.
        """
        keys = list(self.keys)
        given = stored(batch, "batch")
        if self.version() is None:
            return self.create(self._fresh(given, fresh))
        manifest = stored(self.files(), "manifest")
        asked = given.select(*keys)
        hits = hits if hits is not None else self._holding(asked, manifest)
        touched = {} if not changes else {r["file"]: r["run"] for r in hits.groupBy("file").agg(F.min("run").alias("run")).collect()}
        new_keys = given.join(hits.select(*keys), keys, "left_anti")
        made = None
        if touched:
            made = self._rewrite(given, touched, changes)
        last = manifest.agg(F.max("run")).first()[0]
        last = -1 if last is None else last
        added = self._write_run(self._fresh(new_keys, fresh), last + 1)
        left = manifest.where(~F.col("file").isin(list(touched))) if len(touched) < 200 else manifest.join(
            self.spark.createDataFrame([(f,) for f in touched], "file string"), "file", "left_anti")
        live = left.unionByName(added) if made is None else left.unionByName(made).unionByName(added)
        done = self._publish(live, len(touched), left.count(), added.count())
        folded = self._fold(done.version)
        return done if folded is None else Merged(folded, done.kept, done.rewritten, done.added)

    # ---- writing ----------------------------------------------------------------------------

    def _fresh(self, rows: DataFrame, fresh: Mapping[str, Column] | None) -> DataFrame:
        given = dict(fresh or {})
        return rows.select(*[
            given.get(f.name, F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _new_folder(self) -> str:
        return f"{self.root}/files/{uuid.uuid4().hex}"

    def _write_run(self, rows: DataFrame, run: int) -> DataFrame:
        folder, rows = self._new_folder(), stored(rows, "run")
        parts = max(1, -(-rows.count() // self.rows_per_file))
        tasks = min(parts, max(TASKS, _partitions(self.spark)))
        rows.repartitionByRange(tasks, *self.keys).sortWithinPartitions(*self.keys).write.option(
            "maxRecordsPerFile", 0 if tasks == parts else self.rows_per_file).parquet(folder)
        return self._describe(folder, F.lit(run))

    def _rewrite(self, batch: DataFrame, touched: dict[str, int], changes: Mapping[str, Column]) -> DataFrame:
        """Each touched file with its changed rows, as one file of the same keys."""
        places = self.spark.createDataFrame([(f, i, r) for i, (f, r) in enumerate(sorted(touched.items()))], "file string, _of int, _run int")
        old = self._open(sorted(touched)).withColumn("file", F.col("_metadata.file_path")).join(F.broadcast(places), "file").drop("file")
        new = batch.select(*self.keys, F.struct(*batch.columns).alias("_new"))
        there = F.col("_new").isNotNull()
        out = old.join(new, list(self.keys), "left").select("_of", "_run", *[
            F.when(there, changes[f.name]).otherwise(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) if f.name in changes else F.col(f"`{f.name}`")
            for f in self.schema.fields])
        folder = self._new_folder()
        tasks = min(len(touched), max(TASKS, _partitions(self.spark)))
        out.repartition(tasks, "_run", "_of").sortWithinPartitions("_run", "_of", *self.keys).write.partitionBy("_run", "_of").parquet(folder)
        return self._describe(folder, F.regexp_extract(F.col("_metadata.file_path"), r"/_run=(\d+)/", 1).cast("int"))

    def _describe(self, folder: str, run: Column) -> DataFrame:
        """Manifest rows of new files; their filters are written beside."""
        keys = list(self.keys)
        rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(folder)
        named = rows.select(F.col("_metadata.file_path").alias("file"), run.alias("run"), *keys)
        key = F.struct(*keys)
        made = stored(named.groupBy("file", "run").agg(
            F.min(key).alias("least"), F.max(key).alias("greatest"), F.count(F.lit(1)).alias("rows")).withColumn(
                "blocks", F.ceil(F.col("rows") * BITS_PER_KEY / BLOCK_BITS).cast("int")), "manifest")
        # Rows carry a number in place of their file's path.
        numbers = stored(made.select("file", "blocks", F.monotonically_increasing_id().alias("no")), "numbers")
        marked = named.join(F.broadcast(numbers), "file").select("no", _block(keys), *_marks(keys))
        each = marked.groupBy("no", "block").agg(F.array(*[F.expr(f"bitmap_construct_agg(mark_{i})") for i in range(MARKS)]).alias("bits"))
        (each.select("no", "block", F.explode("bits").alias("bits")).groupBy("no", "block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
            .join(F.broadcast(numbers), "no").select("file", "block", "bits").write.parquet(f"{self.root}/filters/{folder.rsplit('/', 1)[1]}"))
        return made.withColumn("filter", F.lit(folder.rsplit("/", 1)[1]))

    def _publish(self, live: DataFrame, rewritten: int, kept: int, added: int) -> Merged:
        version = (snapshots.current_version(self.spark, self.root) or 0) + 1
        live.write.mode("overwrite").parquet(f"{snapshots.version_path(self.root, version)}/manifest")
        snapshots.publish(self.spark, self.root, version)
        return Merged(version, kept, rewritten, added)

    def _fold(self, version: int) -> int | None:
        """Make one run of the latest runs while they are of similar size; the version that has it."""
        manifest = self._manifest(version)
        sizes = [(r["run"], r["n"]) for r in manifest.groupBy("run").agg(F.sum("rows").alias("n")).orderBy(F.desc("run")).collect()]
        take, total = [], 0
        for run, n in sizes:
            if take and n > FOLD * total:
                break
            take.append(run)
            total += n
        if len(take) < 2:
            return None
        names = [r["file"] for r in manifest.where(F.col("run").isin(take)).select("file").collect()]
        made = self._write_run(self._open(names), min(take))
        left = manifest.where(~F.col("run").isin(take))
        return self._publish(left.unionByName(made), len(names), left.count(), made.count()).version

    # ---- finding ----------------------------------------------------------------------------

    def _holding(self, asked: DataFrame, manifest: DataFrame) -> DataFrame:
        """(keys, file, run) of the asked keys that are stored, and where."""
        keys = list(self.keys)
        if asked.count() > LARGE * (manifest.agg(F.sum("rows")).first()[0] or 0):
            likely, names = asked.select(*keys), [r["file"] for r in manifest.select("file").collect()]
        else:
            likely = stored(self._filtered(self._located(asked, manifest), manifest), "likely")
            names = [r["file"] for r in likely.select("file").distinct().collect()]
        if not names:
            return asked.select(*keys, F.lit("").alias("file"), F.lit(0).alias("run")).limit(0)
        # A key is in one file at most, so that rows need not carry their paths to be compared.
        numbers = self.spark.createDataFrame(list(enumerate(names)), "no int, file string").join(manifest.select("file", "run"), "file")
        there = self._open(names).select(*keys, F.col("_metadata.file_path").alias("file")).join(F.broadcast(numbers), "file").select(*keys, "no")
        hits = there.join(likely.select(*keys), keys, "left_semi")
        return stored(hits.join(F.broadcast(numbers), "no").select(*keys, "file", "run"), "hits")

    def _located(self, asked: DataFrame, manifest: DataFrame) -> DataFrame:
        """(run, keys, file, blocks, filter): the one file of each run whose range has the key.

        Keys and the files' least keys are sorted together; a key's file is the last one before it. Where
        a partition starts inside a file's range, that file is the last one of an earlier partition.
        """
        runs = [r["run"] for r in manifest.select("run").distinct().collect()]
        if not runs:
            return asked.select(F.lit(0).alias("run"), *self.keys, F.lit("").alias("file"), F.lit(1).alias("blocks"), F.lit("").alias("filter")).limit(0)
        ref = F.struct("file", "greatest", "blocks", "filter")
        files = manifest.select("run", F.col("least").alias("k"), F.lit(0).alias("side"), ref.alias("ref"))
        wanted = asked.select(F.explode(F.array(*[F.lit(r) for r in runs])).alias("run"), F.struct(*self.keys).alias("k"), F.lit(1).alias("side"))
        rows = files.unionByName(wanted, allowMissingColumns=True)
        order = ["run", "k", "side"]
        placed = durable(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
        inside = Window.partitionBy("part", "run").orderBy("k", "side").rowsBetween(Window.unboundedPreceding, 0)
        ends = placed.groupBy("run", "part").agg(F.max_by("ref", F.when(F.col("side") == 0, F.col("k"))).alias("end"))
        before = Window.partitionBy("run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        # One row per partition and run.
        carried = ends.select("run", "part", F.last("end", ignorenulls=True).over(before).alias("carried"))
        found = placed.withColumn("here", F.last("ref", ignorenulls=True).over(inside)).where("side = 1").join(carried, ["run", "part"])
        found = found.withColumn("ref", F.coalesce("here", "carried")).where(F.col("ref").isNotNull() & (F.col("k") <= F.col("ref.greatest")))
        return found.select("run", "k.*", "ref.file", "ref.blocks", "ref.filter")

    def _filtered(self, located: DataFrame, manifest: DataFrame) -> DataFrame:
        """Of the located keys those whose file's filter has all their marks."""
        keys = list(self.keys)
        folders = [r["filter"] for r in manifest.select("filter").distinct().collect()]
        filters = self.spark.read.parquet(*[f"{self.root}/filters/{f}" for f in folders]) if folders else None
        if filters is None:
            return located.limit(0)
        met = located.select("run", *keys, "file", _block(keys), *_marks(keys)).join(filters, ["file", "block"])
        for i in range(MARKS):
            met = met.where(has_bit(F.col("bits"), F.col(f"mark_{i}")))
        return met.select("run", *keys, "file")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _block(keys: Sequence[str]) -> Column:
    """The filter block of a row's key, in a file of ``blocks``."""
    return F.pmod(F.xxhash64(*keys), F.col("blocks")).cast("int").alias("block")


def _marks(keys: Sequence[str]) -> list[Column]:
    """The marks of a row's key in its block."""
    return [F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(BLOCK_BITS)).alias(f"mark_{i}") for i in range(MARKS)]


def has_bit(bits: Column, at: Column) -> Column:
    """Whether a bit is set; bits count from the low end of each byte."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
