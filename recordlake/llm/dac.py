"""Token ids as directly addressable codes.

Each id is split into chunks of eight bits, lowest first. Level 0 holds the first chunk of every id,
level 1 the second chunk of the ids that have one, and so on. A bitmap per level says which ids go
on; a directory of set bits before each block of 512 gives their rank, so that any id is found with
one rank per level, without decoding its neighbours.

Corpus layout: documents in ascending key order, cut into segments of whole documents. A segment is
one binary value that holds the keys, the documents' offsets and the coded ids; segments are rows of a
Parquet table, so any store that Spark writes to will do.

Nulls and edges: a null text is an empty one; a null key stands before all others; rows that repeat a
key stand together, in order of their texts, and are dealt by the texts' first characters. A long text is one
segment of its own. A position outside the corpus has a null id. Other columns are ignored. No documents
give no segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.llm.text import blocks, plain, release
from recordlake.llm.tokens import token_ids
from recordlake.session import stored

RANK_BLOCK = 512
SEGMENT_BYTES = 2 << 20
MAGIC = b"DAC1"


def encode(ids: np.ndarray) -> bytes:
    """Levels of chunks, bitmaps and rank directories for an array of unsigned 32-bit ids."""
    left = np.asarray(ids, np.uint32)
    levels = []
    while True:
        more = left > 0xFF
        bits = np.packbits(more, bitorder="little")
        padded = np.concatenate([more, np.zeros(-len(more) % RANK_BLOCK, bool)]).reshape(-1, RANK_BLOCK)
        ranks = np.concatenate([[0], np.cumsum(padded.sum(axis=1))]).astype(np.uint32)
        levels.append(b"".join([struct.pack("<Q", len(left)), (left & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]))
        left = left[more] >> 8
        if not len(left):
            return struct.pack("<B", len(levels)) + b"".join(levels)


class Codes:
    """Reads coded ids: one id, a range, or all."""

    def __init__(self, data: bytes | memoryview):
        self.levels, at = [], 1
        for _ in range(data[0]):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            bits = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += len(bits)
            ranks = np.frombuffer(data, "<u4", -(-n // RANK_BLOCK) + 1, at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))
        self.size = at

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // RANK_BLOCK
            inside = np.unpackbits(bits[block * RANK_BLOCK // 8:(i >> 3) + 1], bitorder="little")[:i - block * RANK_BLOCK]
            i, shift = int(ranks[block]) + int(inside.sum()), shift + 8
        return value

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at some places: one rank a level each, by the directory and at most one block of bits."""
        out, live, i = np.zeros(len(places), np.uint32), np.arange(len(places)), np.asarray(places, np.int64)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[live] |= chunks[i].astype(np.uint32) << np.uint32(8 * k)
            on = bits[i >> 3] >> (i & 7).astype(np.uint8) & 1 > 0
            live, i = live[on], i[on]
            block, byte = i // RANK_BLOCK, i >> 3
            near = block[:, None] * (RANK_BLOCK // 8) + np.arange(RANK_BLOCK // 8)
            whole = np.where(near < byte[:, None], bits[np.minimum(near, max(len(bits) - 1, 0))], 0)
            part = bits[byte] & ((1 << (i & 7)) - 1).astype(np.uint8)
            i = ranks[block].astype(np.int64) + np.bitwise_count(whole).sum(axis=1, dtype=np.int64) + np.bitwise_count(part)
        return out

    def all(self) -> np.ndarray:
        out = self.levels[0][0].astype(np.uint32)
        where = np.arange(len(out))
        for k in range(1, len(self.levels)):
            chunks, bits, _ = self.levels[k - 1]
            where = where[np.unpackbits(bits, bitorder="little", count=len(chunks)).astype(bool)]
            out[where] |= self.levels[k][0].astype(np.uint32) << np.uint32(8 * k)
        return out


def pack_segment(keys: np.ndarray, known: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    head = MAGIC + struct.pack("<Q", len(keys))
    return b"".join([head, keys.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(), offsets.astype("<u8").tobytes(), encode(ids)])


def open_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, Codes]:
    """Keys, whether each is known, document offsets, and the reader of the ids."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment of coded ids")
    (n,) = struct.unpack_from("<Q", data, 4)
    at = 12
    keys = np.frombuffer(data, "<i8", n, at)
    known = np.frombuffer(data, np.uint8, n, at + 8 * n).astype(bool)
    offsets = np.frombuffer(data, "<u8", n + 1, at + 9 * n).astype(np.int64)
    return keys, known, offsets, Codes(memoryview(data)[at + 9 * n + 8 * (n + 1):])


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the segments in ascending key order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ahead = TaskContext.get().partitionId(), 0, 0
        for block in blocks(batches, limit=SEGMENT_BYTES):
            ids, at = token_ids(plain(block.column("text")), tokenizer)
            # One end id after each document.
            full = np.insert(ids, at[1:], np.uint32(end_id))
            at = at + np.arange(len(at))
            keys = block.column("key")
            data = pack_segment(keys.fill_null(0).to_numpy(), keys.is_valid().to_numpy(zero_copy_only=False), at, full)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([ahead], pa.int64()), pa.array([len(full)], pa.int64()), pa.array([data], pa.binary())],
                ["part", "seg", "ahead", "n_ids", "data"])
            number, ahead = number + 1, ahead + len(full)
            del ids, full, data
            release()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    (rows.repartitionByRange("key", F.substring("text", 1, 64)).sortWithinPartitions("key", "text")
        .mapInArrow(run, "part int, seg int, ahead long, n_ids long, data binary").write.parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the written segments: key, ``start``, ``n_tokens``, ``ids_crc32``."""
    segments = _placed(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column("start").to_pylist(), batch.column("data")):
                keys, known, at, codes = open_segment(data.as_py())
                body = codes.all().astype("<u4").tobytes()
                crcs = [zlib.crc32(body[4 * a:4 * b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64(), mask=~known), pa.array(start + at[:-1]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())],
                    ["key", "start", "n_tokens", "ids_crc32"])

    return segments.select("start", "data").mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The segments with the number of ids before each."""
    segments = spark.read.parquet(path)
    counts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # A segment knows how many ids of its partition stand before it; the partitions' own starts are
    # one row per task of the write, so that the broadcast is bounded and the segments do not move.
    return segments.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("ahead"))


#: Places of the corpus that a position and its segment are brought together by.
STRIDE = 1 << 20


def token_at(spark: SparkSession, path: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """The id at each asked place of the whole corpus: ``position``, ``token``.

    Only segments that hold an asked place are read; within them an id is found through the rank
    directories, without decoding its neighbours.
    """
    asked = positions.select(F.col(position).cast("long").alias("position")).where("position is not null").distinct()
    placed = _placed(spark, path)
    reach = F.sequence(F.floor(F.col("start") / STRIDE), F.floor((F.col("start") + F.col("n_ids") - 1) / STRIDE))
    index = placed.where("n_ids > 0").select("part", "seg", "start", "n_ids", F.explode(reach).alias("stride"))
    found = stored(asked.withColumn("stride", F.floor(F.col("position") / STRIDE)).join(index, "stride").where(
        (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_ids"))).select(
            "part", "seg", "position", (F.col("position") - F.col("start")).alias("place")), "places")
    data = placed.select("part", "seg", "data").join(found.select("part", "seg").distinct(), ["part", "seg"], "left_semi")

    def look(segment: pa.Table, places: pa.Table) -> pa.Table:
        codes = open_segment(segment.column("data")[0].as_py())[3]
        return pa.table({"position": places.column("position"), "token": pa.array(codes.at(places.column("place").to_numpy()), pa.int64())})

    met = data.groupBy("part", "seg").cogroup(found.groupBy("part", "seg")).applyInArrow(look, "position long, token long")
    return positions.select(F.col(position).cast("long").alias("position")).join(met, "position", "left")
