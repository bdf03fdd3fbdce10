"""Arrow and numpy helpers that run inside tasks: words, hashes, blocks of a partition.

Words are runs of bytes other than space and 0x09-0x0D, as ``ascii_split_whitespace`` cuts them.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 16 << 20
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True


def widened(docs: DataFrame, added: dict[str, str]) -> tuple[DataFrame, T.StructType]:
    """The frame without columns of the added names, and its schema with them at the end."""
    rest = docs.drop(*added)
    extra = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in added.items()))
    return rest, T.StructType([*rest.schema.fields, *extra.fields])


def plain(values: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array with 64-bit offsets from zero on, nulls read as empty texts.

    A slice without nulls keeps the offsets it had in the whole array when it is cast, and
    ``ascii_lower`` then reads other bytes; such an array is written anew.
    """
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.fill_null(values.cast(pa.large_string()), "")
    if len(values) and np.frombuffer(values.buffers()[1], np.int64, 1, 8 * values.offset)[0]:
        body, at = raw(values)
        values = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at)), pa.py_buffer(body)])
    return values


def release() -> None:
    """Give memory that this worker no longer uses back to the machine: workers are used again, and what
    the pools keep would stand beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc():
    try:
        found = ctypes.CDLL("libc.so.6")
        return found if hasattr(found, "malloc_trim") else None
    except OSError:  # another C library
        return None


_LIBC = _libc()


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of the column, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes.astype(np.int64)), 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts as one array, and the offsets of the texts in it."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


def words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and the offsets of the texts among them."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    full = pc.greater(pc.binary_length(flat), 0)
    keep = full.to_numpy(zero_copy_only=False).astype(np.int64)
    if keep.all():
        return flat, at
    before = np.concatenate([[0], np.cumsum(keep)])
    return flat.filter(full), before[at]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_strings(values: pa.Array, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each string: eight bytes at a time over all strings at once."""
    body, at = raw(values)
    sizes = np.diff(at)
    body = np.concatenate([body, np.zeros(8, np.uint8)])
    wide = np.ndarray(len(body) - 7, dtype="<u8", buffer=body.data, strides=(1,))
    out = mix(sizes.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    live, step = np.flatnonzero(sizes), 0
    while len(live):
        left = sizes[live] - step
        chunk = wide[at[live] + step]
        short = np.minimum(left, 8).astype(np.uint64)
        chunk = np.where(short < 8, chunk & ((np.uint64(1) << (short * np.uint64(8) % np.uint64(64))) - np.uint64(1)), chunk)
        out[live] = mix(out[live] ^ mix(chunk + np.uint64(0x9E3779B97F4A7C15)))
        live, step = live[left > 8], step + 8
    return out


def word_hashes(flat: pa.Array, seed: int = 1) -> np.ndarray:
    """The hash of each word; equal words are hashed once."""
    coded = flat.dictionary_encode()
    return hash_strings(plain(coded.dictionary), seed)[coded.indices.to_numpy()]


def shingles(hashes: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words in each text, repeats included, and the texts' offsets.

    A text with fewer words has its whole sequence as its only run; without words it has none.
    """
    n, counts = len(hashes), np.diff(at)
    rolled = np.zeros(n, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    last = at[1:][owner] - 1
    where = np.arange(n)
    for j in range(width):
        reach = where + j
        inside = reach <= last
        rolled = np.where(inside, mix(rolled + hashes[np.minimum(reach, max(n - 1, 0))] + np.uint64(0x9E3779B97F4A7C15)), rolled)
    place = where - at[:-1][owner]
    keep = (place + width <= counts[owner]) | ((place == 0) & (counts[owner] < width))
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    return rolled[keep], np.concatenate([[0], np.cumsum(sizes)])


def crc_of_id(doc_id) -> int:
    """CRC-32 of the id as decimal text."""
    return zlib.crc32(str(doc_id).encode())
