"""Exact substring deduplication with a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if a stretch of ``length`` bytes that covers it also starts earlier in the corpus (at a
smaller id, or before in the same text). Equal stretches are neighbours once suffixes are sorted. The
sort moves as little text as it can:

1. *Which suffixes can repeat.* Every stretch has a marker, its 24-byte gram of least hash; equal
   stretches have equal markers. Consecutive starts with one marker are a run (some 40 bytes long on
   average). The marker hashes alone are exchanged; a run whose marker is nowhere else cannot repeat
   and is left out, as in prefix doubling.
2. *Sorted runs.* A task cuts out the suffix of each remaining run, from its first start to the end of
   its last stretch, sorts its suffixes behind their markers, keeps the earliest of equal ones, and
   writes them front-coded: the length of the prefix shared with the one before, and the rest.
3. *Merge.* A reducer merges the sorted pieces with a loser tree. Each waiting suffix carries the length of
   the prefix it shares with the last one put out, so a comparison starts where the last one ended.
   Equal suffixes settle a whole run. Where different suffixes have a marker in common, the stretches
   of that small group are sorted, and equal neighbours settle the rest.
4. A marker with more than ``hot`` starts is dealt out by its suffixes' content, and its open stretches go
   through a second exchange and merge, dealt out by their own content.

Only hashes, front-coded suffixes and intervals are moved; reducers hold one piece per task and one
marker's group at a time.

Nulls and edges: a null text is empty. A row with a null id has no place in the order: it is returned
whole and is nobody's earlier place. Rows that repeat an id with the same text are one document, each
returned; with different texts they are ordered by a hash of the text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.text import blocks, mix, plain, raw
from recordlake.session import stored

BLOCK = 8 << 20
CHUNK = 1 << 18
#: Starts in a run at most; a longer run, of text that repeats itself, is cut into several.
RUN_STARTS = 1024
#: Starts with one marker that a reducer may hold at once.
HOT = 1 << 17
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


# ---- markers and runs -------------------------------------------------------------------------


def _grams(wide: np.ndarray, at: np.ndarray | slice, words: int) -> np.ndarray:
    """Hashes of the grams of 8 * words bytes at the places."""
    if isinstance(at, slice):
        parts = [wide[at.start + 8 * j:at.stop + 8 * j] for j in range(words)]
    else:
        parts = [wide[at + 8 * j] for j in range(words)]
    h = parts[0] * ODD[0]
    for j in range(1, words):
        h ^= h >> np.uint64(31)
        h = (h + parts[j]) * ODD[j % 3]
    h ^= h >> np.uint64(29)
    h *= ODD[1]
    h ^= h >> np.uint64(32)
    return h


def runs_of(body: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts with one marker: text, first start in it, number of starts, marker hash, own repeat.

    Neighbouring runs with equal markers are one run, which may repeat within itself.
    """
    words = max(1, min(3, length // 32))
    span = length - 8 * words + 1  # grams of a stretch
    n = len(body) - length + 1
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, bool))
    if n <= 0:
        return none
    padded = np.concatenate([body, np.zeros(8 * words + 8, np.uint8)])
    wide = np.ndarray(len(padded) - 7, "<u8", padded.data, strides=(1,))
    ends = at[1:] - length
    fits = ends >= at[:-1]
    steps = np.zeros(len(body) + 1, np.int8)
    np.add.at(steps, at[:-1][fits], 1)
    np.add.at(steps, ends[fits] + 1, -1)
    valid = np.cumsum(steps[:n], dtype=np.int8).astype(bool)
    place = np.empty(n, np.int32)
    low = np.uint64((1 << 20) - 1)
    for c in range(0, n, CHUNK):
        e = min(c + CHUNK, n)
        key = _grams(wide, slice(c, e + span - 1), words) & ~low
        key |= np.arange(len(key), dtype=np.uint64)
        reach = 1
        while 2 * reach <= span:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        if reach < span:
            key = np.minimum(key[:-(span - reach)], key[span - reach:])
        place[c:e] = (key & low).astype(np.int32) + c
    first = valid.copy()
    first[1:] &= ~(valid[:-1] & (place[1:] == place[:-1]))
    starts = np.flatnonzero(first)
    if not len(starts):
        return none
    doc = np.searchsorted(at, starts, side="right") - 1
    last = np.minimum(np.append(starts[1:], n) - 1, at[doc + 1] - length)
    # Least hashes crowd at the low end; hashed once more they spread evenly over the buckets.
    marker = mix(_grams(wide, place[starts].astype(np.int64), words))
    joins = np.zeros(len(starts), bool)
    joins[1:] = (marker[1:] == marker[:-1]) & (doc[1:] == doc[:-1]) & (starts[1:] == last[:-1] + 1)
    head = np.flatnonzero(~joins)
    tail = np.append(head[1:], len(starts)) - 1
    own = tail > head
    n = last[tail] - starts[head] + 1
    parts = -(-n // RUN_STARTS)
    of = np.repeat(np.arange(len(head)), parts)
    skip = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * RUN_STARTS
    doc = doc[head][of]
    return doc, starts[head][of] - at[doc] + skip, np.minimum(RUN_STARTS, n[of] - skip), marker[head][of], own[of]


RUN = np.dtype([("marker", "<u8"), ("lo", "<u4"), ("n", "<u2"), ("flags", "<u2")])
_MARKS = "bucket int, ids binary, marks binary, each binary, markers binary, lo binary, n binary"


def _planes(values: np.ndarray) -> bytes:
    """The bytes of small numbers, lowest bytes first and highest last: long equal stretches compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _mark(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK):
            block = block.filter(block.column("doc_id").is_valid())
            body, at = raw(plain(block.column("text")))
            doc, lo, n, marker, own = runs_of(body, at, length)
            bucket = (((marker >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # within a bucket by document and place
            doc, lo, marker, bucket = doc[order], lo[order].astype(np.uint32), marker[order], bucket[order]
            n = (n[order] | own[order].astype(np.int64) << 15).astype(np.uint16)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            ids, marks = block.column("doc_id").to_numpy(), block.column("mark").to_numpy()
            rows = []
            for b in range(buckets):
                if cuts[b] < cuts[b + 1]:
                    part = slice(cuts[b], cuts[b + 1])
                    who, each = np.unique(doc[part], return_counts=True)
                    rows.append((b, _planes(ids[who]), marks[who].tobytes(), _planes(each.astype(np.uint32)), marker[part].tobytes(), _planes(lo[part]), _planes(n[part])))
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]], [c.split()[0] for c in _MARKS.split(", ")])

    return run


def _repeated(hot: int):
    """Of a hash range, the runs whose marker is there more than once, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns[1:]))]
        if not blobs:
            return
        sizes = np.concatenate([_from_planes(b[5], np.uint16) for b in blobs])
        own, sizes = sizes >> 15, sizes & np.uint16((1 << 15) - 1)
        _, where, counts = np.unique(np.concatenate([np.frombuffer(b[3], np.uint64) for b in blobs]), return_inverse=True, return_counts=True)
        flags = own | np.where(np.bincount(where, weights=sizes)[where] > hot, 2, 0).astype(np.uint16)
        keep, position = (counts[where] > 1) | (own > 0), 0
        for ids, marks, each, markers, lo, n in blobs:
            part = slice(position, position + len(n) // 2)
            position = part.stop
            ok = keep[part]
            runs = np.empty(int(ok.sum()), RUN)
            runs["marker"], runs["lo"] = np.frombuffer(markers, np.uint64)[ok], _from_planes(lo, np.uint32)[ok]
            runs["n"], runs["flags"] = sizes[part][ok], flags[part][ok]
            each = _from_planes(each, np.uint32)
            ref = np.repeat(np.arange(len(each)), each)[ok]
            who, first = np.unique(ref, return_index=True)
            stop = np.append(first[1:], len(ref))
            ids, marks = _from_planes(ids, np.int64), np.frombuffer(marks, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[who]), pa.array(marks[who]), pa.array([runs[a:b].tobytes() for a, b in zip(first, stop)], pa.binary())],
                ["doc_id", "mark", "runs"])

    return run


# ---- front-coded sorted pieces and their merge ------------------------------------------------


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    x, y = a[start:n], b[start:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


PLACE = np.dtype([("doc_id", "<i8"), ("mark", "<i8"), ("lo", "<u4"), ("n", "<u4"), ("flags", "<u4")])


def front_code(items: list[tuple[bytes, tuple]]) -> tuple[bytes, bytes, bytes, bytes]:
    """Sorted (string, place) items as prefix lengths, rest lengths, rests and places."""
    prefix, rest, before = [], [], b""
    for text, _ in items:
        k = shared(before, text)
        prefix.append(k)
        rest.append(text[k:])
        before = text
    return (_planes(np.array(prefix, np.uint32)), _planes(np.array([len(r) for r in rest], np.uint32)),
            zstandard.ZstdCompressor(level=3).compress(b"".join(rest)), np.array([p for _, p in items], PLACE).tobytes())


def unfold(blob: tuple[bytes, bytes, bytes, bytes]) -> Iterator[tuple[int, bytes, tuple]]:
    """(prefix shared with the one before, string, place) of a front-coded piece."""
    prefix, sizes, body, places = blob
    at, before, body = 0, b"", _unpack(body)
    for k, size, place in zip(_from_planes(prefix, np.uint32).tolist(), _from_planes(sizes, np.uint32).tolist(), np.frombuffer(places, PLACE).tolist()):
        before = before[:k] + body[at:at + size]
        at += size
        yield k, before, place


class LoserTree:
    """Merges front-coded sorted pieces; gives (prefix shared with the one before, string, place).

    ``common[i]`` is the prefix that the string waiting in piece i shares with the last winner that
    passed its node. Of two strings above the same winner the one that shares more with it is smaller;
    only at equal lengths are bytes compared, from there on.
    """

    def __init__(self, pieces: list[Iterator[tuple[int, bytes, tuple]]]):
        self.size = 1
        while self.size < len(pieces):
            self.size *= 2
        self.pieces = pieces + [iter(())] * (self.size - len(pieces))
        self.now: list[tuple[bytes, tuple] | None] = []
        self.common = [0] * self.size
        for piece in self.pieces:
            head = next(piece, None)
            self.now.append(head and head[1:])
        self.loser = [0] * self.size
        self.top = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, self.loser[node] = self._play(a, b)
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        if self.now[a] is None or self.now[b] is None:
            return (b, a) if self.now[a] is None else (a, b)
        x, y = self.common[a], self.common[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        s, t = self.now[a][0], self.now[b][0]
        k = shared(s, t, x)
        a_first = k == len(s) or (k < len(t) and s[k] < t[k])
        winner, loser = (a, b) if a_first else (b, a)
        self.common[loser] = k
        return winner, loser

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        while self.now[self.top] is not None:
            w = self.top
            yield self.common[w], *self.now[w]
            head = next(self.pieces[w], None)
            self.now[w], self.common[w] = (head[1:], head[0]) if head else (None, 0)
            node = (w + self.size) // 2
            while node:
                w, self.loser[node] = self._play(w, self.loser[node])
                node //= 2
            self.top = w


_RUNS = "kind string, bucket int, doc_id long, mark long, lo long, hi long, prefix binary, sizes binary, body binary, places binary"


def _rows(intervals: list[tuple[int, int, int, int]], pieces: list[tuple], buckets: int = 1) -> pa.RecordBatch:
    """Intervals that go, (doc_id, mark, lo, hi), and front-coded pieces, (bucket, blob), as one batch."""
    n, m = len(intervals), len(pieces)
    d, k, lo, hi = zip(*intervals) if n else ((), (), (), ())
    blobs = list(zip(*(blob for _, blob in pieces))) if m else [()] * 4
    kinds = pa.array(["gone"] * n + ["piece"] * m)
    columns = [kinds, pa.array([i % buckets for i in range(n)] + [b for b, _ in pieces], pa.int32())]
    columns += [pa.array([*c, *[None] * m], pa.int64()) for c in (d, k, lo, hi)]
    columns += [pa.array([*[None] * n, *c], pa.binary()) for c in blobs]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _RUNS.split(", ")])


def _joined(intervals: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Intervals of a document that meet are one."""
    out: list[tuple[int, int, int, int]] = []
    for d, k, lo, hi in sorted(intervals):
        if out and out[-1][:2] == (d, k) and lo <= out[-1][3]:
            out[-1] = (d, k, out[-1][2], max(hi, out[-1][3]))
        else:
            out.append((d, k, lo, hi))
    return out


def _settle(same: list[tuple], length: int) -> tuple[tuple, list[tuple[int, int, int, int]]]:
    """Of the places of one string: the earliest, and the intervals of all later ones."""
    first = min(same, key=lambda p: p[:3])
    gone = [(p[0], p[1], p[2], p[2] + p[3] - 1 + length) for p in same if p[:3] > first[:3]]
    flags = 0
    for p in same:
        flags |= p[4]
    return (*first[:4], flags), gone


def _cut_out(length: int, buckets: int):
    """Per task: the suffixes of the runs, sorted, equal ones settled, front-coded by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "packed", BLOCK // 2):
            items = []
            for doc_id, mark, packed, lists in zip(*(block.column(c).to_pylist() for c in ("doc_id", "mark", "packed", "runs"))):
                body = _unpack(packed)
                for marker, lo, n, flags in (r for part in lists for r in np.frombuffer(part, RUN).tolist()):
                    items.append((marker.to_bytes(8, "big") + body[lo:lo + n - 1 + length], (doc_id, mark, lo, n, flags)))
            items.sort()
            gone, kept = [], []
            for text, group in groupby(items, key=lambda x: x[0]):
                first, later = _settle([p for _, p in group], length)
                gone += later
                kept.append((text, first))
            yield _rows(_joined(gone), _pieces(kept, buckets, hot=lambda text, p: p[4] & 2), buckets)

    return run


def _pieces(items: list[tuple[bytes, tuple]], buckets: int, hot) -> list[tuple]:
    """Sorted items dealt out by their first bytes; hot ones, which share these, by all of them."""
    dealt: dict[int, list] = {}
    for text, place in items:
        bucket = zlib.crc32(text) * buckets >> 32 if hot(text, place) else int.from_bytes(text[:4], "big") * buckets >> 32
        dealt.setdefault(bucket, []).append((text, place))
    return [(b, front_code(part)) for b, part in dealt.items()]


def _merge(length: int, buckets: int, final: bool):
    """All pieces of a bucket through a loser tree. In the final merge strings are single stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = []
        for batch in batches:
            piece = batch.column("prefix").is_valid()
            settled = batch.filter(pc.invert(piece))
            if settled.num_rows:  # intervals of the step before pass through
                yield settled
            batch = batch.filter(piece)
            blobs += zip(*(batch.column(c).to_pylist() for c in ("prefix", "sizes", "body", "places")))
        if not blobs:
            return
        gone: list[tuple[int, int, int, int]] = []
        open_: list[tuple[bytes, tuple]] = []
        group: list[tuple[bytes, tuple]] = []  # distinct suffixes with one marker
        text, same = None, []

        def settle() -> None:
            first, later = _settle(same, length)
            gone.extend(later)
            if first[4] & 2:
                open_.extend(_stretches(text, first, length, gone))
            elif not final:
                group.append((text, first))

        def close() -> None:
            if len(group) > 1 or (group and group[0][1][4] & 1):
                every = sorted(x for suffix, p in group for x in _stretches(suffix, p, length, gone))
                for _, equal in groupby(every, key=lambda x: x[0]):
                    gone.extend(_settle([p for _, p in equal], length)[1])
            group.clear()

        for k, suffix, place in LoserTree([unfold(b) for b in blobs]):
            if text is not None and k == len(text) == len(suffix):
                same.append(place)
                continue
            if text is not None:
                settle()
                if k < 8:
                    close()
            text, same = suffix, [place]
            if len(gone) > 20_000:
                yield _rows(_joined(gone), [])
                gone.clear()
            if len(open_) > 100_000:
                yield _rows([], _pieces(_earliest(open_, gone, length), buckets, hot=lambda *_: True))
                open_.clear()
        settle()
        close()
        pieces = _pieces(_earliest(open_, gone, length), buckets, hot=lambda *_: True)
        yield _rows(_joined(gone), pieces)

    return run


def _stretches(suffix: bytes, place: tuple, length: int, gone: list) -> list[tuple[bytes, tuple]]:
    """The single stretches of a run's suffix, without its marker; repeats inside the run go at once."""
    doc_id, mark, lo, n, _ = place
    first: dict[bytes, int] = {}
    for i in range(n):
        if first.setdefault(suffix[8 + i:8 + i + length], i) != i:
            gone.append((doc_id, mark, lo + i, lo + i + length))
    return [(text, (doc_id, mark, lo + i, 1, 0)) for text, i in first.items()]


def _earliest(items: list[tuple[bytes, tuple]], gone: list, length: int) -> list[tuple[bytes, tuple]]:
    out = []
    for text, equal in groupby(sorted(items), key=lambda x: x[0]):
        first, later = _settle([p for _, p in equal], length)
        gone.extend(later)
        out.append((text, first))
    return out


# ---- the operator -----------------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, which is how they are moved."""
    pack = zstandard.ZstdCompressor(level=3)
    for block in blocks(batches):
        packed = pa.array([pack.compress((t or "").encode()) for t in block.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("mark"), packed], ["doc_id", "mark", "packed"])


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "packed", BLOCK // 2):
        size, removed, spans, digest, kept = [], [], [], [], []
        for packed, gone in zip(block.column("packed").to_pylist(), block.column("gone").to_pylist()):
            body = _unpack(packed)
            merged: list[list[int]] = []
            for lo, hi in sorted((g["lo"], g["hi"]) for g in gone or ()):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            left, at = [], 0
            for lo, hi in merged:
                left.append(body[at:lo])
                at = hi
            rest = b"".join([*left, body[at:]])
            size.append(len(body))
            removed.append(len(body) - len(rest))
            spans.append(len(merged))
            digest.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def drop_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and ``kept``, the bytes that stay."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("mark"), F.col(text).alias("text"))
    packed = rows.mapInArrow(_pack, "doc_id long, mark long, packed binary")

    def sorted_pieces() -> DataFrame:
        repeated = (
            rows.mapInArrow(_mark(length, buckets), _MARKS).repartitionById(buckets, F.col("bucket"))
            .mapInArrow(_repeated(hot), "doc_id long, mark long, runs binary")
            .groupBy("doc_id", "mark").agg(F.collect_list("runs").alias("runs"))
        )
        found = packed.join(repeated, ["doc_id", "mark"]).select("doc_id", "mark", "packed", "runs")
        return found.mapInArrow(_cut_out(length, buckets), _RUNS)

    def merged(found: DataFrame, final: bool) -> DataFrame:
        return stored(found.repartitionById(buckets, F.col("bucket")).mapInArrow(_merge(length, buckets, final), _RUNS), "merged")

    gone = merged(sorted_pieces(), False)
    if not gone.where("kind = 'piece'").isEmpty():
        gone = gone.where("kind = 'gone'").unionByName(merged(gone.where("kind = 'piece'"), True))
    gone = gone.where("kind = 'gone'").groupBy("doc_id", "mark").agg(F.collect_list(F.struct("lo", "hi")).alias("gone"))
    return packed.join(gone, ["doc_id", "mark"], "left").select("doc_id", "packed", "gone").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("doc_id", key)
