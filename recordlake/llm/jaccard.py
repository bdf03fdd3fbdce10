"""Jaccard self-join on word n-grams by vertical partitioning, and its connected components.

All n-grams are ordered by a 64-bit hash, and that global order is cut into fragments.

* Candidates. Two sets of sizes n <= m with Jaccard at least t differ in at most n (1-t)/t n-grams,
  so of more fragments than that, some are equal in both. Each document gives signatures of
  fragments of its size level (and of the next lower level where a partner may lie there). Of s spare
  fragments more than are needed, s + 1 are equal in both, so each document leaves out its first s in one
  order of all fragments: empty ones, those with the fewest n-grams that are not common, and those with the
  fewest n-grams; texts that are not alike share such most often (a line that many texts have falls apart into them).
  What the two leave out of their equal ones are the first s of them at most, so one stays in both, whatever
  the order. Which n-grams are common is told once, from a sample; it changes the way, not the result.
  Documents with an equal fragment form a group.
* Bounds. Each document carries its n-gram counts in finer cuts of the same order. The sum of two
  documents' count differences never exceeds the number of n-grams they differ in, so most pairs of a
  group are ruled out inside the task that holds it. Of the others only a spanning forest goes on.
* Counting. Those pairs are counted fragment by fragment: each fragment's partial overlap in a task
  of its own, then summed per pair and held against the threshold.

If all edges of a forest are links, the group is settled, since further links would join what is
joined. Groups with an edge that is none are looked at once more: documents that open pairs between
components connect, in whatever groups, come together once with their n-grams, and such pairs are held
against the threshold in the task, of which only a spanning forest of links goes on. So no link between components is lost, and a large group of
near copies does not become all its pairs. Equal sets are one class and are compared once; signatures name the set, by 64
bits of its digest, and not a document. A group of more than
``GROUP_BLOCK`` documents is compared in blocks, each pair of blocks in a task of its own.

Nulls and edges: a text without words, or null, has an empty set and no links. Rows with a null id
come back with a null component. Rows that repeat an id count as one document (the one with the
smaller set digest). Ties do not matter. Extra columns are ignored. 64-bit n-gram hashes stand for
the n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.llm.components import components
from recordlake.llm.text import blocks, mix, plain, release, shingles, word_hashes, words
from recordlake.session import stored

#: Spare fragments: this many at least, and one for so many n-grams that two sets may differ in.
SPARE, SPARE_PER = 3, 4
#: Documents of the sample that tells common n-grams, and the most of them that are told.
SAMPLE, COMMON = 2000, 1 << 16
#: Pairs of one document that are counted in one task.
PER_SALT = 256
#: Bytes of text whose n-grams a task holds at once.
BLOCK = 4 << 20
GROUP_BLOCK = 4096
#: Rows of a tree that others are held against first, from so many rows of a group on.
CENTRES, FEW = 4, 64
#: Bytes of n-grams in a block of a group whose pairs are held against the threshold in its task.
SET_BYTES = 16 << 20
#: N-grams per cut of the count vectors, and the longest vector.
PER_CUT = 3
MOST_CUTS = 1 << 14
ODD = np.uint64(0x9E3779B97F4A7C15)


def levels(largest: int, threshold: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower size bounds of the levels, the number of fragments of each, and how many of them are spare."""
    low = [1]
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, low[-1] * 3 // 2))
    top = np.array([int((b - 1) * (1 - threshold) / threshold) for b in low[1:]])
    spare = np.maximum(top // SPARE_PER, SPARE)
    return np.array(low), np.where(top > 0, top + 1 + spare, 0), spare


def sets_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-gram hashes, ascending in each text; their text; the set size of each text."""
    flat, at = words(texts)
    h, at = shingles(word_hashes(flat), at, width)
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.uint16), np.diff(at))
    by_hash = np.argsort(h)
    h, owner = h[by_hash], owner[by_hash]
    by_owner = np.argsort(owner, kind="stable")
    h, owner = h[by_owner], owner[by_owner]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[fresh], owner[fresh].astype(np.int64)
    return h, owner, np.bincount(owner, minlength=len(at) - 1)


def _fold(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)


def digests(h: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128 bits for each set, independent of order."""
    out = np.zeros((len(sizes), 2), np.uint64)
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    out[some, 0] = mix(_fold(mix(h ^ ODD), starts) + sizes[some].astype(np.uint64))
    out[some, 1] = mix(_fold(mix(h + ODD), starts) + sizes[some].astype(np.uint64))
    return [row.tobytes() for row in out]


def signatures(h: np.ndarray, owner: np.ndarray, sizes: np.ndarray, threshold: Fraction, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each fragment of each document but the spare ones, and the document; ``common`` ascends."""
    low, fragments, spares = levels(int(sizes.max(initial=1)), threshold)
    own = np.searchsorted(low, sizes, side="right") - 1
    lower = np.searchsorted(low, np.ceil(sizes * float(threshold) - 1e-9), side="right") - 1
    sigs, docs = [], []
    rare = ~_among(h, common) if common is not None and len(common) else np.ones(len(h), bool)
    for level, use in ((own, own >= 0), (np.maximum(lower, 0), (lower != own) & (lower >= 0))):
        count = np.where(use & (sizes > 0), fragments[np.maximum(level, 0)], 0)
        live = count[owner] > 0
        if not live.any():
            continue
        x, d = h[live], owner[live]
        f = ((x >> np.uint64(32)) * count[d].astype(np.uint64)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (d[1:] != d[:-1])]))
        f, held, d = f[starts], np.diff(np.append(starts, len(x))), d[starts]
        tag = mix(level[d].astype(np.uint64) * np.uint64(1 << 32) + f + ODD)
        sig = mix(_fold(mix(x + ODD), starts) ^ tag)
        rarer = np.add.reduceat(rare[live].astype(np.int64), starts)
        filled = np.bincount(d, minlength=len(sizes))
        first = np.concatenate([[0], np.cumsum(filled)])
        spare, empty = spares[np.maximum(level, 0)], count - filled
        # The order inside a document, by what is the same for all that share the fragment.
        by_size = np.lexsort((sig, held, rarer, d))
        keep = by_size[np.arange(len(d)) - first[d] >= (spare - empty)[d]]
        sigs.append(sig[keep])
        docs.append(d[keep])
        # Documents with more empty fragments than there are spare ones name some of them as well.
        for i in np.flatnonzero((count > 0) & (empty > spare)):
            gone = np.setdiff1d(np.arange(count[i], dtype=np.uint64), f[first[i]:first[i + 1]])
            sigs.append(np.sort(mix(mix(np.uint64(int(level[i]) << 32) + gone + ODD)))[spare[i]:])
            docs.append(np.full(len(sigs[-1]), i))
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(sigs), np.concatenate(docs)


def _among(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which hashes are in an ascending list; a table of their first bits rules most out."""
    seen = np.zeros(1 << 20, bool)
    seen[(common >> np.uint64(44)).astype(np.int64)] = True
    out = seen[(h >> np.uint64(44)).astype(np.int64)]
    may = np.flatnonzero(out)
    out[may] = common[np.minimum(np.searchsorted(common, h[may]), len(common) - 1)] == h[may]
    return out


def _grams(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in (part for big in blocks(batches, limit=BLOCK) for part in _rows(big, 60_000)):
            h, _, _ = sets_of(plain(block.column("text")), width)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["gram"])
            release()

    return run


def common_grams(rows: DataFrame, width: int) -> np.ndarray:
    """The n-grams that most documents of a sample have, two at least, ascending; at most ``COMMON``."""
    total = rows.count()
    share = min(1.0, SAMPLE / max(total, 1))
    taken = rows.select("text").sample(share, seed=1) if share < 1 else rows.select("text")
    counted = taken.mapInArrow(_grams(width), "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    top = counted.orderBy(F.desc("n"), "gram").limit(COMMON).select("gram").collect()
    return np.sort(np.array([r["gram"] for r in top], np.int64).view(np.uint64))


def count_vectors(h: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """N-grams in each of 2^r equal cuts of the hash order, r by the set's size; at most 255 are told."""
    r = np.ceil(np.log2(np.clip(sizes / PER_CUT, 8, MOST_CUTS))).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(1 << r)])
    cut = (h >> (np.uint64(64) - r[owner].astype(np.uint64))).astype(np.int64)
    counts = np.minimum(np.bincount(first[owner] + cut, minlength=first[-1]), 255).astype(np.uint8)
    return [counts[a:b].tobytes() for a, b in zip(first, first[1:])]


_SPREAD = "bucket int, doc_id long, n long, digest binary, cuts binary, sets binary, counts binary, sigs binary"
_FOUND = "a long, mark long, n long, digest binary, cuts binary"


def set_marks(keys: list[bytes]) -> np.ndarray:
    """The first 64 bits of each digest."""
    return np.frombuffer(b"".join(keys), np.int64)[::2]


def _spread(width: int, threshold: Fraction, buckets: int, common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                            ("cuts", pa.binary()), ("sets", pa.binary()), ("counts", pa.binary()), ("sigs", pa.binary())])
        for block in (part for big in blocks(batches, limit=BLOCK) for part in _rows(big, 60_000)):
            ids = block.column("doc_id")
            h, owner, sizes = sets_of(plain(block.column("text")), width)
            keys = digests(h, sizes)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            marks = set_marks(keys)
            first: dict[bytes, int] = {}
            for i in np.flatnonzero(known & (sizes > 0)):
                first.setdefault(keys[i], i)
            # Within a block, equal sets give their signatures once.
            chosen = np.zeros(len(sizes), bool)
            chosen[list(first.values())] = True
            use = chosen[owner]
            sig, doc = signatures(h[use], owner[use], np.where(chosen, sizes, 0), threshold, common)
            meta = np.arange(len(sizes)) % buckets
            yield pa.RecordBatch.from_arrays(
                [pa.array(meta, pa.int32()), ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(count_vectors(h, owner, sizes), pa.binary()), *[pa.nulls(len(sizes), pa.binary())] * 3], schema=schema)
            bucket = (((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((doc, bucket))
            sig, doc, bucket = sig[order], doc[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for i in range(buckets):
                part = slice(cuts[i], cuts[i + 1])
                if cuts[i] < cuts[i + 1]:
                    who, counts = np.unique(doc[part], return_counts=True)
                    rows.append((i, marks[who].tobytes(), counts.astype(np.uint32).tobytes(), sig[part].tobytes()))
            if rows:
                at, who, counts, sigs = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
                     pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.binary()), pa.array(who, pa.binary()), pa.array(counts, pa.binary()),
                     pa.array(sigs, pa.binary())], schema=schema)
            del h, owner, use, rows
            release()

    return run


def _rows(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, limit):
        yield batch.slice(at, limit)


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents pass through (``mark`` is their set's); equal signatures become members (a: group, mark: set)."""
    schema = pa.schema([("a", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("cuts", pa.binary())])
    sigs, sets = [], []
    for batch in batches:
        meta = batch.filter(batch.column("sigs").is_null())
        if meta.num_rows:
            yield pa.RecordBatch.from_arrays(
                [meta.column("doc_id"), pa.array(set_marks(meta.column("digest").to_pylist())), meta.column("n"), meta.column("digest"), meta.column("cuts")], schema=schema)
        for d, c, s in zip(*(batch.filter(batch.column("sigs").is_valid()).column(n).to_pylist() for n in ("sets", "counts", "sigs"))):
            sets.append(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, np.uint32)))
            sigs.append(np.frombuffer(s, np.uint64))
    if not sigs:
        return
    sig, mark = np.concatenate(sigs), np.concatenate(sets)
    sigs.clear(), sets.clear()
    order = np.lexsort((mark, sig))
    sig, mark = sig[order], mark[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (mark[1:] != mark[:-1])
    sig, mark = sig[fresh], mark[fresh]
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    counts = np.diff(np.append(starts, len(sig)))
    # Groups with the same members are one group: its name is a hash of the members.
    name = mix(np.add.reduceat(mix(mark.astype(np.uint64) + ODD), starts) + counts.astype(np.uint64)).view(np.int64)
    big = np.flatnonzero(counts > 1)
    _, keep = np.unique(name[big], return_index=True)
    wanted = np.zeros(len(starts), bool)
    wanted[big[keep]] = True
    rows = np.repeat(wanted, counts)
    a, b = np.repeat(name, counts)[rows], mark[rows]
    del sig, fresh, order, rows
    release()
    for i in range(0, len(a), 50_000):
        n = len(a[i:i + 50_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[i:i + n]), pa.array(b[i:i + n]), pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.binary())] * 2], schema=schema)


_MEMBER = ("group", "p", "q", "block", "doc_id", "n", "comp", "cuts")


def _by_group(each, names: list[str], columns: tuple[str, ...] = _MEMBER):
    """``each`` is given the rows of one (group, p, q), which follow each other, and gives rows of ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, at = [], None
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if row[:3] != at:
                    out += each(rows)
                    rows, at = [], row[:3]
                rows.append(row)
            while len(out) > 20_000:
                yield _long_batch(out[:20_000], names)
                out = out[20_000:]
        yield _long_batch(out + each(rows), names)

    return run


def _long_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _tester(rows: list[tuple], percent: int, cross: bool):
    """A function of a row's place and of others, which gives those whose pair with it the count vectors leave open;
    ``cross``: between components."""
    p, q = rows[0][1:3]
    block = np.array([r[3] for r in rows])
    n, comp = (np.array([r[k] for r in rows], np.int64) for k in (5, 6))
    width = min(len(r[7]) for r in rows)
    # Finer vectors are folded to the coarsest one.
    vectors = np.stack([np.frombuffer(r[7], np.uint8).astype(np.int16).reshape(width, -1).sum(axis=1) for r in rows]).astype(np.int16)

    def open_to(i: int, near: np.ndarray) -> np.ndarray:
        near = near[np.abs(n[near] - n[i]) * (100 + percent) <= (n[near] + n[i]) * (100 - percent)]
        if p != q:
            near = near[block[near] != block[i]]
        if cross:
            near = near[comp[near] != comp[i]]
        if not len(near):
            return near
        apart = np.abs(vectors[near] - vectors[i]).sum(axis=1, dtype=np.int64)
        return near[apart * (100 + percent) <= (n[near] + n[i]) * (100 - percent)]

    return open_to


def _open(rows: list[tuple], percent: int, cross: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Places of rows, and of those before them whose pair the count vectors leave open; ``cross``: between components."""
    if len(rows) < 2:
        return
    open_to = _tester(rows, percent, cross)
    for i in range(1, len(rows)):
        near = open_to(i, np.arange(i))
        if len(near):
            yield i, near


def _forest(percent: int, cross: bool = False):
    """A spanning forest of a group's open pairs.

    A row is held against a few centres of each tree first, then against the other rows of the trees that it has
    not met by them; so a large group of near copies is not compared pair by pair.
    """

    def each(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        open_to = _tester(rows, percent, cross)
        label, met, centre, found = np.arange(len(rows)), np.zeros(len(rows), np.int64), np.zeros(len(rows), bool), []
        centre[0] = True
        for i in range(1, len(rows)):
            if i < FEW:
                near = open_to(i, np.arange(i))
            else:
                near, left = open_to(i, np.flatnonzero(centre[:i])), ~centre[:i]
                for tree in set(label[near].tolist()):
                    left &= label[:i] != tree
                rest = np.flatnonzero(left)
                if len(rest):
                    near = np.concatenate([near, open_to(i, rest)])
            if not len(near):
                centre[i] = True
                continue
            met[near] += 1
            trees = set(label[near].tolist())
            fresh = len(trees) > 1
            for tree in trees:  # one edge to each tree that is met
                mine = near[label[near] == tree] if fresh else near
                j = mine[np.argmax(met[mine])]
                fresh |= not centre[j]
                centre[j] = True
                x, y = (rows[i], rows[j]) if rows[i][4] < rows[j][4] else (rows[j], rows[i])
                found.append((x[0], x[4], y[4], x[5], y[5]))
            label[i] = tree
            if len(trees) > 1:
                label[:i][np.isin(label[:i], list(trees))] = tree
            if fresh:
                own = np.flatnonzero(centre[:i] & (label[:i] == tree))
                centre[own[np.argsort(-met[own], kind="stable")[CENTRES:]]] = False
        return found

    return _by_group(each, ["group", "a", "b", "n_a", "n_b"])


def _linked(percent: int):
    """A spanning forest of a group's links between components, from the n-grams themselves."""

    def each(rows: list[tuple]) -> list[tuple]:
        sets, n = [np.frombuffer(r[8], np.uint64) for r in rows], np.array([r[5] for r in rows], np.int64)
        label, found = np.array([r[6] for r in rows], np.int64), []
        for i, near in _open(rows, percent, True):
            near = near[label[near] != label[i]]
            if not len(near):
                continue
            values = np.concatenate([sets[j] for j in near])
            at = np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)
            both = np.bincount(np.repeat(np.arange(len(near)), n[near])[sets[i][at] == values], minlength=len(near))
            near = near[100 * both >= percent * (n[near] + n[i] - both)]
            met, first = np.unique(label[near], return_index=True)
            found += [(min(rows[i][4], rows[j][4]), max(rows[i][4], rows[j][4])) for j in near[first]]
            label[np.isin(label, met)] = label[i]
        return found

    return _by_group(each, ["a", "b"], (*_MEMBER, "grams"))


def _segments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in (part for big in blocks(batches, limit=BLOCK) for part in _rows(big, 60_000)):
            h, owner, sizes = sets_of(plain(block.column("text")), width)
            mine = np.array([a == b for a, b in zip(digests(h, sizes), block.column("digest").to_pylist())], dtype=bool)
            ids = block.column("doc_id").to_numpy()
            use = mine[owner]
            h, owner = h[use], owner[use]
            f = (h >> np.uint64(62)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (owner[1:] != owner[:-1])])) if len(h) else np.zeros(0, np.int64)
            ends = np.append(starts[1:], len(h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[owner[starts]], pa.int64()), pa.array(f[starts], pa.int32()),
                 pa.array([h[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary())], ["id", "frag", "seg"])
            release()

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one (a, frag, salt) follow each other, the segment of ``a`` (if it has one) first."""
    base, of = np.zeros(0, np.uint64), None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("a", "frag", "salt", "b", "seg")]
        parts = np.zeros(batch.num_rows, np.int64)
        for i, (a, frag, salt, other, seg) in enumerate(zip(*columns)):
            values = np.frombuffer(seg, np.uint64)
            if other is None:
                base, of = values, (a, frag, salt)
            elif of == (a, frag, salt):
                at = np.minimum(np.searchsorted(base, values), len(base) - 1)
                parts[i] = np.count_nonzero(base[at] == values)
        keep = batch.column("b").is_valid()
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(parts).filter(keep)], ["a", "b", "part"])


def _verify(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) that reach the threshold, from overlaps summed over fragments."""
    # A document with many pairs, such as the centre of a large near group, is dealt over as many tasks.
    many_pairs = stored(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_SALT).cast("int").alias("salts")).where("salts > 1"), "salts")
    salted = pairs.join(many_pairs, "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int"))
    columns = ["a", "frag", "salt", "b", "seg"]
    many = salted.select("a", "b", "salt").join(segments.withColumnRenamed("id", "b"), "b").select(*columns)
    one = salted.select("a", "salt").distinct().join(segments.withColumnRenamed("id", "a"), "a").withColumn(
        "b", F.lit(None).cast("long")).select(*columns)
    counted = (
        many.unionByName(one).repartition("a", "frag", "salt")
        .sortWithinPartitions(F.col("a"), F.col("frag"), F.col("salt"), F.col("b").asc_nulls_first())
        .mapInArrow(_overlaps, "a long, b long, part long")
        .groupBy("a", "b").agg(F.sum("part").alias("both"))
    )
    return pairs.join(counted, ["a", "b"]).where(
        100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: its key, ``n_shingles`` and ``component_id``, the smallest key it reaches."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    threshold = Fraction(percent, 100)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = stored(
        rows.mapInArrow(_spread(width, threshold, buckets, common_grams(rows, width)), _SPREAD).repartitionById(buckets, F.col("bucket"))
        .mapInArrow(_group, _FOUND), "grams")
    every = found.where("digest is not null").select(F.col("a").alias("doc_id"), "n", "digest", "cuts", "mark")
    one = every.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("digest", "n", "cuts", "mark")).alias("s")).select("doc_id", "s.*")
    # Written, so that the join is one of two plain shuffles: Spark splits a digest that many documents share.
    classes = stored(one.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    known = stored(one.join(classes, "digest", "left").withColumn("rep", F.coalesce("rep", "doc_id")), "known")
    reps = known.where("doc_id = rep")
    grouped = found.where("digest is null").select(F.col("a").alias("group"), "mark").join(
        reps.where("n > 0").select("doc_id", "mark"), "mark").select("group", "doc_id").distinct()
    sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    members = stored(grouped.join(sizes, "group"), "members")

    def in_blocks(rows: DataFrame, blocks_: Column, *extra: str) -> DataFrame:
        """``rows`` are members with their component; large groups are compared block by block."""
        rows = rows.withColumn("blocks", blocks_.cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("group", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), *_MEMBER[3:], *extra)
        return rows.repartition("group", "p", "q").sortWithinPartitions("group", "p", "q", "doc_id")

    sized = reps.select("doc_id", "n", "cuts")
    many = F.ceil(F.col("k") / GROUP_BLOCK)
    edges = stored(in_blocks(members.withColumn("comp", F.col("doc_id")).join(sized, "doc_id"), many).mapInArrow(
        _forest(percent), "group long, a long, b long, n_a long, n_b long"), "edges")
    pairs = edges.select("a", "b", "n_a", "n_b").distinct()
    # A document of an open pair has an edge, so the second look needs no other segments.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().join(known.select("doc_id", "digest"), "doc_id")
    segments = stored(rows.join(wanted, "doc_id").mapInArrow(_segments(width), "id long, frag int, seg binary").dropDuplicates(["id", "frag"]), "segments")
    links = stored(_verify(pairs, segments, percent), "linked")
    comp = components(links)
    # Groups in which an edge was no link: all that is still open between components.
    unsettled = edges.join(links, ["a", "b"], "left_anti").select("group").distinct()
    again = members.join(unsettled, "group", "left_semi").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "comp", F.coalesce("comp", "doc_id"))
    open_ = stored(in_blocks(again.join(sized, "doc_id"), many).mapInArrow(
        _forest(percent, True), "group long, a long, b long, n_a long, n_b long").select("a", "b").distinct(), "open")
    if not open_.isEmpty():
        together = components(open_).select(F.col("comp").alias("group"), F.col("node").alias("doc_id"))
        # At most four segments of a document; in their order they are its n-grams in order.
        grams = segments.join(together.select(F.col("doc_id").alias("id")), "id", "left_semi").groupBy(F.col("id").alias("doc_id")).agg(
            F.array_sort(F.collect_list(F.struct("frag", "seg"))).alias("s")).select(
                "doc_id", F.aggregate("s", F.lit(b""), lambda all_, x: F.concat(all_, x["seg"])).alias("grams"))
        held = together.join(sized, "doc_id").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
        weights = together.join(sized, "doc_id").groupBy("group").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"))
        split = F.greatest(many, F.ceil(8 * F.col("total") / SET_BYTES))
        fresh = stored(in_blocks(held.join(weights, "group").join(grams, "doc_id"), split, "grams").mapInArrow(_linked(percent), "a long, b long").distinct(), "linked")
        if not fresh.isEmpty():
            comp = components(fresh, labels=comp)
    result = known.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "rep").alias("component_id"))
    nameless = every.where("doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return result.unionByName(nameless)
