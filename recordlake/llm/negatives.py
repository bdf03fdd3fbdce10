"""Hard negatives by Fagin's threshold algorithm over integer vectors.

An anchor's positives are its best rows of the same label. Each positive opens a window of scores
relative to its own; the negatives are the best rows of other labels inside it.

A task holds its rows in blocks with one sorted list per dimension. For an anchor the lists are read
from the end where its component's sign makes the products large, in steps that grow; whatever turns up
is scored whole by random access, in integers. No row that has not turned up can score more than the
threshold, the sum of the products at the places reached. The search of a block stops once the
threshold falls strictly below the worst score that each window keeps (a tie may still win by its id),
or below the window itself. What a window keeps is carried from block to block of a task, so later
blocks stop sooner; the tasks' lists, at most the wanted number of rows each, are merged at the end.

Anchors go to the tasks in passes of at most ``PASS_BYTES``, and each pass reads all rows: the stated
set of anchors against all rows, in blocks.

Nulls and edges: rows without an id, label or vector, or with a null or non-finite component, take no
part. Scores are of rows with vectors of the anchor's length. Rows that repeat the anchor's id are the
anchor itself and no positives of it; other repeated rows each count. Equal repeated anchors are one.
Ties go to the smaller id. Components are whole numbers within a long; beyond 2^53 in a score exact
integers are used, and a score beyond a long fails. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.session import stored

BLOCK = 8192
PASS_BYTES = 16 << 20
#: Places of each list that the first step reads, and how steps grow.
FIRST, GROWTH = 16, 4


@dataclass
class Kept:
    """The best ``k`` scores within [low, high] so far, with their ids."""

    k: int
    low: float = -np.inf
    high: float = np.inf
    scores: list = field(default_factory=list)
    ids: list = field(default_factory=list)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = self.low if len(self.scores) < self.k else max(self.low, self.scores[-1])
        rows = np.flatnonzero((scores >= floor) & (scores <= self.high))
        if len(rows) > 4 * self.k:
            worst = np.partition(scores[rows], len(rows) - self.k)[len(rows) - self.k]
            rows = rows[scores[rows] >= worst]
        if len(rows):
            both = sorted([*zip((-s for s in self.scores), self.ids), *zip((-int(s) for s in scores[rows]), ids[rows].tolist())])[:self.k]
            self.scores, self.ids = [-s for s, _ in both], [i for _, i in both]

    def settled(self, threshold: float) -> bool:
        return threshold < self.low or len(self.scores) == self.k and threshold < self.scores[-1]


class Block:
    """Rows with one ascending list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)
        self._others: dict = {}

    def of(self, label, same: bool) -> np.ndarray:
        found = self._others.get((label, same))
        if found is None:
            found = self._others[label, same] = (self.labels == label) == same
        return found

    def search(self, anchor: np.ndarray, wanted: np.ndarray, windows: list[Kept]) -> int:
        """Offer the ``wanted`` rows to the windows until none can take another; the number of rows scored."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        scored = np.zeros(n, bool)
        depth, step = 0, max(FIRST, n // 64) if len(up) + len(down) else n
        while depth < n:
            stop = min(n, depth + step)
            if stop < n:
                met = scored.copy()
                met[self.order[up, n - stop:n - depth].ravel()] = True
                met[self.order[down, depth:stop].ravel()] = True
            else:
                met = np.ones(n, bool)
            fresh = np.flatnonzero(met & ~scored)
            scored = met
            use = fresh[wanted[fresh]]
            if len(use):
                scores = self.vectors[use] @ anchor
                for w in windows:
                    w.take(scores, self.ids[use])
            threshold = (anchor[up] * self.values[up, n - stop]).sum() + (anchor[down] * self.values[down, stop - 1]).sum()
            if scored.all() or all(w.settled(threshold) for w in windows):
                break
            depth, step = stop, step * GROWTH
        return int(scored.sum())


def _typed(vectors: np.ndarray, others: np.ndarray) -> type:
    """A type in which all products of the two are exact."""
    most = float(np.abs(vectors.astype(np.float64)).max(initial=1)) * float(np.abs(others.astype(np.float64)).max(initial=1)) * max(vectors.shape[1], 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


@dataclass
class Anchor:
    number: int
    vec_id: int
    label: object
    vector: np.ndarray
    #: (slot, low, high) of each window of the negatives.
    windows: list[tuple[int, int, int]] = field(default_factory=list)


_FOUND = "anchor int, slot int, vec_id long, score long"


def _search(anchors: list[Anchor], k: int, same: bool, block_rows: int):
    """The best ``k`` rows of each anchor's windows, over all rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {a.number: [(slot, Kept(k, low, high)) for slot, low, high in a.windows] if not same else [(0, Kept(k))] for a in anchors}
        waiting: dict[int, list[tuple]] = {}

        def flush(size: int) -> None:
            ids, labels, vectors = (np.concatenate(x) for x in zip(*waiting.pop(size)))
            mine = [a for a in anchors if len(a.vector) == size and kept[a.number]]
            if not mine:
                return
            kind = _typed(vectors, np.stack([a.vector for a in mine]))
            block = Block(ids, labels, vectors.astype(kind))
            for a in mine:
                wanted = block.of(a.label, same)
                if same:
                    wanted = wanted & (ids != a.vec_id)
                block.search(a.vector.astype(kind), wanted, [w for _, w in kept[a.number]])

        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                vectors = part.column("vector").flatten().to_numpy().reshape(part.num_rows, size)
                waiting.setdefault(int(size), []).append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(zero_copy_only=False), vectors))
                if sum(len(x[0]) for x in waiting[int(size)]) >= block_rows:
                    flush(int(size))
        for size in list(waiting):
            flush(size)
        rows = [(number, slot, i, s) for number, mine in kept.items() for slot, w in mine for i, s in zip(w.ids, w.scores)]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))], ["anchor", "slot", "vec_id", "score"])

    return run


def whole_numbers(vectors: DataFrame, scale: int, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "vector") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: each component ``x`` becomes ``floor(scale * x)``."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("vec_id is not null and label is not null and vector is not null").where(~odd).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * scale)))


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         pass_bytes: int = PASS_BYTES, block_rows: int = BLOCK) -> DataFrame:
    """The first ``negatives`` rows of other labels for each anchor and positive, scoring from ``low`` to ``high`` percent of the positive.

    ``rows`` are as ``whole_numbers`` gives them; ``anchor`` is a condition on them.
    """
    spark = rows.sparkSession
    asked = stored(rows.where(anchor).distinct().withColumn("hash", F.xxhash64("vec_id", "vector")), "anchors")
    total, longest = asked.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    passes = max(1, -(-total * (8 * (longest or 0) + 100 * positives * 8) // pass_bytes))
    out = None
    for p in range(passes):
        found = _one_pass(spark, rows, asked.where(F.pmod("hash", F.lit(passes)) == p), positives, negatives, low, high, block_rows)
        out = found if out is None else out.unionByName(found)
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    """The merged lists of the tasks, numbered from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _one_pass(spark, rows: DataFrame, asked: DataFrame, positives: int, negatives: int, low: int, high: int, block_rows: int) -> DataFrame:
    given = sorted(((r["vec_id"], r["label"], r["vector"]) for r in asked.collect()), key=lambda r: (r[0], str(r[1]), r[2]))
    anchors = [Anchor(i, v, label, np.array(x, np.int64)) for i, (v, label, x) in enumerate(given)]
    best = _best(rows.mapInArrow(_search(anchors, positives, True, block_rows), _FOUND), positives)
    first = best.select("anchor", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).collect()
    for r in first:  # at most ``positives`` rows an anchor
        # low * positive <= 100 * negative <= high * positive, in whole numbers
        least, most = -(-low * r["positive_score"] // 100), high * r["positive_score"] // 100
        if least <= most:
            anchors[r["anchor"]].windows.append((r["slot"], least, most))
    opened = spark.createDataFrame(
        [(r["anchor"], r["slot"], anchors[r["anchor"]].vec_id, r["positive_id"], r["positive_score"]) for r in first],
        "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
    found = stored(_best(rows.mapInArrow(_search(anchors, negatives, False, block_rows), _FOUND), negatives), "negatives")
    return found.join(opened, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
