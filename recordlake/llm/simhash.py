"""SimHash near-duplicates by the generalised pigeonhole principle, and their connected components.

* Fingerprints. A bit is set if more than half of a text's shingle hashes (repeats included) have it.
* Parts. The 64 bits are grouped into parts of correlated bits, by the correlations of all distinct
  fingerprints: bits that move together share a part, so that the parts themselves say different things.
* Budgets. If two fingerprints differ in at most ``tau`` bits and parts have budgets that sum up to
  ``tau - parts + 1``, they differ within its budget in some part; a part with budget -1 is not asked.
  Each fingerprint gets its own budgets: a dynamic program over the parts takes those with the fewest
  expected candidates, by counts of part values over all distinct fingerprints.
* Probes. Every fingerprint stands in the index under its value of each part, and asks for all values
  within its budget. Rows of one part value meet in one task, are verified by the distance of the whole
  fingerprints, and give at most one edge a row.
* A value that more than ``MOST`` rows meet at is not compared row by row: there a fingerprint names
  itself and its neighbours at one flipped bit. Whatever shares such a name lies within two bits, and two
  fingerprints within two bits share one; a name has at most 65 rows. So no value takes quadratic work.
  For other distances than two, such values are compared block by block.

Equal fingerprints are one node, whatever their number. Nulls and edges: a null text is empty; a text
without words has fingerprint zero, which links like any other. A text of fewer words than the shingle
width has its whole sequence as its one shingle. Rows with a null id take part and get the component of
their fingerprint, null if no row of it has an id. Repeated rows each come back. Texts of any length are
read whole, in bounded pieces. No rows give no rows. Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.components import components
from recordlake.llm.text import blocks
from recordlake.session import stored

SEED = 42
BITS = 64
#: Rows that are compared at one part value; beyond it the neighbours' names are used.
MOST = 256
#: Bits of the tables that candidates are estimated from.
TABLE_BITS = 11
#: What a probe costs, counted in candidates.
PROBE = 4.0
#: Shingles of a text that are taken at a time.
PIECE = 1 << 16


def fingerprint(text: str | None, width: int) -> int:
    """The unsigned fingerprint of one text."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    body, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    last = min(width, len(words)) - 1
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends, digest = ends[last:], xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(ends), PIECE):
        h = np.array([digest(body[a:b], SEED) for a, b in zip(starts[i:i + PIECE], ends[i:i + PIECE])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(ends), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """Rows (doc_id, fp): the key and the fingerprint of every row's whole text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=4 << 20):
            found = np.array([fingerprint(t, width) for t in block.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("fp").to_numpy().view(np.uint64)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(spark, frame: DataFrame, run, size: int) -> np.ndarray:
    """Counts that tasks give as (place, n), added up: at most ``size`` numbers."""
    out = np.zeros(size, np.int64)
    for r in frame.mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[r["place"]] = r["n"]
    return out


def _counts(values: np.ndarray) -> pa.RecordBatch:
    place = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(values[place], pa.int64())], ["place", "n"])


def correlations(distinct: DataFrame, n: int) -> np.ndarray:
    """The absolute correlation of each two bits over all distinct fingerprints. Bits that never
    change tell nothing; they count as alike."""

    def run(batches):
        both = np.zeros((BITS, BITS), np.int64)
        for values in _sets(batches):
            bits = _bits(values).astype(np.float64)
            both += (bits.T @ bits).astype(np.int64)
        yield _counts(both.ravel())

    both = _summed(distinct.sparkSession, distinct, run, BITS * BITS).reshape(BITS, BITS) / max(n, 1)
    mean = np.diag(both)
    spread = np.sqrt(mean * (1 - mean))
    still = spread == 0
    out = np.abs(both - np.outer(mean, mean)) / np.where(still, 1, spread)[:, None] / np.where(still, 1, spread)
    out[np.ix_(still, still)] = 1.0
    return out


def parts_for(n: int, tau: int) -> int:
    """The number of parts with the least work were the values even: probes, and candidates of each."""

    def work(m: int) -> float:
        width, total = BITS // m, tau - m + 1
        low, extra = (total // m, total % m) if total >= 0 else (0, 0)
        asked = m if total >= 0 else max(1, m + total)
        probes = sum(sum(_choose(width, r) for r in range(low + (i < extra) + 1)) for i in range(asked))
        return probes * (PROBE + n / 2.0 ** width)

    return min(range(1, tau + 3), key=work)


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width: each starts at the closest pair of free bits and takes the bit
    closest to it on average until it is full."""
    free, out = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        if width == 1 or len(free) == 1:
            part = [free[0]]
        else:
            part = list(max(combinations(free, 2), key=lambda p: (corr[p], -p[0], -p[1])))
        while len(part) < width:
            rest = [b for b in free if b not in part]
            part.append(max(rest, key=lambda b: (corr[b, part].mean(), -b)))
        out.append(sorted(part))
        free = [b for b in free if b not in part]
    return out


def values_of(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The value of some bits, gathered into the low places."""
    out = np.zeros(len(fps), np.uint64)
    for place, b in enumerate(bits):
        out |= (fps >> np.uint64(b) & np.uint64(1)) << np.uint64(place)
    return out


def flips(width: int, most: int) -> list[np.ndarray]:
    """Masks over ``width`` bits with exactly 0, 1 ... ``most`` bits set."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), r)], np.uint64) for r in range(most + 1)]


class Plan:
    """The parts, and tables of how many fingerprints lie at each distance of a part value.

    A part is estimated from tables over at most ``TABLE_BITS`` of its bits, combined as if these were
    independent: at most 64 / TABLE_BITS + parts tables of 2^TABLE_BITS rows, whatever the input.
    """

    def __init__(self, parts: list[list[int]], tau: int, n: int):
        self.parts, self.tau, self.n = parts, tau, n
        self.tables: list[list[tuple[list[int], np.ndarray]]] = []
        self.subs = []
        for bits in parts:
            count = -(-len(bits) // TABLE_BITS)
            self.subs.append([bits[i * len(bits) // count:(i + 1) * len(bits) // count] for i in range(count)])

    @property
    def flat(self) -> list[list[int]]:
        return [s for subs in self.subs for s in subs]

    def learn(self, distinct: DataFrame) -> Plan:
        flat = self.flat

        def run(batches):
            out = np.zeros((len(flat), 1 << TABLE_BITS), np.int64)
            for values in _sets(batches):
                for i, bits in enumerate(flat):
                    out[i] += np.bincount(values_of(values, bits).astype(np.int64), minlength=1 << TABLE_BITS)
            yield _counts(out.ravel())

        counts = _summed(distinct.sparkSession, distinct, run, len(flat) << TABLE_BITS).reshape(len(flat), -1)
        rows = iter(counts)
        for subs in self.subs:
            mine = []
            for bits in subs:
                share = next(rows)[:1 << len(bits)] / max(self.n, 1)
                at = np.arange(1 << len(bits))
                near = [sum((share[at ^ int(m)] for m in masks), np.zeros(len(at))) for masks in flips(len(bits), self.tau)]
                mine.append((bits, np.stack(near, axis=1).astype(np.float32)))
            self.tables.append(mine)
        return self

    def expected(self, fps: np.ndarray) -> np.ndarray:
        """Expected fingerprints within 0 ... tau of each value, for each part: [part, row, distance]."""
        out = []
        for mine in self.tables:
            total = None
            for bits, near in mine:
                own = near[values_of(fps, bits).astype(np.int64)].astype(np.float64)
                if total is None:
                    total = own
                else:
                    total = np.stack([sum(total[:, i] * own[:, d - i] for i in range(d + 1)) for d in range(self.tau + 1)], axis=1)
            out.append(np.cumsum(total, axis=1) * self.n)
        return np.stack(out)

    def budgets(self, fps: np.ndarray) -> np.ndarray:
        """The budget of each part for each fingerprint, -1 where it is not asked: [row, part]."""
        m, most = len(self.parts), max(self.tau - len(self.parts) + 1, 0) + len(self.parts) - 1
        want, cost = self.tau - m + 1, self.expected(fps)
        options = list(range(-1, min(self.tau, want + m - 1, most) + 1))
        reach = {0: np.zeros(len(fps))}
        steps: list[dict[int, np.ndarray]] = []
        for i, bits in enumerate(self.parts):
            probes = np.cumsum([_choose(len(bits), r) for r in range(self.tau + 1)])
            after: dict[int, np.ndarray] = {}
            taken: dict[int, np.ndarray] = {}
            for so_far, before in sorted(reach.items()):
                for t in options:
                    to = so_far + t
                    value = before if t < 0 else before + cost[i][:, t] + PROBE * probes[t]
                    if to not in after:
                        after[to], taken[to] = value.copy(), np.full(len(fps), t, np.int8)
                    else:
                        better = value < after[to]
                        after[to] = np.where(better, value, after[to])
                        taken[to] = np.where(better, t, taken[to]).astype(np.int8)
            reach = after
            steps.append(taken)
        out, left = np.zeros((len(fps), m), np.int8), np.full(len(fps), want)
        for i in range(m - 1, -1, -1):
            for to in np.unique(left):
                rows = left == to
                out[rows, i] = steps[i][int(to)][rows]
            left = left - out[:, i]
        return out


_KEYED = "part int, value long, fp long, role int"
INDEXED, ASKS = 1, 2


def _probes(plan: Plan):
    """Every fingerprint under its own part values, and under all those it asks for."""
    masks = [flips(len(bits), plan.tau) for bits in plan.parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _sets(batches):
            for i in range(0, len(whole), 20_000):
                fps = whole[i:i + 20_000]
                budget = plan.budgets(fps)
                for k, bits in enumerate(plan.parts):
                    values = values_of(fps, bits)
                    yield _keyed(k, values, fps, np.where(budget[:, k] >= 0, INDEXED | ASKS, INDEXED))
                    for t in range(1, int(budget[:, k].max(initial=-1)) + 1):
                        rows = budget[:, k] >= t
                        near = masks[k][t]
                        yield _keyed(k, (values[rows][:, None] ^ near).ravel(), np.repeat(fps[rows], len(near)), np.full(rows.sum() * len(near), ASKS))

    return run


def _keyed(part: int, values: np.ndarray, fps: np.ndarray, role: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(fps), part), pa.int32()), pa.array(values.view(np.int64)), pa.array(fps.view(np.int64)), pa.array(role, pa.int32())],
        ["part", "value", "fp", "role"])


def _verify(tau: int, cells: list[str]):
    """Rows of one cell follow each other and are few; each gives at most one edge (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            cell = _cells(batch, cells)
            open_at = int(np.searchsorted(cell, cell[-1]))
            rest = batch.slice(open_at)
            yield _edges(batch.slice(0, open_at), cell[:open_at], tau)
        if rest is not None:
            yield _edges(rest, np.zeros(rest.num_rows, np.int64), tau)

    return run


def _cells(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """The number of each row's cell; cells follow each other."""
    fresh = np.zeros(batch.num_rows, bool)
    for name in names:
        values = batch.column(name).to_numpy()
        fresh[1:] |= values[1:] != values[:-1]
    return np.cumsum(fresh)


def _edges(batch: pa.RecordBatch, cell: np.ndarray, tau: int) -> pa.RecordBatch:
    fps, role = batch.column("fp").to_numpy().view(np.uint64), batch.column("role").to_numpy()
    label = np.arange(len(fps))
    found, rows, step = [], np.arange(len(fps)), 1
    while True:  # all rows with the one ``step`` places below them in their cell
        rows = rows[rows + step < len(fps)]
        rows = rows[cell[rows] == cell[rows + step]]
        if not len(rows):
            break
        other = rows + step
        near = np.bitwise_count(fps[rows] ^ fps[other]) <= tau
        met = near & ((role[rows] & INDEXED) * 2 & role[other] | (role[other] & INDEXED) * 2 & role[rows] > 0)
        if met.any():
            found.append(np.stack([rows[met], other[met]]))
        step += 1
    if found:
        a, b = np.concatenate(found, axis=1)
        while True:  # smallest rows of the components inside the cells
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
    edge = (label != np.arange(len(fps))) & (fps != fps[label])
    signed = fps.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[label[edge]]), pa.array(signed[edge])], ["a", "b"])


def links(distinct: DataFrame, tau: int = 2, parts: int | None = None, most: int = MOST) -> DataFrame:
    """Edges (a, b) between fingerprints (column ``fp``, distinct): two of them are connected by edges exactly
    if they are connected by differences of at most ``tau`` bits."""
    n = distinct.count()
    count = parts or parts_for(n, tau)
    plan = Plan(group_bits(correlations(distinct, n), count), tau, n).learn(distinct)
    keyed = stored(distinct.mapInArrow(_probes(plan), _KEYED), "probes")
    cells = ["part", "value"]
    full = stored(keyed.groupBy(*cells).agg(F.count(F.lit(1)).alias("k"), F.max("role").alias("r")).where(F.col("k") > most), "full")
    light = keyed.join(full, cells, "left_anti")
    found = light.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(_verify(tau, cells), "a long, b long")
    heavy = keyed.join(full.select(*cells, "k"), cells)
    if tau == 2:
        flipped = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda j: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), j)))
        names = heavy.select("fp").distinct().select("fp", F.explode(F.concat(F.array("fp"), flipped)).alias("name"))
        # A name has at most 65 rows; all of them lie within two bits of each other.
        met = names.groupBy("name").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        dense = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()
    else:
        dense = _blockwise(heavy, most, tau)
    return stored(found.unionByName(dense), "edges")


def _blockwise(heavy: DataFrame, most: int, tau: int) -> DataFrame:
    """Every two blocks of a full cell in a cell of their own."""
    half = max(most // 2, 1)
    count = F.ceil(F.col("k") / half).cast("int")
    rows = heavy.withColumn("block", F.pmod(F.xxhash64("fp"), count).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    cells = ["part", "value", "p", "q"]
    rows = rows.select("part", "value", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "fp", "role")
    return rows.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(_verify(tau, cells), "a long, b long")


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, tau: int = 2,
                    parts: int | None = None, most: int = MOST) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id it reaches."""
    marked = stored(fingerprints(docs, key, text, width), "marked")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    edges = links(classes.select("fp"), tau, parts, most)
    comp = components(edges)
    named = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    # Written, so that the join of the documents is one of two plain shuffles, whose skew Spark can split.
    known = stored(named.join(least, "comp").select("fp", "component_id"), "known")
    return marked.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
