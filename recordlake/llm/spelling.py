"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

One inserted or deleted letter moves one letter count by one, one replaced letter moves one up and one
down: the L1 distance of the count vectors is at most two. Words are kept in one k-d tree per length,
and a word is looked for in two of them: its own length (at most one count up and one down) and the next
length (at most one up). A search follows the splits and leaves out every box that such a move cannot
reach. What is left is verified by the order of the letters: one of the two halves must be equal, then
the whole words are compared.

The trees' upper levels are fitted on a bounded sample of at most about ``SAMPLE`` words and go to every
task; each of their leaves is a cell, with its own words and those that visit it, and a tree of its own is
built in the task that holds it. Pairs of one length are looked for from the leaf with the smaller number
only. Every word is indexed and every word searches. A leaf of more than ``CELL`` words is cut into blocks
that meet pairwise, so that memory is bounded.

The *form* of a word is its near word with the largest count, if that is ``FACTOR`` times its own; forms
lead to a *root* in a few steps, since counts grow by that factor at each.

Nulls and edges: null words and null counts are left out; rows that repeat a word add up. Ties between
near words of equal count go to the smallest in code-point order. Words of any length and any letters are
taken (letters share count places beyond a-z and U+00C0-U+00FF, which only widens the search). An empty
table gives no rows. Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.llm.text import mix
from recordlake.session import stored

#: Words that the upper levels are fitted on, words of a leaf that they aim at, and the most words of a cell.
SAMPLE = 50_000
LEAF = 512
CELL = 1 << 16
#: Words of a box of a cell's own tree.
BOX = 8
FACTOR = 10
PLACES = 128
PAIRS = 1 << 20
HOME, SAME, SHORTER = 0, 1, 2
LEFT, RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Words:
    """Letters, letter counts and half-word hashes of some words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(self.size)
        self.starts = self.ends - self.size
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        place = np.where((codes >= 97) & (codes <= 122), codes - 97, np.where((codes >= 0xC0) & (codes <= 0xFF), codes - 0xC0 + 26, 90 + codes % (PLACES - 90)))
        owner = np.repeat(np.arange(len(words)), self.size)
        self.counts = np.bincount(owner * PLACES + place, minlength=len(words) * PLACES).reshape(-1, PLACES).astype(np.int32)
        at = np.arange(len(codes))
        first = mix(codes.astype(np.uint64) + (at - self.starts[owner]).astype(np.uint64) * LEFT)
        last = mix(codes.astype(np.uint64) + (self.ends[owner] - at).astype(np.uint64) * RIGHT)
        self._first, self._last = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (first, last))

    def halves(self, shorter_by: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first and the last half of a word ``shorter_by`` letters shorter, as if it were at each end of this one."""
        left = (self.size - shorter_by) // 2
        right = self.size - shorter_by - left
        return self._first[self.starts + left] - self._first[self.starts], self._last[self.ends] - self._last[self.ends - right]


class Tree:
    """A k-d tree over letter counts: inner nodes ask whether a count reaches a bound."""

    def __init__(self, counts: np.ndarray, box: int):
        self.place: list[int] = []
        self.bound: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.leaves = 0
        self.members: list[np.ndarray] = []
        self.root = self._build(counts, np.arange(len(counts)), box)

    def _build(self, counts: np.ndarray, rows: np.ndarray, box: int) -> int:
        """The number of the node over these rows; leaves are -1, -2, ..."""
        todo = [(rows, -1, 0)]
        root = 0
        while todo:
            rows, above, side = todo.pop()
            split = self._split(counts[rows]) if len(rows) > box else None
            if split is None:
                self.leaves += 1
                me = -self.leaves
                self.members.append(rows)
            else:
                me = len(self.place)
                self.place.append(split[0])
                self.bound.append(split[1])
                self.low.append(0)
                self.high.append(0)
                up = counts[rows, split[0]] >= split[1]
                todo += [(rows[up], me, 1), (rows[~up], me, 0)]
            if above < 0:
                root = me
            else:
                (self.high if side else self.low)[above] = me
        return root

    @staticmethod
    def _split(counts: np.ndarray) -> tuple[int, int] | None:
        """The place and bound that cut the rows most evenly."""
        middle = np.sort(counts, axis=0)[len(counts) // 2]
        best = None
        for bound in (np.maximum(middle, 1), middle + 1):
            share = (counts >= bound).sum(axis=0)
            even = np.minimum(share, len(counts) - share)
            place = int(even.argmax())
            if even[place] and (best is None or even[place] > best[0]):
                best = (int(even[place]), place, int(bound[place]))
        return best and best[1:]

    def visit(self, counts: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows, and the leaves whose boxes they reach when at most ``up`` counts grow and ``down`` shrink by one."""
        rows = np.arange(len(counts))
        free = np.full(len(counts), -1)
        todo = [(self.root, rows, free if up else free - 1, free if down else free - 1)]
        out_rows, out_leaves = [], []
        while todo:
            node, rows, grown, shrunk = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out_rows.append(rows)
                out_leaves.append(np.full(len(rows), -node - 1))
                continue
            place, bound = self.place[node], self.bound[node]
            # -1: not used yet; -2: not allowed.
            at = counts[rows, place] + (grown == place) - (shrunk == place)
            high = at >= bound
            drop = high & (at == bound) & (shrunk == -1) & (grown != place)
            rise = ~high & (at == bound - 1) & (grown == -1) & (shrunk != place)
            for child, free_, moved, g, s in ((self.low[node], ~high, drop, None, place), (self.high[node], high, rise, place, None)):
                both = np.concatenate([np.flatnonzero(free_), np.flatnonzero(moved)])
                cut = int(free_.sum())
                g_new, s_new = grown[both], shrunk[both]
                if g is None:
                    s_new[cut:] = s
                else:
                    g_new[cut:] = g
                todo.append((child, rows[both], g_new, s_new))
        if not out_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_rows), np.concatenate(out_leaves)

    def home(self, counts: np.ndarray) -> np.ndarray:
        rows, leaves = self.visit(counts, 0, 0)
        out = np.zeros(len(counts), np.int64)
        out[rows] = leaves
        return out


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced between the words; ``b`` is not the shorter one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(b) != len(a) + 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1:]


class Cell:
    """The words of a leaf with their own tree."""

    def __init__(self, words: list[str], n: list[int]):
        self.home, self.n = Words(words), n
        self.tree = Tree(self.home.counts, BOX)
        sizes = np.array([len(m) for m in self.tree.members])
        self.members = np.concatenate(self.tree.members)
        self.sizes, self.first = sizes, np.cumsum(sizes) - sizes
        self.halves = {SAME: self.home.halves(0), SHORTER: self.home.halves(1)}

    def near(self, visitors: Words, kind: int, own: bool = False) -> Iterator[tuple[int, int]]:
        """Pairs (visitor, home word) one edit apart; ``own``: the visitors are the home words."""
        rows, leaves = self.tree.visit(visitors.counts, 1, 1 if kind == SAME else 0)
        first, last = visitors.halves(0)
        many = self.sizes[leaves]
        ends = np.cumsum(many)
        start = 0
        while start < len(rows):  # a bounded number of pairs at a time
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, side="right")))
            k = many[start:stop]
            r = np.repeat(rows[start:stop], k)
            h = self.members[np.repeat(self.first[leaves[start:stop]] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
            ours, theirs = self.halves[kind]
            keep = (first[r] == ours[h]) | (last[r] == theirs[h])
            if own:
                keep &= r < h
            for i, j in zip(r[keep].tolist(), h[keep].tolist()):
                if one_edit(visitors.words[i], self.home.words[j]):
                    yield i, j
            start = stop


_ROUTED = "size int, leaf int, kind int, word string, n long"


def _route(trees: dict[int, Tree]):
    """Every word to its own leaf, and to each leaf that may hold a near word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                part = batch.slice(at, 5_000)
                words = Words(part.column("word").to_pylist())
                for size in np.unique(words.size):
                    rows = np.flatnonzero(words.size == size)
                    counts, mine = words.counts[rows], trees.get(int(size))
                    home = mine.home(counts) if mine else np.zeros(len(rows), np.int64)
                    yield _routed(part, rows, size, home, HOME)
                    if mine:
                        r, leaves = mine.visit(counts, 1, 1)
                        later = leaves > home[r]
                        yield _routed(part, rows[r[later]], size, leaves[later], SAME)
                    longer = trees.get(int(size) + 1)
                    r, leaves = longer.visit(counts, 1, 0) if longer else (np.arange(len(rows)), np.zeros(len(rows), np.int64))
                    yield _routed(part, rows[r], size + 1, leaves, SHORTER)

    return run


def _routed(part: pa.RecordBatch, rows: np.ndarray, size: int, leaves: np.ndarray, kind: int) -> pa.RecordBatch:
    pick = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(rows), size), pa.int32()), pa.array(leaves, pa.int32()), pa.array(np.full(len(rows), kind), pa.int32()),
         part.column("word").take(pick), part.column("n").take(pick)], ["size", "leaf", "kind", "word", "n"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each cell; its home words stand before its visitors."""
    names = ["word", "n", "near", "near_n"]
    at, words, counts, cell, found = None, [], [], None, []

    def close() -> None:
        """The home words among themselves, once all of them are there."""
        nonlocal cell
        if cell is None and words:
            cell = Cell(words, counts)
            found.extend((words[i], counts[i], words[j], counts[j]) for i, j in cell.near(cell.home, SAME, own=True))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        w, n, near, near_n = zip(*rows) if rows else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(n, pa.int64()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())], names)

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("size", "leaf", "block", "kind")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            key, kind = tuple(keys[:3, a].tolist()), int(keys[3, a])
            part = batch.slice(a, b - a)
            if key != at:
                close()
                at, words, counts, cell = key, [], [], None
            w, n = part.column("word").to_pylist(), part.column("n").to_pylist()
            if kind == HOME:
                words, counts = words + w, counts + n
                continue
            close()
            if cell is not None:
                found.extend((w[i], n[i], words[j], counts[j]) for i, j in cell.near(Words(w), kind))
            if len(found) > 20_000:
                yield batch_of(found)
                found.clear()
    close()
    yield batch_of(found)


def upper_trees(words: DataFrame, total: int, sample: int, leaf: int) -> dict[int, Tree]:
    """The upper levels of each length's tree, from about ``sample`` words chosen by hash."""
    every = max(1, -(-total // sample))
    rows = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect()
    by_size: dict[int, list[str]] = {}
    for r in rows:
        by_size.setdefault(len(r["word"]), []).append(r["word"])
    out = {}
    for size, mine in by_size.items():
        tree = Tree(Words(sorted(mine)).counts, max(4, leaf // every))
        if tree.leaves > 1:
            tree.members = []
            out[size] = tree
    return out


def near_pairs(words: DataFrame, sample: int = SAMPLE, leaf: int = LEAF, cell: int = CELL) -> DataFrame:
    """Pairs (word, n, near, near_n) of words (columns ``word``, ``n``, distinct and not null) one edit apart, each once."""
    spark = words.sparkSession
    trees = upper_trees(words, words.count(), sample, leaf)
    routed = stored(words.mapInArrow(_route(trees), _ROUTED), "routed")
    # One row per full leaf.
    full = stored(routed.where(F.col("kind") == HOME).groupBy("size", "leaf").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > cell), "full")
    rows = routed.join(full, ["size", "leaf"], "left").withColumn("blocks", F.coalesce(F.ceil(F.col("k") / cell).cast("int"), F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    # Home words visit the later blocks of their leaf; other visitors go to all of them.
    first = F.when(F.col("kind") == HOME, own).otherwise(F.lit(0))
    rows = rows.withColumn("own", own).withColumn("block", F.explode(F.sequence(first, F.col("blocks") - 1)))
    rows = rows.withColumn("kind", F.when((F.col("kind") == HOME) & (F.col("block") > F.col("own")), F.lit(SAME)).otherwise(F.col("kind")))
    cells = ["size", "leaf", "block"]
    dealt = rows.select(*cells, "kind", "word", "n").repartition(*cells).sortWithinPartitions(*cells, "kind")
    return stored(dealt.mapInArrow(_meet, "word string, n long, near string, near_n long"), "pairs")


def variants(counts: DataFrame, word: str = "word", n: str = "n", factor: int = FACTOR, **options) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``."""
    given = counts.select(F.col(word).cast("string").alias("word"), F.col(n).cast("long").alias("n"))
    words = stored(given.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    pairs = near_pairs(words, **options)
    both = pairs.select("word", "near", "near_n").unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    strong = -F.col("b.m") >= factor * F.col("n")
    formed = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("b.near")).alias("form"), F.when(strong, -F.col("b.m")).alias("form_n")), "formed")
    return formed.join(_roots(formed.where("form is not null").select("word", "form")), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form; the way is halved each round."""
    ways = forms.withColumnRenamed("form", "root")
    while True:
        next_ = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(ways.join(next_, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        ways = after.select("word", "root")
        if after.where("moved").isEmpty():
            return ways


def runs(text: Column, least: int) -> Column:
    """Maximal runs of Latin letters of at least ``least`` letters, A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(text, upper, upper.lower()), F.lit("[a-zÀ-ÿ]{%d,}" % least), F.lit(0))
