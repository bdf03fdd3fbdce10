"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and their white space is made single spaces. An item of m characters
may be found with at most k = rate * m edits. Cut into k + 1 pieces, one piece must then be there
unchanged: all pieces of all items are looked for at once with an Aho-Corasick automaton, and each
place of a hit is verified with Myers' bit-parallel distance over the text around it.

The items go to every task in blocks of at most ``BLOCK_CHARS`` characters; each block is one pass
over the documents, which need no shuffle. After a pass its rows are written and its block is dropped, so
that the driver and the tasks hold one block of items at a time, however many there are.

Nulls and edges: a null text or item is empty and an empty item is never found. Pieces keep at least
``MIN_PIECE`` characters, so short items get fewer edits, and items shorter than that are compared
exactly. Repeated documents and items each give their own rows. Extra columns pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.text import blocks, release
from recordlake.session import stored

RATE = 0.1
MIN_PIECE = 8
GRAM = 4
BLOCK_CHARS = 1 << 20

LEAK = pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("budget", pa.int32()), ("ends_at", pa.int64())])
LEAK_SQL = "array<struct<item_id:bigint,edits:int,budget:int,ends_at:bigint>>"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget_of(length: int, rate: float) -> int:
    return max(0, min(int(length * rate), length // MIN_PIECE - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """The item cut into k + 1 pieces of nearly equal length, with their offsets."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str) -> tuple[int, int]:
    """The least edit distance of the item to a stretch of the text, and where the first such ends."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, at = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full  # a match may start anywhere in the text
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        if score < best:
            best, at = score, j + 1
    return best, at


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items, self.auto = [], ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normal(text)
            if not item:
                continue
            k = budget_of(len(item), rate)
            grams = Counter(item[i:i + GRAM] for i in range(len(item) - GRAM + 1))
            for offset, piece in pieces(item, k):
                found.setdefault(piece, []).append((len(self.items), offset + len(piece) - 1))
            self.items.append((item_id, item, k, grams))
        for piece, uses in found.items():
            self.auto.add_word(piece, uses)
        if found:
            self.auto.make_automaton()

    def leaks(self, text: str | None) -> list[dict]:
        if not self.items:
            return []
        text = normal(text)
        places: dict[int, list[int]] = {}
        for end, uses in self.auto.iter(text):
            for item, offset in uses:
                places.setdefault(item, []).append(end - offset)
        out = []
        for item, starts in places.items():
            item_id, body, k, grams = self.items[item]
            best = None
            for a, b in _windows(sorted(starts), len(body), k, len(text)):
                window = text[a:b]
                if k and not _enough(grams, window, len(body), k):
                    continue
                edits, at = (0, window.find(body) + len(body)) if body in window else myers(body, window)
                if edits <= k and (best is None or edits < best["edits"]):
                    best = {"item_id": item_id, "edits": edits, "budget": k, "ends_at": a + at}
            if best:
                out.append(best)
        return sorted(out, key=lambda x: (x["item_id"], x["edits"], x["ends_at"]))


def _windows(starts: list[int], length: int, k: int, end: int) -> Iterator[tuple[int, int]]:
    """The stretches that a match at one of the places can lie in; those that overlap are one."""
    a = b = None
    for s in starts:
        x, y = max(0, s - k), min(end, s + length + k)
        if b is not None and x <= b:
            b = y
            continue
        if b is not None:
            yield a, b
        a, b = x, y
    if b is not None:
        yield a, b


def _enough(grams: Counter, window: str, length: int, k: int) -> bool:
    """An edit spoils at most GRAM grams of the item; the others must be in the window."""
    need = length - GRAM + 1 - GRAM * k
    if need <= 0:
        return True
    there = {window[i:i + GRAM] for i in range(len(window) - GRAM + 1)}
    return sum(n for g, n in grams.items() if g in there) >= need


_matchers: dict[tuple, Matcher] = {}


def _matcher(name: tuple, items: list[tuple[int, str]], rate: float) -> Matcher:
    """Built once a worker; the last block is kept."""
    if name not in _matchers:
        _matchers.clear()
        _matchers[name] = Matcher(items, rate)
    return _matchers[name]


def annotate(docs: DataFrame, items: DataFrame, rate: float = RATE, text: str = "text", item_id: str = "item_id",
             item_text: str = "text", block_chars: int = BLOCK_CHARS, name: str = "leaks") -> DataFrame:
    """Add ``name`` to every row: the items found in its whole text, each with its least distance. A given column of that name is replaced."""
    given = items.select(F.col(item_id).cast("long").alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = given.agg(F.sum(F.length("t") + 100)).first()[0] or 0
    count = max(1, -(-int(total) // block_chars))
    docs = docs.withColumn(name, F.array().cast(LEAK_SQL))
    for n in range(count):
        part = given.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == n) if count > 1 else given
        block = sorted(((r["i"], r["t"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        shared = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.mapInArrow(_finder(shared, rate, text, name), docs.schema)
        if n + 1 < count:
            docs = stored(docs, "leaks")
            shared.unpersist()
    return docs


def _finder(shared, rate: float, text: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        matcher = _matcher((len(items), hash(tuple(items)), rate), items, rate)
        for block in blocks(batches, text):
            at = block.schema.get_field_index(name)
            before = block.column(at).to_pylist()
            found = [b + matcher.leaks(t) for b, t in zip(before, block.column(text).to_pylist())]
            yield block.set_column(at, pa.field(name, pa.list_(LEAK)), pa.array(found, pa.list_(LEAK)))
            release()

    return run
