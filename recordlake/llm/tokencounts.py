"""Token counts at every prefix, by dynamic programming over byte-pair tokens.

In a byte-pair vocabulary the encoding of a string ends in one token that fits: one that is a suffix
of the string and whose neighbour, the last token of what is left, does not merge with it earlier.
So the last token and the count of every prefix follow from those of shorter prefixes, left to
right, without encoding any prefix again. Texts are cut into units (see ``tokens``), which encode on
their own; a text's counts are the running sum over its units, and the count at a place inside a unit
is that sum plus the unit's own table. Truncation to a budget reads the same tables.

Nulls and edges: a null text counts as an empty one, with 0 tokens. Special tokens' texts inside a
text count as one token each. Repeated rows are counted alike; extra columns pass through.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from recordlake.llm.text import blocks, plain, widened
from recordlake.llm.tokens import odd, units

#: Bounds of what a worker remembers: counts of units, and pairs of tokens.
UNITS = 600_000
PAIRS = 500_000
TABLES = 100_000
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the others for the letters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """The vocabulary of a byte-level BPE tokenizer file, and tables of prefix counts."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path) as f:
            spec = json.load(f)
        letter = byte_letters()
        ids = {name: i for name, i in spec["model"]["vocab"].items()}
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(merges)}
        parts = {ids[a + b]: (ids[a], ids[b], r) for r, (a, b) in enumerate(merges)}
        self.right, self.left = {}, {}
        for i in ids.values():
            self.right[i], self.left[i] = self._chain(parts, i, 1), self._chain(parts, i, 0)
        whole = set()
        self.token: dict[bytes, int] = {}
        for name, i in sorted(ids.items(), key=lambda x: parts.get(x[1], (0, 0, -1))[2]):
            a, b, r = parts.get(i, (None, None, None))
            # A token that its own bytes do not encode to never ends an encoding.
            if a is None or (a in whole and b in whole and not self._merges_across(a, b, r)):
                whole.add(i)
                self.token[bytes(letter[c] for c in name)] = i
        self.endings = {t[k:] for t in self.token for k in range(len(t))}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cut = regex.compile("|".join(f"({regex.escape(t)})" for t in self.special)) if self.special else None
        self.short, self.space = regex.compile("'(?:[stmd]|re|ve|ll)"), regex.compile(r"\s+")
        self.tables: dict[str, list[int]] = {}
        self.fits: dict[int, bool] = {}
        self.known: dict[str, int] = {}

    @staticmethod
    def _chain(parts: dict, i: int, side: int) -> list[tuple[int, int]]:
        """What stands at one end of a token as it is built, latest first, and the rank that ends it."""
        out, until = [], NEVER
        while True:
            out.append((i, until))
            if i not in parts:
                return out
            until, i = parts[i][2], parts[i][side]

    def _merges_across(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether a merge joins the end of ``a`` and the start of ``b`` while both are being built.

        Merges go by rank, and from the left among equals: at a tie the one on the left wins.
        """
        for x, x_until in self.right[a]:
            for y, y_until in self.left[b]:
                r = self.rank.get((x, y))
                if r is not None and r < min(x_until, before) and r <= y_until:
                    return True
        return False

    def _fit(self, a: int, b: int) -> bool:
        key = a << 20 | b
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            found = self.fits[key] = not self._merges_across(a, b)
        return found

    def table(self, piece: bytes) -> list[int]:
        """Token counts of all prefixes of one piece, byte by byte."""
        counts, last = [0], [-1]
        token, endings = self.token, self.endings
        for i in range(1, len(piece) + 1):
            j, fitting = i - 1, []
            while j >= 0 and piece[j:i] in endings:
                t = token.get(piece[j:i])
                if t is not None:
                    fitting.append((j, t))
                j -= 1
            for j, t in reversed(fitting):
                if j == 0 or self._fit(last[j], t):
                    break
            counts.append(counts[j] + 1)
            last.append(t)
        return counts

    def count(self, text: str) -> int:
        """Tokens of a whole unit or text."""
        found = self.known.get(text)
        if found is None:
            sections = self.cut.split(text) if self.cut else [text]
            found = 0
            for section in sections:
                if section is None:
                    continue
                if section in self.special:
                    found += 1
                    continue
                for piece in self.pattern.findall(section):
                    body = piece.encode()
                    found += 1 if body in self.token else self.table(body)[-1]
            if len(self.known) < UNITS and len(text) < 100:
                self.known[text] = found
        return found

    def prefixes(self, text: str) -> list[int]:
        """Token counts of all prefixes of a text, character by character, in one pass over its pieces."""
        out, before, tail, at_tail = [0], 0, "", 0
        for section in self.cut.split(text) if self.cut else [text]:
            if section is None or section == "":
                continue
            if section in self.special:
                # A part of a special token's text is plain text that goes on from the last piece.
                out += [at_tail + self._plain(tail + section[:j]) for j in range(1, len(section))]
                before += 1
                out.append(before)
                tail, at_tail = "", before
                continue
            counts, start, at_start = self._section(section)
            out += [before + n for n in counts[1:]]
            tail, at_tail = section[start:], before + at_start
            before += counts[-1]
        return out

    def _plain(self, text: str) -> int:
        return sum(self._by_char(p)[-1] for p in self.pattern.findall(text))

    def _by_char(self, piece: str) -> list[int]:
        """The table of a piece at the ends of its characters; those of short pieces are remembered."""
        found = self.tables.get(piece)
        if found is None:
            counts = self.table(piece.encode())
            at, found = 0, [0]
            for c in piece:
                at += len(c.encode())
                found.append(counts[at])
            if len(piece) < 40 and len(self.tables) < TABLES:
                self.tables[piece] = found
        return found

    def _section(self, s: str) -> tuple[list[int], int, int]:
        """Counts of all prefixes of a text without special tokens; where its last pieces start, and the count there.

        A prefix is cut into the pieces of the whole text but for its last one. Of a run of letters,
        numbers or marks, a part is such a run too. White space that a prefix ends with is one piece,
        whatever follows takes from it; and of a contraction a part is cut anew.
        """
        counts, total, run, start = [0] * (len(s) + 1), 0, None, (0, 0)
        for m in self.pattern.finditer(s):
            a, b = m.span()
            piece = m.group()
            white = self.space.fullmatch(piece) is not None
            if self.short.fullmatch(piece):
                here = [self._plain(s[a:a + i]) for i in range(b - a + 1)]
            else:
                here = self._by_char(piece)
            counts[a + 1:b + 1] = [total + n for n in here[1:]]
            if run is None or not self.space.fullmatch(piece[0]):
                start = (a, total)
            else:
                counts[a + 1] = run
            if white and run is None and b < len(s) and self.space.fullmatch(s[b]):
                run = total + self._by_char(s[a:b + 1])[-1]
            elif not white:
                run = None
            total += here[-1]
        return counts, *start

@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def unit_counts(texts: pa.Array, path: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The units of all texts, the offsets of the texts among them, and the count before each unit.

    A text that units could cut wrongly is one unit.
    """
    c = counter(path)
    strange = odd(texts, c.special)
    made, at = units(texts)
    if strange.any():
        made, at = _whole(texts, strange, made, at)
    coded = made.dictionary_encode()
    each = np.array([c.count(u) for u in coded.dictionary.to_pylist()], np.int64)
    sums = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])]) if len(each) else np.zeros(1, np.int64)
    return made, at, sums


def _whole(texts: pa.Array, strange: np.ndarray, made: pa.Array, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    parts, sizes = [], []
    for i, odd_one in enumerate(strange):
        part = texts.slice(i, 1) if odd_one else made.slice(at[i], at[i + 1] - at[i])
        parts.append(part.cast(pa.large_string()))
        sizes.append(len(part))
    return pa.concat_arrays(parts), np.concatenate([[0], np.cumsum(sizes)])


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` and ``n_tokens`` to every row."""
    docs, schema = widened(docs, {"n_bytes": "long", "n_tokens": "long"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            texts = plain(block.column(text))
            _, at, sums = unit_counts(texts, path)
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pc.binary_length(texts).cast(pa.int64()), pa.array(np.diff(sums[at]))], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def prefix_counts(text: str | None, path: str) -> list[int]:
    """Token counts of all prefixes of a text, character by character."""
    made, _, sums = unit_counts(pa.array([text or ""], pa.large_string()), path)
    out = [0]
    for before, unit in zip(sums, made.to_pylist()):
        out += [int(before) + n for n in counter(path).prefixes(unit)[1:]]
    return out


def truncate(docs: DataFrame, path: str, budget: int, text: str = "text") -> DataFrame:
    """Add ``cut_chars`` and ``cut_tokens``: the longest prefix of the text within the budget.

    A prefix that ends inside a unit has at least one token more than the units before it, so only
    the last unit that starts below the budget is looked into.
    """
    docs, schema = widened(docs, {"cut_chars": "long", "cut_tokens": "long"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            made, at, sums = unit_counts(plain(block.column(text)), path)
            chars = np.concatenate([[0], np.cumsum(pc.utf8_length(made).to_numpy(zero_copy_only=False))]).astype(np.int64)
            cut, used = [], []
            for a, b in zip(at, at[1:]):
                k = int(np.searchsorted(sums[a:b + 1], sums[a] + budget, side="right")) - 1
                if a + k == b:
                    cut.append(int(chars[b] - chars[a]))
                    used.append(int(sums[b] - sums[a]))
                    continue
                before = int(sums[a + k] - sums[a])
                inside = counter(path).prefixes(made[int(a + k)].as_py())
                more = max(i for i, n in enumerate(inside) if before + n <= budget)
                cut.append(int(chars[a + k] - chars[a]) + more)
                used.append(before + inside[more])
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(cut, pa.int64()), pa.array(used, pa.int64())], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
