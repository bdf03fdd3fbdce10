"""Token ids of whole texts with the tokenizers library, each distinct unit encoded once a block.

A unit starts at a run of ASCII white space, or where an ASCII mark follows an ASCII letter. The
pre-tokenizer of byte-level BPE never joins bytes across such a place, so the ids of a text are those
of its units in order. Texts with other white space, whose runs could reach across, or with the text
of a special token are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recordlake.llm.text import WHITE, hash_strings, plain, raw

#: White space of the pre-tokenizer outside space and 0x09-0x0D.
OTHER_SPACE = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True
MARKS = np.zeros(256, bool)
MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Bounds of what a worker remembers between blocks: units, and their ids.
REMEMBERED = 600_000
REMEMBERED_IDS = 3_000_000
SLOTS = 1 << 20
#: Units that the library encodes at a time; it keeps far more than the ids of each.
FRESH = 4_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts in order, and the offsets of the texts among them."""
    body, at = raw(texts)
    white = WHITE[body]
    first = np.zeros(len(body) + 1, bool)
    first[1:-1] = (white[1:] & ~white[:-1]) | (MARKS[body[1:]] & LETTERS[body[:-1]])
    first[at] = True
    first[-1] = False
    starts = np.flatnonzero(first[:-1]) if len(body) else np.zeros(0, np.int64)
    offsets = np.append(starts, len(body)).astype(np.int64)
    made = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return made, np.searchsorted(starts, at)


def odd(texts: pa.Array, special: tuple[str, ...]) -> np.ndarray:
    """Whether a text holds what units could cut: other white space, or a special token's text."""
    pattern = "|".join([OTHER_SPACE, *("(" + re.escape(t) + ")" for t in special)])
    return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)


def special_tokens(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


def gather(values: np.ndarray, offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``pick`` of a list array, joined, and their offsets."""
    sizes = np.diff(offsets)[pick]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    where = np.repeat(offsets[:-1][pick] - ends[:-1], sizes)
    where += np.arange(ends[-1])
    return values[where], ends


class Remembered:
    """The ids of units seen before, by 96 bits of hash: 20 bytes a unit and 4 an id, in fixed arrays.

    When it is full, the half that fewer blocks asked for is forgotten.
    """

    def __init__(self, units: int = REMEMBERED, ids: int = REMEMBERED_IDS, slots: int = SLOTS):
        self.mask = np.uint64(slots - 1)
        self.slot = np.full(slots, -1, np.int32)
        self.key, self.check, self.hits = np.zeros(units, np.uint64), np.zeros(units, np.uint32), np.zeros(units, np.int32)
        self.ends = np.zeros(units + 1, np.int64)
        self.ids = np.zeros(ids, np.uint32)
        self.n = 0

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The place of each unit, or -1."""
        out, live, at = np.full(len(key), -1, np.int64), np.arange(len(key)), (key & self.mask).astype(np.int64)
        while len(live):
            there = self.slot[at[live]]
            live, there = live[there >= 0], there[there >= 0]
            same = (self.key[there] == key[live]) & (self.check[there] == check[live])
            out[live[same]] = there[same]
            live = live[~same]
            at[live] = at[live] + 1 & int(self.mask)
        return out

    def add(self, key: np.ndarray, check: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Distinct new units; more of them than there is room for are not kept."""
        if self.n + len(key) > len(self.key) or self.ends[self.n] + len(ids) > len(self.ids):
            self._forget()
        room = min(len(key), len(self.key) - self.n, int(np.searchsorted(np.cumsum(sizes), len(self.ids) - self.ends[self.n], side="right")))
        a, b = self.n, self.n + room
        self.key[a:b], self.check[a:b], self.hits[a:b] = key[:room], check[:room], 1
        self.ends[a + 1:b + 1] = self.ends[a] + np.cumsum(sizes[:room])
        self.ids[self.ends[a]:self.ends[b]] = ids[:self.ends[b] - self.ends[a]]
        self.n = b
        self._place(np.arange(a, b))

    def _place(self, live: np.ndarray) -> None:
        at = (self.key[live] & self.mask).astype(np.int64)
        while len(live):
            free = self.slot[at] < 0
            self.slot[at[free]] = live[free]  # of several units at one place, one stays
            left = self.slot[at] != live
            live, at = live[left], at[left] + 1 & int(self.mask)

    def _forget(self) -> None:
        keep = np.sort(np.argsort(-self.hits[:self.n], kind="stable")[:self.n // 2])
        sizes = np.diff(self.ends[:self.n + 1])
        ids, _ = gather(self.ids, self.ends[:self.n + 1], keep)
        self.key[:len(keep)], self.check[:len(keep)], self.hits[:len(keep)] = self.key[keep], self.check[keep], self.hits[keep] // 2
        self.ends[1:len(keep) + 1] = np.cumsum(sizes[keep])
        self.ids[:len(ids)] = ids
        self.n = len(keep)
        self.slot.fill(-1)
        self._place(np.arange(self.n))

    def lists(self, names: pa.Array, tok) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct units as one array of lists: offsets and values."""
        key, check = hash_strings(names), hash_strings(names, 2).astype(np.uint32)
        found = self.find(key, check)
        old, fresh = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
        self.hits[found[old]] += 1
        sizes = np.zeros(len(names), np.int64)
        sizes[old] = np.diff(self.ends)[found[old]]
        made = []
        for first in range(0, len(fresh), FRESH):
            part = fresh[first:first + FRESH]
            lists = [e.ids for e in tok.encode_batch_fast(names.take(pa.array(part)).to_pylist(), add_special_tokens=False)]
            sizes[part] = np.fromiter(map(len, lists), np.int64, len(lists))
            made.append(np.fromiter(chain.from_iterable(lists), np.uint32))
        new = np.concatenate(made) if made else np.zeros(0, np.uint32)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        values = np.zeros(offsets[-1], np.uint32)
        for rows, ids in ((old, gather(self.ids, self.ends, found[old])[0]), (fresh, new)):
            ends = np.cumsum(sizes[rows])
            values[np.repeat(offsets[rows] - (ends - sizes[rows]), sizes[rows]) + np.arange(len(ids))] = ids
        self.add(key[fresh], check[fresh], sizes[fresh], new)
        return offsets, values


@lru_cache(maxsize=1)
def remembered(path: str) -> Remembered:
    return Remembered()


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in order as unsigned 32-bit integers, and the offsets of the texts."""
    tok = tokenizer(path)
    strange = odd(texts, special_tokens(path))
    if strange.any():
        whole = {int(i): np.array(tok.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32) for i in np.flatnonzero(strange)}
        rest, at = token_ids(pc.if_else(pa.array(strange), "", texts), path)
        lists = [whole.get(i, rest[at[i]:at[i + 1]]) for i in range(len(texts))]
        return np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    made, at = units(texts)
    coded = made.dictionary_encode()
    offsets, values = remembered(path).lists(plain(coded.dictionary), tok)
    ids, ends = gather(values, offsets, coded.indices.to_numpy().astype(np.int64))
    return ids, ends[at]
