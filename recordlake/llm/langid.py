"""Language identification with a byte convolutional network trained in numpy.

The network looks at windows of fixed length: a byte embedding, filters of several widths, the
maximum of each filter over the window, and a softmax over the languages. A whole text is cut into
consecutive windows; their log probabilities are averaged, weighted by their bytes.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0. Rows with a null
language never train. With nothing to learn from, every text is ``und``. Extra columns pass
through; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.llm.text import blocks, plain, raw, release, widened

UNKNOWN = "und"
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Bound of the training sample: labelled rows, and windows taken from each.
TRAIN_ROWS = 3000
WINDOWS_PER_ROW = 2
STRETCH = 4000
EPOCHS = 10
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class ByteNet:
    """The trained network; a few thousand numbers."""

    langs: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def features(self, codes: np.ndarray, keep: bool = False):
        """Pooled filter values of windows of byte codes (0 is padding), and where they were found."""
        x = self.embed[codes]
        n, length, e = x.shape
        pooled, places, views = [], [], []
        for w, f in zip(WIDTHS, self.filters):
            view = np.concatenate([x[:, j:length - w + 1 + j] for j in range(w)], axis=2)
            made = view.reshape(-1, w * e) @ f
            made = made.reshape(n, length - w + 1, -1)
            if keep:
                at = made.argmax(axis=1)
                places.append(at)
                views.append(view)
                pooled.append(np.take_along_axis(made, at[:, None], axis=1)[:, 0])
            else:
                pooled.append(made.max(axis=1))
        return np.concatenate(pooled, axis=1), places, views

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.features(codes)[0] + self.bias, 0)
        z = hidden @ self.out + self.out_bias
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _fresh(langs: list[str], rng: np.random.Generator) -> ByteNet:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    embed = normal(257, EMBED, scale=0.5)
    embed[0] = 0
    hidden = FILTERS * len(WIDTHS)
    return ByteNet(
        langs, embed, [normal(w * EMBED, FILTERS, scale=(w * EMBED) ** -0.5) for w in WIDTHS],
        np.zeros(hidden, np.float32), normal(hidden, len(langs), scale=hidden ** -0.5), np.zeros(len(langs), np.float32))


def _step(net: ByteNet, codes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy, in the order of ``_weights``."""
    n = len(codes)
    pooled, places, views = net.features(codes, keep=True)
    hidden = np.maximum(pooled + net.bias, 0)
    z = hidden @ net.out + net.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), y] -= 1
    p /= n
    g_hidden = (p @ net.out.T) * (hidden > 0)
    g_embed, g_filters, at = np.zeros_like(net.embed), [], 0
    rows = np.arange(n)[:, None]
    for w, f, place, view in zip(WIDTHS, net.filters, places, views):
        g = g_hidden[:, at:at + FILTERS]
        at += FILTERS
        seen = view[rows, place]
        g_filters.append(np.einsum("nfd,nf->df", seen, g))
        back = (g[:, :, None] * f.T[None]).reshape(n, FILTERS, w, EMBED)
        for j in range(w):
            np.add.at(g_embed, codes[rows, place + j], back[:, :, j])
    g_embed[0] = 0
    return [g_embed, *g_filters, g_hidden.sum(axis=0), hidden.T @ p, p.sum(axis=0)]


def _weights(net: ByteNet) -> list[np.ndarray]:
    return [net.embed, *net.filters, net.bias, net.out, net.out_bias]


def windows_of(texts: pa.Array, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte codes of the consecutive windows of each text, the text of each window, its bytes."""
    body, at = raw(texts)
    sizes = np.diff(at)
    counts = -(-sizes // length)
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    start = at[:-1][owner] + (np.arange(len(owner)) - first[owner]) * length
    used = np.minimum(length, at[1:][owner] - start)
    padded = np.concatenate([body, np.zeros(length, np.uint8)])
    codes = padded[start[:, None] + np.arange(length)[None]].astype(np.int16) + 1
    codes[np.arange(length)[None] >= used[:, None]] = 0
    return codes, owner, used


def fit(labelled: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7) -> ByteNet | None:
    """Train on (text, language) rows; the rows fit in memory by the caller's bound."""
    labelled = [(t, lang) for t, lang in labelled if t and lang is not None and LETTER.search(t)]
    if not labelled:
        return None
    rng = np.random.default_rng(seed)
    langs = sorted({lang for _, lang in labelled})
    number = {lang: i for i, lang in enumerate(langs)}
    pieces, labels = [], []
    for text, lang in labelled:
        body = text.encode()
        for _ in range(WINDOWS_PER_ROW):
            # Half of the windows are short, so that short texts are learned too.
            size = int(rng.integers(12, WINDOW + 1)) if rng.random() < 0.5 else WINDOW
            start = int(rng.integers(0, max(1, len(body) - size + 1)))
            pieces.append(body[start:start + size])
            labels.append(number[lang])
    codes = np.zeros((len(pieces), WINDOW), np.int16)
    for i, piece in enumerate(pieces):
        codes[i, :len(piece)] = np.frombuffer(piece, np.uint8).astype(np.int16) + 1
    y = np.array(labels)
    net = _fresh(langs, rng)
    mean = [np.zeros_like(w) for w in _weights(net)]
    var = [np.zeros_like(w) for w in _weights(net)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 64):
            pick = order[at:at + 64]
            step += 1
            for w, g, m, v in zip(_weights(net), _step(net, codes[pick], y[pick]), mean, var):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (0.004 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
    return net


def train(docs: DataFrame, may_train: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
          rows: int = TRAIN_ROWS) -> ByteNet | None:
    """Fit on at most ``rows`` labelled rows, chosen by a hash of the key among all that may train.

    Of each chosen text, a stretch of at most ``STRETCH`` characters at a hashed place is fetched.
    """
    hashed = F.xxhash64(key, F.lit(11))
    place = F.pmod(hashed, F.greatest(F.length(text) - STRETCH, F.lit(0)) + 1).cast("int") + 1
    usable = docs.where(may_train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.substring(F.col(text), place, F.lit(STRETCH)).alias("t"), F.col(lang).alias("l"), hashed.alias("h"))
    # First the hashes alone, then the texts of the chosen rows: tasks send no others.
    last = usable.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    chosen = usable.where(F.col("h") <= F.lit(last)).orderBy("h", "l", "t").limit(rows)
    return fit([(r["t"], r["l"]) for r in chosen.select("t", "l").collect()])


def identify(docs: DataFrame, net: ByteNet | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row, from its whole text."""
    docs, schema = widened(docs, {"lang_pred": "string", "score": "double"})
    names = [f.name for f in schema.fields[:-2]]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            pred, score = _predict(plain(block.column(text)), net)
            columns = [block.column(n) for n in names] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])
            release()

    return docs.select(*names).mapInArrow(predict, schema)


def _predict(texts: pa.Array, net: ByteNet | None) -> tuple[list[str], np.ndarray]:
    n = len(texts)
    letters = np.array([LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)
    if net is None:
        return [UNKNOWN] * n, np.zeros(n)
    total = np.zeros((n, len(net.langs)))
    sizes = np.diff(raw(texts)[1])
    for at, stop in _runs(sizes):
        codes, owner, used = windows_of(texts.slice(at, stop - at))
        for i in range(0, len(codes), 64):
            part = slice(i, i + 64)
            np.add.at(total, at + owner[part], net.log_probs(codes[part]) * used[part, None])
    mean = total / np.maximum(sizes, 1)[:, None]
    p = np.exp(mean - mean.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    return [net.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)], np.where(letters, p[np.arange(n), best], 0.0)


def _runs(sizes: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Rows in runs of about ``limit`` bytes, so that the window table stays small."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, stop
        at = stop
