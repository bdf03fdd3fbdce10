"""Scoring with a hidden Markov language model, and with smoothed word counts.

Word counts. Every block of documents gives its distinct words, as 64-bit hashes in order, with
training counts and postings; the reducer of a hash range adds up each word's count over all blocks
and answers each block with its documents' partial sums. Neither words nor counts pass the driver.

Model. The ``VOCABULARY`` most frequent training words are symbols of their own; other words are
symbols by their last two bytes, and such a word's probability within its symbol is its smoothed share of
the symbol's training tokens. One more symbol ends a text. Latent states emit symbols. Baum-Welch
counts come from every training token, in windows of ``WINDOW`` tokens, are added up across
partitions by Spark, and only the model's own size returns to the driver. A text's score is its exact
likelihood by the scaled forward recursion over its whole length.

Nulls and edges: a null or empty text is the end token alone. Rows that repeat an id or are equal
are scored one by one. With no training document all counts are 0 and the model is uniform. Words
are runs of bytes other than space and 0x09-0x0D after A-Z are lowered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.text import blocks, hash_strings, plain, raw, words
from recordlake.session import stored

STATES = 8
VOCABULARY = 3000
CLASSES = 256
WINDOW = 256
ROUNDS = 4
ADD = 0.1
BATCH = 4096


@dataclass
class Model:
    """Latent states over symbols; ``vocab`` has the hashes of the words that are symbols, ascending."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    vocab: np.ndarray


# ---- words ------------------------------------------------------------------------------------


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word codes of all texts, their offsets, and each distinct word's hash and class."""
    flat, at = words(texts)
    coded = flat.dictionary_encode()
    names = plain(coded.dictionary)
    body, ends = raw(names)
    last = body[ends[1:] - 1].astype(np.int64) if len(names) else np.zeros(0, np.int64)
    before = np.where(np.diff(ends) > 1, body[np.maximum(ends[1:] - 2, 0)], 0).astype(np.int64) if len(names) else last
    return coded.indices.to_numpy(), at, hash_strings(names), (last * 31 + before * 7) % CLASSES


_COUNTS = ("bucket int, block string, hashes binary, train binary, classes binary, fan binary, docs binary, times binary, "
           "width int, ids binary, known binary, held binary, marks binary, sizes binary")


def _small(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint16 if not len(values) or values.max() < 1 << 16 else np.uint32)


def _spread(buckets: int):
    names = [c.split()[0] for c in _COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for block in blocks(batches):
            held = block.column("held").to_numpy(zero_copy_only=False).astype(bool)
            codes, at, hashes, classes = _coded(plain(block.column("text")))
            n, name = len(held), f"{part}-{number}"
            number += 1
            order = np.argsort(hashes)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            owner = np.repeat(np.arange(n), np.diff(at))
            posting, times = np.unique(rank[codes] * n + owner, return_counts=True)
            word, doc = posting // max(n, 1), posting % max(n, 1)
            train = np.bincount(word, weights=times * ~held[doc], minlength=len(order)).astype(np.int64)
            fan = np.bincount(word, minlength=len(order))
            hashes, classes = hashes[order], classes[order]
            edge = ((np.arange(1, buckets, dtype=object) << 64) // buckets).astype(np.uint64)
            cut_words = np.concatenate([[0], np.searchsorted(hashes, edge), [len(hashes)]])
            cut_posts = np.searchsorted(word, cut_words)
            rows = []
            for b in range(buckets):
                w, p = slice(cut_words[b], cut_words[b + 1]), slice(cut_posts[b], cut_posts[b + 1])
                if cut_words[b] == cut_words[b + 1]:
                    continue
                parts = [_small(x) for x in (train[w], fan[w], doc[p], times[p])]
                wide = int(any(x.dtype == np.uint32 for x in parts))
                t, f, d, c = (x.astype(np.uint32 if wide else np.uint16).tobytes() for x in parts)
                rows.append((b, name, hashes[w].tobytes(), t, classes[w].astype(np.uint8).tobytes(), f, d, c, 4 if wide else 2, *[None] * 5))
            ids = block.column("doc_id")
            rows.append((number % buckets, name, *[None] * 7, ids.fill_null(0).to_numpy().astype(np.int64).tobytes(),
                         ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(), held.astype(np.uint8).tobytes(),
                         block.column("mark").to_numpy().astype(np.int64).tobytes(), np.diff(at).astype(np.int64).tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_schema())

    return run


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _COUNTS.split(", ")])


_SUMS = ("kind string, block string, bucket int, logs binary, seen binary, word long, class int, n long, v long, "
         "ids binary, known binary, held binary, marks binary, sizes binary")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All blobs of one hash range: counts of its words over all blocks, and every block's partial sums."""
    kept, at = [], TaskContext.get().partitionId()
    kinds = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _SUMS.split(", ")])

    def made(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            if row["ids"] is not None:
                yield made([{"kind": "docs", **{k: row[k] for k in ("block", "ids", "known", "held", "marks", "sizes")}}])
            else:
                kept.append(row)
    if not kept:
        return
    hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in kept])
    kind = {2: np.uint16, 4: np.uint32}
    train = np.concatenate([np.frombuffer(r["train"], kind[r["width"]]).astype(np.int64) for r in kept])
    classes = np.concatenate([np.frombuffer(r["classes"], np.uint8) for r in kept])
    unique, first, where = np.unique(hashes, return_index=True, return_inverse=True)
    count, group = np.bincount(where, weights=train, minlength=len(unique)).astype(np.int64), classes[first]
    n = np.bincount(group, weights=count, minlength=CLASSES).astype(np.int64)
    v = np.bincount(group[count > 0], minlength=CLASSES)
    yield made([{"kind": "class", "class": g, "n": int(n[g]), "v": int(v[g])} for g in range(CLASSES)])
    top = np.lexsort((unique, -count))[:VOCABULARY]
    yield made([{"kind": "word", "word": int(unique[i].view(np.int64)), "class": int(group[i]), "n": int(count[i])} for i in top if count[i]])
    log, position = np.log10(count + ADD), 0
    for row in kept:
        size = len(row["hashes"]) // 8
        mine = where[position:position + size]
        position += size
        fan, docs, times = (np.frombuffer(row[c], kind[row["width"]]).astype(np.int64) for c in ("fan", "docs", "times"))
        mine = np.repeat(mine, fan)
        # Only the documents that have words here are named.
        who, inside = np.unique(docs, return_inverse=True)
        logs = np.bincount(inside, weights=times * log[mine])
        seen = np.bincount(inside, weights=times * (count[mine] > 0)).astype(np.uint32)
        yield made([{"kind": "sums", "block": row["block"], "bucket": at, "logs": logs.tobytes(), "seen": seen.tobytes(), "ids": who.astype(np.uint32).tobytes()}])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block follow each other, its documents first: one row per document."""
    block, docs, logs, seen = None, None, None, None

    def done() -> Iterator[pa.RecordBatch]:
        if block is not None:
            n = len(logs)
            ids = pa.array(np.frombuffer(docs["ids"], np.int64), mask=~np.frombuffer(docs["known"], np.uint8).astype(bool))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.frombuffer(docs["marks"], np.int64)), pa.array(np.frombuffer(docs["held"], np.uint8).astype(bool)),
                 pa.array(np.frombuffer(docs["sizes"], np.int64)), pa.array(seen), pa.array(logs)],
                ["doc_id", "mark", "held_out", "n_words", "n_seen", "logs"]) if n else pa.RecordBatch.from_pylist([])

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == "docs":
                yield from done()
                block, docs = row["block"], row
                logs, seen = np.zeros(len(row["held"])), np.zeros(len(row["held"]), np.int64)
            else:
                who = np.frombuffer(row["ids"], np.uint32)
                logs[who] += np.frombuffer(row["logs"], np.float64)
                seen[who] += np.frombuffer(row["seen"], np.uint32)
    yield from done()


# ---- the model --------------------------------------------------------------------------------


def _symbols(vocab: np.ndarray):
    """Each text's symbols, the end symbol last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            codes, at, hashes, classes = _coded(plain(block.column("text")))
            spot = np.minimum(np.searchsorted(vocab, hashes), max(len(vocab) - 1, 0))
            of = np.where(vocab[spot] == hashes, spot, len(vocab) + classes) if len(vocab) else classes
            flat = np.insert(of[codes].astype(np.uint16), at[1:], np.uint16(len(vocab) + CLASSES))
            at = at + np.arange(len(at))
            offsets = pa.py_buffer((2 * at).astype(np.int64))
            body = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(flat))])
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("mark"), block.column("held"), body.cast(pa.binary())], ["doc_id", "mark", "held", "symbols"])

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    body, at = raw(pc.fill_null(column.cast(pa.large_binary()), b""))
    return np.frombuffer(np.ascontiguousarray(body), np.uint16), at // 2


def forward(flat: np.ndarray, at: np.ndarray, model: Model) -> np.ndarray:
    """The exact natural log likelihood of each sequence, all sequences of a block side by side."""
    sizes = np.diff(at)
    order = np.argsort(-sizes, kind="stable")
    starts, out = at[:-1][order], np.zeros(len(sizes))
    live = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    emit, a = np.ascontiguousarray(model.emit.T), None
    for t, n in enumerate(live):
        seen = emit[flat[starts[:n] + t]]
        a = seen * model.start if t == 0 else (a[:n] @ model.move) * seen
        scale = a.sum(axis=1)
        a /= scale[:, None]
        out[:n] += np.log(scale)
    back = np.empty(len(order))
    back[order] = out
    return back


def expected(flat: np.ndarray, at: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of starts, moves and emissions over windows of the sequences."""
    s, m = model.emit.shape
    start, move, emit_n = np.zeros(s), np.zeros((s, s)), np.zeros((m, s))
    sizes = np.diff(at)
    pieces = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    begin = at[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * WINDOW
    length = np.minimum(WINDOW, at[1:][owner] - begin)
    begins = begin == at[:-1][owner]
    order = np.argsort(-length, kind="stable")
    emit = np.ascontiguousarray(model.emit.T)
    for i in range(0, len(order), BATCH):
        b, n = begin[order[i:i + BATCH]], length[order[i:i + BATCH]]
        live = np.searchsorted(-n, -np.arange(1, int(n.max()) + 1), side="right")
        syms = [flat[b[:k] + t] for t, k in enumerate(live)]
        alphas, scales = [], []
        for t, k in enumerate(live):
            a = emit[syms[t]] * (model.start if t == 0 else alphas[-1][:k] @ model.move)
            scales.append(a.sum(axis=1))
            alphas.append(a / scales[-1][:, None])
        beta = np.ones((live[-1], s))
        gammas = [None] * len(live)
        for t in range(len(live) - 1, -1, -1):
            gammas[t] = alphas[t] * beta
            if t:
                k = live[t]
                ahead = emit[syms[t]] * beta / scales[t][:, None]
                move += alphas[t - 1][:k].T @ ahead
                beta = np.ones((live[t - 1], s))
                beta[:k] = ahead @ model.move.T
        # Only the window a text starts with tells how texts start.
        start += gammas[0][begins[order[i:i + BATCH]]].sum(axis=0)
        sym, gamma = np.concatenate(syms), np.concatenate(gammas)
        for j in range(s):
            emit_n[:, j] += np.bincount(sym, weights=gamma[:, j], minlength=m)
    return start, move * model.move, emit_n.T


def _fresh(shares: np.ndarray, vocab: np.ndarray, states: int, seed: int = 3) -> Model:
    rng = np.random.default_rng(seed)
    emit = shares * np.exp(0.5 * rng.standard_normal((states, len(shares))))
    move = np.full((states, states), 0.05 / states) + 0.95 * np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True), vocab)


def _learn(symbols: DataFrame, model: Model, shares: np.ndarray) -> Model:
    """One round: counts of every task are rows that Spark adds up; the sums have the model's size."""
    states, size = model.emit.shape
    shared = symbols.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            made = expected(*_flat(batch.column("symbols")), shared.value)
            total = made if total is None else tuple(x + y for x, y in zip(total, made))
        if total is not None:
            values = np.concatenate([total[0], total[1].ravel(), total[2].ravel()])
            some = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(values[some])], ["i", "x"])

    sums = np.zeros(states + states * states + states * size)
    for row in symbols.where(~F.col("held")).select("symbols").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        sums[row["i"]] = row["x"]
    start = sums[:states] + 1
    move = sums[states:states + states * states].reshape(states, states) + 0.01
    emit = sums[states + states * states:].reshape(states, size) + 1.0 * shares
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True), model.vocab)


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark: SparkSession = docs.sparkSession
    buckets = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("mark"),
                       held_out.alias("held"), F.col(text).alias("text"))
    sums = stored(rows.mapInArrow(_spread(buckets), _COUNTS).repartitionById(buckets, F.col("bucket")).mapInArrow(_count, _SUMS), "counts")
    per = sums.where("kind = 'class'").groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    group_n, group_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per:
        group_n[r["class"]], group_v[r["class"]] = r["n"], r["v"]
    trained = rows.where("not held").count()
    total, distinct = int(group_n.sum()) + trained, int(group_v.sum()) + (trained > 0)
    top = sums.where("kind = 'word'").orderBy(F.desc("n"), "word").limit(VOCABULARY).select("word", "class", "n").collect()
    top = sorted(top, key=lambda r: int(np.int64(r["word"]).view(np.uint64)))
    vocab = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    vocab_n = np.array([r["n"] for r in top], np.float64)
    for r in top:
        group_n[r["class"]] -= r["n"]
        group_v[r["class"]] -= 1
    shares = np.concatenate([vocab_n, group_n, [trained]]) + ADD
    shares /= shares.sum()

    symbols = stored(rows.mapInArrow(_symbols(vocab), "doc_id long, mark long, held boolean, symbols binary"), "symbols")
    model = _fresh(shares, vocab, states)
    for _ in range(rounds):
        model = _learn(symbols, model, shares)
    shared = spark.sparkContext.broadcast(model)
    # What a symbol adds to its own probability: for a class, the share of the word within it, whose
    # count is in the sums already; for a word of the vocabulary, its count is taken out of them.
    extra = np.concatenate([-np.log10(vocab_n + ADD), -np.log10(group_n + ADD * (group_v + 1)), [0.0]])

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "symbols", 8 << 20):
            flat, at = _flat(block.column("symbols"))
            more = np.add.reduceat(extra[flat], at[:-1]) if len(flat) else np.zeros(0)
            ll = forward(flat, at, shared.value) / np.log(10) + more
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("mark"), pa.array(ll)], ["doc_id", "mark", "part"])

    parts = symbols.select("doc_id", "mark", "symbols").mapInArrow(likelihood, "doc_id long, mark long, part double")
    parts = parts.groupBy("doc_id", "mark").agg(F.first("part").alias("part")).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "part")
    base = (
        sums.where("kind in ('docs', 'sums')").repartition("block").sortWithinPartitions("block", "kind", "bucket")
        .mapInArrow(_add_up, "doc_id long, mark long, held_out boolean, n_words long, n_seen long, logs double")
    )
    joined = base.join(parts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    end = float(np.log10(trained + ADD))
    norm = float(np.log10(total + ADD * (distinct + 1)))
    tokens = F.col("n_words") + 1
    return joined.select(
        F.col("doc_id").alias(key), "held_out", tokens.alias("n_tokens"), (F.col("n_seen") + F.lit(int(trained > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("logs") + F.lit(end) - tokens * F.lit(norm)).alias("base_score"),
        (F.col("logs") + F.col("part")).alias("score"))
