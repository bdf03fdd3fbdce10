"""Scores of the trained models recomputed by plain loops."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordlake.llm import hmm, langid, text
from test_edges import corpus, make, words


@pytest.mark.parametrize("vocabulary", [3000, 5])
def test_composed_score_and_that_it_is_a_distribution(spark, monkeypatch, vocabulary):
    """The score of each text from the last model: latent states over symbols, and words within their classes."""
    models, real = [], hmm._learn
    monkeypatch.setattr(hmm, "_learn", lambda *a: models.append(real(*a)) or models[-1])
    monkeypatch.setattr(hmm, "VOCABULARY", vocabulary)
    rows = [r for r in corpus(n=40) if r[1] is None or len(r[1]) < 3000]
    got = {r["doc_id"]: r for r in hmm.score(make(spark, rows), F.coalesce(F.pmod("doc_id", F.lit(5)), F.lit(0)) == 0, rounds=2).collect()}
    model = models[-1]
    train = [words(t) for i, t, *_ in rows if i is not None and i % 5]
    count = Counter(w for ws in train for w in ws)
    symbol = {int(h): k for k, h in enumerate(model.vocab)}

    def hashed(w):
        return int(text.hash_strings(text.plain(pa.array([w.decode()])))[0])

    def group(w):
        return (w[-1] * 31 + (w[-2] if len(w) > 1 else 0) * 7) % hmm.CLASSES

    rare = [w for w in count if hashed(w) not in symbol]
    n, v = Counter(), Counter()
    for w in rare:
        n[group(w)] += count[w]
        v[group(w)] += 1

    def emission(w):
        """Symbol of a word, and its share of the symbol's mass."""
        if hashed(w) in symbol:
            return symbol[hashed(w)], 1.0
        g = group(w)
        return len(model.vocab) + g, (count[w] + hmm.ADD) / (n[g] + hmm.ADD * (v[g] + 1))

    end = len(model.vocab) + hmm.CLASSES
    for i, t, *_ in rows:
        state = None
        total = 0.0
        for sym, share in [*(emission(w) for w in words(t)), (end, 1.0)]:
            reached = model.start if state is None else [sum(state[a] * model.move[a, b] for a in range(len(state))) for b in range(len(state))]
            state = [reached[s] * model.emit[s, sym] * share for s in range(len(reached))]
            total += math.log10(sum(state))
            state = [x / sum(state) for x in state]
        assert math.isclose(got[i]["score"], total, rel_tol=1e-8, abs_tol=1e-8)
    # All words, one unknown word of each class, and the end: the next token is one of them.
    for s in range(len(model.start)):
        mass = model.emit[s, end] + sum(model.emit[s, emission(w)[0]] * emission(w)[1] for w in count)
        mass += sum(model.emit[s, len(model.vocab) + g] * hmm.ADD / (n[g] + hmm.ADD * (v[g] + 1)) for g in range(hmm.CLASSES))
        assert math.isclose(mass, 1.0, rel_tol=1e-9)


def test_language_by_plain_loops():
    """Every window, filter and position by itself, for a network of random weights."""
    rng = np.random.default_rng(4)
    net = langid._fresh(["en", "fr", "os"], rng)
    net.bias[:] = rng.standard_normal(len(net.bias)) * 0.2
    letters = random.Random(9)
    texts = ["", "12 !", "a", "é", "word", " ".join("".join(letters.choice("abcdéè ") for _ in range(20)) for _ in range(40))]
    pred, score = langid._predict(text.plain(pa.array(texts)), net)
    for t, p, s in zip(texts, pred, score):
        body = t.encode()
        if langid.LETTER.search(t) is None:
            assert (p, s) == ("und", 0.0)
            continue
        total = [0.0] * 3
        for a in range(0, len(body), langid.WINDOW):
            part = body[a:a + langid.WINDOW]
            codes = [c + 1 for c in part] + [0] * (langid.WINDOW - len(part))
            hidden = []
            for w, f in zip(langid.WIDTHS, net.filters):
                for k in range(langid.FILTERS):
                    best = max(sum(float(net.embed[codes[i + j], e]) * float(f[j * langid.EMBED + e, k]) for j in range(w) for e in range(langid.EMBED))
                               for i in range(langid.WINDOW - w + 1))
                    hidden.append(max(best + float(net.bias[len(hidden)]), 0.0))
            z = [sum(h * float(net.out[i, c]) for i, h in enumerate(hidden)) + float(net.out_bias[c]) for c in range(3)]
            norm = math.log(sum(math.exp(x - max(z)) for x in z)) + max(z)
            for c in range(3):
                total[c] += (z[c] - norm) * len(part)
        mean = [x / len(body) for x in total]
        top = max(range(3), key=lambda c: mean[c])
        share = math.exp(mean[top]) / sum(math.exp(x) for x in mean)
        assert p == net.langs[top] and abs(s - share) < 1e-4


def test_only_starts_of_texts_count_as_starts():
    rng = np.random.default_rng(6)
    sizes = [1, 700, 256, 257, 3]
    flat, at = rng.integers(0, 5, sum(sizes)).astype(np.uint16), np.concatenate([[0], np.cumsum(sizes)])
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = hmm.Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 5))), np.zeros(0, np.uint64))
    start, move, emit = hmm.expected(flat, at, model)
    pieces = sum(-(-s // hmm.WINDOW) for s in sizes)
    assert math.isclose(start.sum(), len(sizes)) and math.isclose(move.sum(), sum(sizes) - pieces) and math.isclose(emit.sum(), sum(sizes))
