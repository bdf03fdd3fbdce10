"""Signatures of fragments: texts that are not alike share few, texts that are alike share one at least."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from recordlake.llm import jaccard


def signatures(sets, percent, common=None):
    sizes = np.array([len(s) for s in sets])
    h = np.concatenate([np.sort(np.fromiter(s, np.uint64, len(s))) for s in sets])
    sig, doc = jaccard.signatures(h, np.repeat(np.arange(len(sets)), sizes), sizes, Fraction(percent, 100), *([] if common is None else [np.sort(np.array(sorted(common), np.uint64))]))
    found = [set() for _ in sets]
    for s, d in zip(sig.tolist(), doc.tolist()):
        found[d].add(s)
    return found


def grams(rng, n):
    return {rng.randrange(1 << 64) for _ in range(n)}


@pytest.mark.parametrize("percent", [80, 90])
def test_strangers_share_nothing(percent):
    """Empty fragments alone made groups of a share of all texts, whose pairs grew with the square."""
    rng = random.Random(5)
    found = signatures([grams(rng, rng.randint(60, 600)) for _ in range(400)], percent)
    assert max(Counter(s for f in found for s in f).values()) == 1


def test_a_common_passage_makes_no_group(spark):
    """Fragments that hold n-grams of a passage and nothing else made groups of a share of all texts that have it."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(94)]
    texts = [" ".join(passage + [f"w{rng.randrange(1 << 40)}" for _ in range(rng.randint(300, 360))]) for _ in range(400)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    common = jaccard.common_grams(docs, 5)
    assert len(common) == 90
    h, owner, sizes = jaccard.sets_of(pa.array(texts, pa.large_string()), 5)
    sig, _ = jaccard.signatures(h, owner, sizes, Fraction(80, 100), common)
    assert max(Counter(sig.tolist()).values()) < 8
    assert jaccard.common_grams(docs.limit(0), 5).tolist() == []


@pytest.mark.parametrize("percent", [80, 90])
def test_alike_share_one(percent):
    rng = random.Random(7)
    for n in [*range(2, 40), 75, 76, 113, 114, 200, 400, 900]:
        for _ in range(12):
            a = grams(rng, n)
            b = set(rng.sample(sorted(a), rng.randint(int(n * percent / 100), n))) | grams(rng, rng.randint(0, n * (100 - percent) // percent))
            both = len(a & b)
            if a != b and 100 * both >= percent * len(a | b):
                for common in (None, rng.sample(sorted(a | b), n // 2), a, b - a):
                    x, y = signatures([a, b], percent, common)
                    assert x & y, (n, len(b), both)
    # All in one narrow part of the order, so that most fragments are empty.
    for n in (12, 60, 300):
        a = set(range(7, 7 + n))
        b = (a - {7}) | {3}
        if 100 * (n - 1) >= percent * (n + 1):
            x, y = signatures([a, b], percent)
            assert x & y
