"""A large group of near copies of which many pairs stay open and are no links."""

import random

from recordlake.llm import jaccard


def smallest_reachable(sets, percent):
    comp = list(range(len(sets)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    return [root(i) for i in range(len(sets))]


def test_pairs_verified_do_not_grow_with_the_square(spark, monkeypatch):
    rng = random.Random(11)
    base, texts = [f"w{i}" for i in range(90)], []
    for i in range(400):
        t = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            t[rng.randrange(90)] = f"x{rng.randrange(10_000)}"
        texts.append(" ".join(t))
    verified, plain = [], jaccard._verify
    monkeypatch.setattr(jaccard, "_verify", lambda pairs, *rest: verified.append(pairs.count()) or plain(pairs, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_components(docs, width=5, percent=80).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(86)} for t in texts]
    want = smallest_reachable(sets, 80)
    assert got == dict(enumerate(want)) and 1 < len(set(want)) < 400
    assert len(verified) == 1
    # Small blocks give the same.
    monkeypatch.setattr(jaccard, "SET_BYTES", 1 << 14)
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", 50)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_components(docs, width=5, percent=80).collect()} == got
