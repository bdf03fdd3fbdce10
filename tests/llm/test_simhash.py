"""Fingerprints and their links against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from recordlake.llm import queries, simhash
from test_edges import corpus, make, words


def fingerprint_by_hand(text, width=3):
    w = words(text)
    grams = [b" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_by_hand(fps, tau):
    """The smallest fingerprint (as signed) that each reaches."""
    left, out = set(fps), {}
    while left:
        todo, seen = [left.pop()], []
        while todo:
            x = todo.pop()
            seen.append(x)
            near = [y for y in left if (x ^ y).bit_count() <= tau]
            left -= set(near)
            todo += near
        low = min(seen)
        out |= dict.fromkeys(seen, low)
    return out


def test_fingerprints(spark):
    texts = ["", None, " \t", "one", "One two", "a b c", "A  b\x0bc\nd", "é É x y " * 50, "the river " * 70_000]
    for t in texts:
        assert simhash.fingerprint(t, 3) == fingerprint_by_hand(t)
    # The hash is the one Spark has built in.
    got = spark.sql("select xxhash64('a b c') as h").first()["h"]
    assert got % (1 << 64) == simhash.fingerprint("a b c", 3)


@pytest.mark.parametrize("tau,parts,most", [(2, None, 256), (2, 2, 256), (2, 3, 4), (2, 4, 8), (1, 2, 256), (3, 3, 6), (0, 1, 256)])
def test_links_against_brute_force(spark, tau, parts, most):
    rng = random.Random(tau * 10 + most)
    fps = {0, (1 << 64) - 1}
    for _ in range(20):  # chains and balls of near fingerprints, and one crowded ball
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            fps.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << rng.randrange(30)) ^ (1 << rng.randrange(30)) ^ (1 << rng.randrange(30)) for _ in range(120)}
    fps |= {rng.getrandbits(64) for _ in range(300)}
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in sorted(fps)], "fp long")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame, tau, parts, most).collect()]
    label = {x: x for x in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    assert {x: find(x) for x in fps} == components_by_hand(fps, tau)
    assert len(edges) < 4 * len(fps) * 65


def test_budgets_and_parts():
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for i in range(1, 24):  # 24 bits that say the same
        fps = fps & ~np.uint64(1 << i) | (fps & np.uint64(1)) << np.uint64(i)
    bits = simhash._bits(fps).astype(float)
    with np.errstate(invalid="ignore"):
        corr = np.nan_to_num(np.abs(np.corrcoef(bits.T)))
    parts = simhash.group_bits(corr, 3)
    assert sorted(b for p in parts for b in p) == list(range(64)) and [len(p) for p in parts] == [22, 21, 21]
    assert set(parts[0]) <= set(range(24))
    plan = simhash.Plan(parts, 2, len(fps))
    for subs in plan.subs:
        mine = []
        for sub in subs:
            v = simhash.values_of(fps, sub).astype(np.int64)
            share = np.bincount(v, minlength=1 << len(sub)) / len(fps)
            at = np.arange(1 << len(sub))
            mine.append((sub, np.stack([sum(share[at ^ int(m)] for m in masks) for masks in simhash.flips(len(sub), 2)], axis=1)))
        plan.tables.append(mine)
    budgets = plan.budgets(fps[:500])
    assert (budgets.sum(axis=1) == 2 - 3 + 1).all() and budgets.min() >= -1
    # The part of bits that move together holds half of all at one value: others are asked instead.
    assert (budgets[:, 0] == -1).all() and (budgets[:, 1:].max(axis=1) >= 1).all()
    # No other allocation of the sum has fewer expected candidates.
    cost = plan.expected(fps[:500])
    for i in range(0, 500, 50):
        def work(t, i=i):
            return sum(cost[k][i, t[k]] + simhash.PROBE * sum(simhash._choose(len(parts[k]), r) for r in range(t[k] + 1)) for k in range(3) if t[k] >= 0)
        best = min(work((a, b, -a - b)) for a in range(-1, 3) for b in range(-1, 3) if -1 <= -a - b <= 2)
        assert abs(work(tuple(int(x) for x in budgets[i])) - best) <= 1e-6 * best + 1e-6


def near_corpus():
    rows, rng = corpus(), random.Random(8)
    base = [f"w{rng.randint(0, 500)}" for _ in range(2500)]
    for k in range(40):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 9)}"
        rows.append((1000 + k, " ".join(t), "en", "s0"))
    return rows + [(None, " ".join(base), "en", "s0"), (None, "nothing like it at all", None, None), (1000, rows[-1][1], "en", "s0")]


@pytest.mark.parametrize("most", [256, 3])
def test_components(spark, most):
    rows = near_corpus()
    got = simhash.near_components(make(spark, rows).withColumnsRenamed({"score": "fp", "frag": "component_id", "size": "rep"}), most=most).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    by_hand = {(i, t): fingerprint_by_hand(t) for i, t, *_ in rows}
    comp = components_by_hand(set(by_hand.values()), 2)
    least = {}
    for (i, t), fp in by_hand.items():
        if i is not None:
            least[comp[fp]] = min(i, least.get(comp[fp], i))
    want = Counter((i, f"{by_hand[i, t]:016x}", least.get(comp[by_hand[i, t]])) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in got) == want
    sizes = Counter(r["component_id"] for r in got)
    assert sizes[1000] > 20 and len({r["fingerprint"] for r in got if r["component_id"] == 1000}) > 5


def test_nothing(spark):
    assert simhash.near_components(make(spark, [])).count() == 0


def test_query_reads_whole_table(spark):
    got = queries.G.queries["op11_simhash_near_dedup"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(texts)
    assert all(r["fingerprint"] == f"{fingerprint_by_hand(texts[r['doc_id']]):016x}" for r in rows)
