"""Spelling variants against all pairs of words."""

import random

import numpy as np
import pytest

from recordlake.llm import spelling


def distance_one(a, b):
    """By the table of edit distances, without any shortcut."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(row[j] + 1, cur[-1] + 1, row[j - 1] + (x != y)))
        row = cur
    return row[-1] == 1


def by_hand(counts, factor=10):
    out, forms = {}, {}
    for w, n in counts.items():
        near = [x for x in counts if abs(len(x) - len(w)) <= 1 and distance_one(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= factor * n:
            forms[w] = best
        out[w] = (n, len(near), forms.get(w), counts[best] if w in forms else None)
    for w in out:
        root = w
        while root in forms:
            root = forms[root]
        out[w] += (root,)
    return out


def vocabulary(seed, letters="abcdeé", words=60, longest=12):
    rng = random.Random(seed)
    out = {}
    for _ in range(words):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, longest)))
        n = rng.choice([1, 2, 40, 500, 6000])
        out[w] = n
        for _ in range(rng.randint(0, 8)):  # variants, and variants of them
            i, c = rng.randrange(len(w) + 1), rng.choice(letters)
            w = rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]]) or "a"
            out.setdefault(w, max(1, n // rng.choice([1, 5, 12, 30])))
    return out


@pytest.mark.parametrize("options", [{}, {"leaf": 8, "sample": 1000}, {"leaf": 16, "sample": 40}, {"leaf": 32, "cell": 5}])
def test_variants(spark, options):
    counts = vocabulary(len(options) + 3)
    counts |= {"": 3, "x" * 5000: 100, "x" * 4999: 5, "x" * 4000 + "y" + "x" * 999: 7, "北京大学": 30, "北京小学": 2, "abcdefg": 5, "gfedcba": 5}
    frame = spark.createDataFrame([(w, n, 1, "s") for w, n in counts.items()], "word string, n long, kind int, root string")
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(frame, **options).collect()}
    assert got == by_hand(counts)
    assert any(v[2] for v in got.values()) and any(v[4] != v[2] for v in got.values() if v[2])


def test_nulls_and_repeats(spark):
    frame = spark.createDataFrame([("letter", 10), ("letter", 10), ("leter", 2), (None, 5), ("lettre", None)], "word string, n long")
    got = {tuple(r) for r in spelling.variants(frame).collect()}
    assert got == {("letter", 20, 1, None, None, "letter"), ("leter", 2, 1, "letter", 20, "letter")}
    assert spelling.variants(frame.limit(0)).count() == 0


def test_one_edit():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = sorted(("".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(2)), key=len)
        assert spelling.one_edit(a, b) == distance_one(a, b)


def test_tree_reaches_all_and_prunes():
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.4, (3000, spelling.PLACES)).astype(np.int32)
    tree = spelling.Tree(counts, 8)
    home = tree.home(counts)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(3000))
    asked = counts[:200]
    rows, leaves = tree.visit(asked, 1, 1)
    assert len({*zip(rows.tolist(), leaves.tolist())}) == len(rows)
    seen = {*zip(rows.tolist(), leaves.tolist())}
    for i in range(200):
        d = counts - asked[i]
        near = np.flatnonzero((np.abs(d).sum(axis=1) == 2) & (d.max(axis=1) == 1) & (d.min(axis=1) == -1))
        assert all((i, int(home[j])) in seen for j in near)
    assert len(rows) < 200 * tree.leaves / 4


def test_runs(spark):
    frame = spark.createDataFrame([("Éclair ÉCLAIRs x12abcdefgh İstanbul naïveté",), (None,), ("",)], "t string")
    got = [r[0] for r in frame.select(spelling.runs(frame["t"], 7)).collect()]
    assert got == [["Éclairs", "abcdefgh", "stanbul", "naïveté"], None, []]
