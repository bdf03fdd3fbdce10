"""Components of link tables: the smallest node reached, and how often links are read."""

import random

from recordlake.llm import components as module


def smallest(links):
    comp = {x: x for link in links for x in link}

    def root(x):
        while comp[x] != x:
            comp[x] = comp[comp[x]]
            x = comp[x]
        return x

    for link in links:
        a, b = sorted(map(root, link))
        comp[b] = a
    return {x: root(x) for x in comp}


def found(links, spark, **more):
    got = module.components(spark.createDataFrame(links, "a long, b long"), **more).collect()
    assert len(got) == len({r["node"] for r in got})
    return {r["node"]: r["comp"] for r in got}


def graphs():
    rng = random.Random(5)
    yield [(i, i + 1) for i in range(100)]
    yield [(i + 1, i) for i in range(0, 100, 2)] + [(1000 - i, i) for i in range(100)]
    yield [(99, i) for i in range(99)]
    order = rng.sample(range(300), 300)
    yield list(zip(order, order[1:]))
    yield [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    yield [(rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(40)]


def test_smallest_reachable(spark):
    for links in graphs():
        links = [x for x in links if x[0] != x[1]]
        assert found(links, spark) == smallest(links)
        # In two portions, the second taken into the labels of the first.
        first = module.components(spark.createDataFrame(links[::2], "a long, b long"))
        assert found(links[1::2], spark, labels=first) == smallest(links)


def test_no_links_and_loops(spark):
    assert found([], spark) == {} and found([(1, 1), (2, None)], spark) == {}
    assert found([], spark, labels=spark.createDataFrame([(3, 2), (2, 2)], "node long, comp long")) == {3: 2, 2: 2}


def test_links_are_not_all_read_in_every_round(spark, monkeypatch):
    """Dense groups in a chain take some rounds; each round reads what is still between labels."""
    rng, plain, size, read = random.Random(7), module.stored, [0], []

    def counted(df, label):
        out = plain(df, label)
        if label == "links":
            size[0] = out.count()
        else:
            read.append(size[0])
        return out

    monkeypatch.setattr(module, "stored", counted)
    names = rng.sample(range(10_000), 640)
    groups = [names[i:i + 40] for i in range(0, 640, 40)]
    links = [tuple(rng.sample(g, 2)) for g in groups for _ in range(400)] + [(g[0], h[0]) for g, h in zip(groups, groups[1:])]
    assert found(links, spark) == smallest(links)
    assert len(read) > 3 and sum(read) <= 2 * len(links)
