import random

import numpy as np
from helpers import rows

from uurwerk.llm.common import components, local_roots, positions


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_positions_are_prefix_sums_with_a_hot_group(spark):
    rng = random.Random(1)
    data = [(rng.choice("aaaab"), rng.randrange(5), i, rng.randrange(1, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, k int, i int, w long")
    got = {(r.g, r.i): tuple(r)[4:] for r in positions(df, ["g"], ["k", "i"], "w").collect()}
    for g in "ab":
        mine = sorted((k, i, w) for h, k, i, w in data if h == g)
        before = 0
        for n, (_, i, w) in enumerate(mine):
            assert got[g, i] == (n, before, len(mine), sum(m[2] for m in mine))
            before += w


def test_positions_of_nothing(spark):
    df = spark.createDataFrame([], "g string, k int, w long")
    assert positions(df, ["g"], ["k"], "w").count() == 0


def test_components_of_chains_stars_and_cliques(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 300 + i) for i in range(200)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(90)]
    links += [(5, 5), (160, 100)]
    want = union_find({n for l in links for n in l}, links)
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    assert got == {n: r for n, r in want.items() if n != 5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_roots_agree_with_union_find():
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randrange(1, 40)
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(40))]
        left, right = np.array([a for a, _ in links], int), np.array([b for _, b in links], int)
        assert dict(enumerate(local_roots(n, left, right))) == union_find(range(n), links)
