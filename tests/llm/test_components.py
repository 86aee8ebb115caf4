"""Connected components against union by hand: a path, a random graph with repeated edges, a hub, no edges."""

import random

import pytest

from tidemark.llm.components import components


def brute(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {n: top(n) for n in list(up)}


rng = random.Random(5)
GRAPHS = {"path": [(i, i + 1) for i in range(40)], "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] * 2,
          "hub": [(7, i) for i in range(30)] + [(3, 3)], "empty": []}


@pytest.mark.parametrize("name", GRAPHS)
def test_least_reachable(spark, name):
    got = [tuple(r) for r in components(spark.createDataFrame(GRAPHS[name], "a long, b long")).collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute(GRAPHS[name])
