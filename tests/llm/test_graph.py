import random

import pytest

from fieldlake.llm.common import Scratch
from fieldlake.llm.graph import components


def brute(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {(x, find(x)) for x in parent}


def graphs():
    rng = random.Random(4)
    path = list(range(60))
    shuffled = rng.sample(range(1000), 60)
    yield [(a, a + 1) for a in path[:-1]]
    yield list(zip(shuffled[:-1], shuffled[1:]))
    yield [(500, k) for k in range(80)] + [(k, k) for k in range(5)]
    yield [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    yield [(1, 2), (2, 1), (1, 2), (-5, 2)]


@pytest.mark.parametrize("edges", list(graphs()))
def test_components_as_by_union_and_find(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {tuple(r) for r in components(frame, Scratch(spark, "test")).select("node", "component").collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0
