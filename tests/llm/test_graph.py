import random

import pytest

from spillway.llm.common import Workspace
from spillway.llm.graph import components


def brute(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            up[max(root(a), root(b))] = min(root(a), root(b))
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(3, 1), (1, 3), (3, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(99, 49)],
    [(random.Random(i).randrange(60), random.Random(-i).randrange(60) + 10) for i in range(50)],
])
def test_components(spark, edges):
    rows = components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "t"), "c").collect()
    assert {r["id"]: r["component"] for r in rows} == brute(edges) and len(rows) == len(brute(edges))
