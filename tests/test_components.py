"""Components against union and find on random graphs, chains and loops."""

import random
from datetime import date

import pytest

from urbanframe.operators.components import connected_components


def _graph(kind):
    rng = random.Random(4)
    if kind == "chain":
        return [(i, i + 1) for i in range(300)]
    if kind == "star":
        return [(i, 500) for i in range(100)] + [(7, 7)]
    return [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]


@pytest.mark.parametrize("few", [0, 20, 10**6])
@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind, few):
    edges, parent = _graph(kind), list(range(501))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, (None, 3)], "src int, dst int")
    assert {r.node: r.component for r in connected_components(df, few_edges=few).collect()} == {x: top(x) for e in edges for x in e}


def test_nodes_of_other_types_and_no_edges(spark):
    text = spark.createDataFrame([("a", "b"), ("c", "b"), ("z", "z")], "src string, dst string")
    for few in (0, 10**6):
        assert {r.node: r.component for r in connected_components(text, few_edges=few).collect()} == {"a": "a", "b": "a", "c": "a", "z": "z"}
    assert connected_components(text.limit(0)).count() == 0
    days = spark.createDataFrame([(date(2024, 1, 2), date(2024, 1, 1)), (date(2024, 1, 2), date(2024, 1, 3))], "src date, dst date")
    assert {r.component for r in connected_components(days).collect()} == {date(2024, 1, 1)}
