import random

import pytest

from cuvee.llm.components import components


def brute(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {(v, find(v)) for v in list(root)}


CASES = {
    "chain": [(i, i + 1) for i in range(60)],
    "star": [(0, i) for i in range(1, 200)],
    "star of a large id": [(999, i) for i in range(1, 100)],
    "random": [(random.Random(3).randrange(80), random.Random(k).randrange(80)) for k in range(60)],
    "repeated and loops": [(1, 2), (2, 1), (1, 2), (5, 5), (7, 6)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    links = CASES[name]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {p for p in brute([x for x in links if x[0] != x[1]])}


def test_nulls_and_no_links(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "a long, b long")
    assert components(df).count() == 0
    assert components(df.limit(0)).columns == ["id", "component"]
