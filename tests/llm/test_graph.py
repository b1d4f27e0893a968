import random

from cliploom.llm import graph
from cliploom.llm._util import Workspace


def test_components(spark):
    r = random.Random(6)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (3, None), (None, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = graph.components(Workspace(spark, "test"), spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in root)


def test_no_links(spark):
    assert graph.components(Workspace(spark, "test"), spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
