import random

from aspectra.llm.components import connected_components


def test_chain_star_and_noise(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(200, 290)] + [(7, i) for i in range(300, 340)] + [(rnd.randrange(400, 480), rnd.randrange(400, 480)) for _ in range(70)]
    rows = edges + [(b, a) for a, b in edges[:20]] + [(None, 5), (9, 9), (6, None)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(rows, "a long, b long").repartition(5)).collect()}
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {n: find(n) for n in root if any(a != b for a, b in edges if n in (a, b))}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
