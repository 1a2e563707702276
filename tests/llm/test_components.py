import random

from relmod.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def check(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = plain([e for e in edges if e[0] != e[1]])
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


def test_shapes(spark):
    r = random.Random(1)
    chain = list(range(60))
    r.shuffle(chain)
    star = [(1000, 900 + i) for i in range(200)]
    loose = [(r.randrange(2000, 2300), r.randrange(2000, 2300)) for _ in range(160)]
    check(spark, list(zip(chain, chain[1:], strict=False)) + star + loose + [(5000, 5000), (7, 7)])


def test_no_edges(spark):
    check(spark, [])
