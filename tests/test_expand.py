"""Blocked expansions with bounds against all similarities."""

import numpy as np
import pytest

from relmod.operators import expansion as ex


def plain(words, cents, k):
    out = {}
    for q, c in cents.items():
        sims = [(-round(float(np.dot(v, c)), 9), t) for t, v in words.items()]
        out.update({(q, i): (t, -s) for i, (s, t) in enumerate(sorted(sims)[:k], 1)})
    return out


@pytest.mark.parametrize("block_words, block_queries, bound", [(4, 2, 0), (4, 3, 1 << 20), (1000, 64, 1 << 20)])
def test_equals_all_similarities(spark, block_words, block_queries, bound):
    r = np.random.default_rng(4)
    norms = np.exp(-np.arange(90) / 12)  # a few long vectors, many short ones
    words = {f"t{i:03}": (x := r.normal(size=5)) / np.linalg.norm(x) * norms[i] for i in range(90)}
    words |= {f"same{i}": np.ones(5) * 0.3 for i in range(9)} | {"zero": np.zeros(5), "null ": -np.ones(5)}
    cents = {q: r.normal(size=5) * (q + 1) for q in range(11)} | {50: np.zeros(5), 51: -np.ones(5) * 0.3, 52: np.ones(5)}
    v = spark.createDataFrame([(t, x.tolist()) for t, x in words.items()], "term string, vec array<double>").repartition(3)
    c = spark.createDataFrame([(q, x.tolist()) for q, x in cents.items()], "qid long, c array<double>")
    got = {(x.qid, x.rk): (x.term, x.sim) for x in ex.expand(v, c, 2, block_words, block_queries, 2, bound).collect()}
    want = plain(words, cents, 2)
    assert got.keys() == want.keys()
    assert all(got[x][0] == want[x][0] and abs(got[x][1] - want[x][1]) < 2e-9 for x in want)
    n = ex.visited_blocks(v, c, 2, block_words, block_queries, 2).first()
    if block_words == 4:
        assert n.visited < 0.8 * n.pairs  # the zero centroid's block has to see all
    else:
        assert n.visited == n.pairs


def test_few_words_and_none(spark):
    c = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, c array<double>")
    one = spark.createDataFrame([("a", [2.0, 1.0])], "term string, vec array<float>")
    assert [tuple(x) for x in ex.expand(one, c, 5).collect()] == [("q", 1, "a", 2.0)]
    assert ex.expand(one.limit(0), c, 5).collect() == [] and ex.expand(one, c.limit(0), 5).collect() == []
