import math
import random
import re
from collections import Counter

import pytest

from relmod.llm import lexical as X

DOCS = "doc_id long, text string, key string, n int, m string, part string, terms int"
ITEMS = "item_id string, text string, key string, q int, rank string"


def plain_terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in re.findall(X.TERM_PATTERN, text or "")]


def plain(docs, items, k):
    """item_id, rank, doc_id, score by the definition."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        query = Counter(plain_terms(text))
        scores = []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // total
            s = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, q in query.items()
                if t in c
            )
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k):
    d = spark.createDataFrame([(*x, "clash", 1, "clash", "clash", 2) for x in docs], DOCS)
    q = spark.createDataFrame([(*x, "clash", 1, "clash") for x in items], ITEMS)
    out = X.search(X.build_index(d), q, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_terms():
    text = "Don't  É/é x_y 3.14 日本、語\0Z{a}~b\x7fc d"
    assert [t.decode() for t in X.terms_of(text)] == plain_terms(text)
    r = random.Random(0)
    for _ in range(300):
        t = "".join(chr(r.choice([r.randint(0, 127), r.randint(128, 900), 0x1F600])) for _ in range(30))
        assert [x.decode() for x in X.terms_of(t)] == plain_terms(t)
    assert X.terms_of(None) == X.terms_of("") == X.terms_of(" ._") == []


def test_hard_rows(spark, prose):
    docs = [
        (1, None), (2, ""), (3, "..."), (4, "alpha beta"), (5, "Alpha, alpha! BETA"), (6, "É é alpha"), (None, "alpha beta"),
        (None, "alpha gamma"), (7, "beta " * 50_000 + "alpha"), (8, "alpha beta"), (8, "alpha beta"), (8, "gamma"), (9, prose(2, 3000)),
    ]
    docs += [(100 + i, prose(i, 20 + i % 7)) for i in range(60)] + [(300 + i, "copy of alpha text") for i in range(40)]
    items = [
        ("a", "alpha"), ("b", "beta beta alpha"), ("c", None), ("d", ""), ("e", "!!"), ("f", "é É nowhere"), (None, "gamma alpha"),
        ("twice", "copy"), ("twice", "copy"), ("long", prose(3, 400)), ("none", "nowhere"),
    ]
    assert found(spark, docs, items, 5) == plain(docs, items, 5)


@pytest.mark.parametrize("per_part, visits, slice_bytes", [(50, 1, 1 << 20), (400, 3, 300)])
def test_small_parts_and_slices(spark, monkeypatch, prose, per_part, visits, slice_bytes):
    monkeypatch.setattr(X, "TERMS_PER_PART", per_part)
    monkeypatch.setattr(X, "FIRST_VISITS", visits)
    monkeypatch.setattr(X, "SLICE_BYTES", slice_bytes)
    r = random.Random(per_part)
    docs = [(r.randint(0, 200), prose(r.randint(0, 90), r.choice([5, 5, 5, 20, 60]), 40)) for _ in range(250)]
    items = [(f"i{j}", prose(500 + j, r.randint(1, 9), 40)) for j in range(12)]
    assert found(spark, docs, items, 4) == plain(docs, items, 4)


def test_skipped_parts_hold_no_result(prose):
    """A part's bound is never below a score in it."""
    docs = [Counter(plain_terms(prose(i, 30, 25))) for i in range(80)]
    for m in (75, 100, 180):
        for q in range(20):
            terms = Counter(plain_terms(prose(900 + q, 6, 25)))
            bound = sum(n * X.impact(max((d[t] for d in docs), default=0), m) for t, n in terms.items() if any(t in d for d in docs))
            assert bound >= max(sum(n * X.impact(d[t], m) for t, n in terms.items() if t in d) for d in docs)


def test_empty_tables(spark):
    assert found(spark, [], [("a", "alpha")], 3) == []
    assert found(spark, [(1, "alpha")], [], 3) == []
    assert found(spark, [(1, None)], [("a", "alpha")], 3) == []
