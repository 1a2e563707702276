import numpy as np

from relmod.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, filters string, n_links string"


def plain(rows, cosine=0.95):
    usable = []
    for _, v, *_ in rows:
        ok = bool(v) and None not in v and np.isfinite(np.asarray(v, np.float32)).all() and np.any(v)
        usable.append(np.asarray(v, np.float32).astype(np.float64) if ok else None)
    unit = [u / np.linalg.norm(u) if u is not None else None for u in usable]
    n = len(rows)

    def linked(x, y):
        return x is not None and y is not None and len(x) == len(y) and x @ y >= cosine

    near = [[j for j in range(n) if j != i and linked(unit[i], unit[j])] for i in range(n)]
    out = []
    for i in range(n):
        met, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in met:
                    met.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in met if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def got(spark, rows):
    return sorted((tuple(r) for r in embed_dedup.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


def vectors(seed, n, dim, copies):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n, dim))
    near = [base[i % 7] + 0.12 * r.standard_normal(dim) for i in range(copies)]
    return [[float(np.float32(x)) for x in v] for v in [*base, *near]]


def test_groups_chains_and_copies(spark):
    rows = [(i, v, i, "clash", "clash") for i, v in enumerate(vectors(1, 500, 24, 200))]
    angle = np.arccos(0.96)
    chain = [[float(np.cos(k * angle)), float(np.sin(k * angle))] + [0.0] * 22 for k in range(12)]
    rows += [(2000 - i, v, 0, "", "") for i, v in enumerate(chain)]
    rows += [(3000 + i, rows[5][1], 0, "", "") for i in range(20)]
    rows += [(4000, [2 * x for x in rows[6][1]], 0, "", "")]
    assert got(spark, rows) == plain(rows)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rows = [(i, v, i, "", "") for i, v in enumerate(vectors(2, 60, 16, 240))]
    assert got(spark, rows) == plain(rows)


def test_vectors_of_several_lengths(spark):
    """Each length links among its own, also the rarer ones, whatever the most frequent is."""
    rows, at = [], 0
    for dim, n, copies in ((24, 120, 40), (16, 60, 50), (3, 9, 5), (1, 2, 2)):
        for v in vectors(dim, n, dim, copies):
            rows.append((at, v, dim, "", ""))
            at += 1
        rows += [(at + k, rows[-1][1], dim, "", "") for k in range(3)]
        at += 3
    found = got(spark, rows)
    assert found == plain(rows)
    assert all(any(n for i, n, *_ in found if rows[i][2] == dim) for dim in (24, 16, 3, 1))


def test_recall_of_the_filters(spark):
    r = np.random.default_rng(4)
    dim, pairs = 64, 1500
    x = r.standard_normal((pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = r.standard_normal((pairs, dim))
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * side  # as far apart as links may be
    rows = [(2 * i + k, [float(a) for a in v], 0, "", "") for i in range(pairs) for k, v in enumerate((x[i], y[i]))]
    linked = sum(n > 0 for _, n, *_ in got(spark, rows))
    assert linked >= 0.97 * len(rows)


def test_list_decoding_finds_all_filters_over_the_threshold():
    r = np.random.default_rng(5)
    for dim, n in ((64, 5000), (7, 300), (300, 100_000)):
        rotation, codes, threshold = embed_dedup.product_code(dim, n)
        unit = r.standard_normal((20, dim))
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        scores = np.zeros((20, 1))
        for part, c in zip(np.array_split(unit @ rotation, np.cumsum([c.shape[1] for c in codes])[:-1], axis=1), codes, strict=True):
            scores = (scores[:, :, None] + (part @ c.T)[:, None, :]).reshape(20, -1)
        found = embed_dedup.list_decode(unit, rotation, codes, threshold)
        for s, f in zip(scores, found, strict=True):
            want = set(np.flatnonzero(s >= threshold).tolist())
            if len(want) >= min(embed_dedup.LEAST_FILTERS, len(s)):
                assert set(f.tolist()) == want
            else:
                others = np.setdiff1d(np.arange(len(s)), f)
                assert want <= set(f.tolist()) and s[f].min() >= s[others].max(initial=-9)
                assert len(f) >= min(embed_dedup.LEAST_FILTERS, len(s))
        assert 0.4 < np.mean([len(f) for f in found]) / embed_dedup.FILTERS < 2


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    c = (1, "clash", "clash")
    rows = [
        (1, [1.0, 0.0, 0.0], *c), (2, [1.0, 0.0, 0.0], *c), (2, [1.0, 0.01, 0.0], *c), (3, None, *c), (4, [], *c), (5, [0.0, 0.0, 0.0], *c),
        (6, [nan, 1.0, 0.0], *c), (7, [inf, 0.0, 0.0], *c), (8, [1.0, None, 0.0], *c), (9, [1.0, 0.0], *c), (None, [0.0, 1.0, 0.0], *c),
        (None, [0.0, 1.0, 0.001], None, None, None), (10, [-1.0, 0.0, 0.0], *c), (11, [1e-30, 0.0, 0.0], *c), (12, [3e38, 0.0, 0.0], *c),
        (13, [-0.0, 0.0, 5.0], *c), (14, [0.0, -0.0, 5.0], *c), (None, None, *c),
    ]
    want = [r if r[0] is not None else (None, r[1], r[2], True) for r in plain(rows)]
    assert got(spark, rows) == sorted(want, key=repr)


def test_empty_table_and_nothing_usable(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, 1, "", ""), (2, [0.0], 1, "", "")]) == [(1, 0, 1, True), (2, 0, 2, True)]
