import random
import re

from relmod.llm import jaccard

SCHEMA = "doc_id long, text string, uid string, n int, kept string"


def sets_of(rows, words):
    out = []
    for _, text, *_ in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in w]
        k = min(words, len(w))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return out


def plain(rows, words, num, den):
    sets = sets_of(rows, words)
    n = len(rows)
    linked = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if sets[i] and sets[j] and c * den >= num * (len(sets[i]) + len(sets[j]) - c):
                linked[i].append(j)
                linked[j].append(i)
    out = []
    for i in range(n):
        met, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in met:
                    met.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in met if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def check(spark, rows, words=3, num=90, den=100):
    df = spark.createDataFrame(rows, SCHEMA)
    found = jaccard.similar_documents(df, words=words, num=num, den=den).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == plain(rows, words, num, den)
    return found


def edited(r, text, changes):
    w = text.split()
    for _ in range(changes):
        w[r.randrange(len(w))] = "edit" + str(r.randrange(10**6))
    return " ".join(w)


def corpus(prose, seed, n):
    r = random.Random(seed)
    texts = [prose(seed * 1000 + i, r.choice((1, 2, 3, 9, 30, 120, 300))) for i in range(n)]
    passage = prose(77, 60)
    for i in range(0, n, 3):
        texts.append(edited(r, texts[i], r.randint(0, 4)))
    for i in range(0, n, 4):
        texts.append(texts[i] + " " + passage)
    hot = prose(78, 150)
    texts += [edited(r, hot, r.randint(0, 3)) for _ in range(n // 2)] + [hot] * (n // 4)
    r.shuffle(texts)
    return [(i, t, "clash", 1, "clash") for i, t in enumerate(texts)]


def test_against_all_pairs(spark, prose):
    check(spark, corpus(prose, 1, 120))
    check(spark, corpus(prose, 2, 80), words=5, num=8, den=10)
    check(spark, corpus(prose, 3, 60), words=1, num=1, den=2)


def test_large_lists_in_blocks_and_without_known_frequencies(spark, prose, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "LOCALLY_FREQUENT", 10**9)
    check(spark, corpus(prose, 4, 80))


def test_sets_larger_than_the_smallest_bitmap(spark, prose, monkeypatch):
    r = random.Random(5)
    base = prose(6, 6000, 5000)
    rows = [(i, edited(r, base, r.choice((60, 200, 260))), "", 1, "") for i in range(14)]
    rows += [(20 + i, " ".join(base.split()[: 4200 - 60 * i]), "", 1, "") for i in range(8)]  # across a power of two
    check(spark, rows)
    monkeypatch.setattr(jaccard, "SKETCH_WORDS", 1)
    check(spark, corpus(prose, 7, 60))


def test_bitmaps_bound_the_sets_distance():
    import numpy as np

    r = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(r.integers(0, 2**63, r.integers(1, 5000)).astype(np.uint64))
        y = np.unique(np.concatenate([r.permutation(x)[: r.integers(0, len(x) + 1)], r.integers(0, 2**63, r.integers(0, 3000)).astype(np.uint64)]))
        a, b = jaccard.parity_bitmap(x), jaccard.parity_bitmap(y)
        w = min(len(a), len(b))
        apart = int(np.bitwise_count(jaccard.folded(a, w) ^ jaccard.folded(b, w)).sum())
        assert apart <= len(np.setxor1d(x, y))


def test_hard_rows(spark, prose):
    c = ("clash", 1, "clash")
    rows = [
        (1, None, *c), (2, "", *c), (3, " \t\n", *c), (4, "one", *c), (5, "ONE", *c), (6, "one two", *c), (7, "one\x0btwo ", *c), (8, "Two one", *c),
        (9, prose(1, 50_000, 9000), *c), (10, prose(1, 50_000, 9000) + " end", *c), (11, "same text in two rows", *c), (11, "same text in two rows", *c),
        (None, "same text in two rows", None, None, None), (None, "no key at all", *c), (None, "no key at all", *c), (12, "one\u00a0two", *c), (13, "É é", *c), (14, "é é", *c),
    ]
    found = check(spark, rows)
    # one row of each component is kept, and it has the component's key
    kept = sorted((r.component_id for r in found if r.kept), key=repr)
    assert kept == sorted([1, 2, 3, 4, 6, 8, 9, 11, None, 12, 13, 14], key=repr)
    assert all(r.doc_id == r.component_id for r in found if r.kept)


def test_one_of_each(spark, prose):
    rows = corpus(prose, 6, 60) + [(500, "twice the same words here", "", 1, ""), (500, "twice the same words here", "", 1, "")]
    left = jaccard.one_of_each(spark.createDataFrame(rows, SCHEMA), words=5, num=8, den=10)
    assert left.columns == ["doc_id", "text", "uid", "n", "kept"]
    want = {r[2] for r in plain(rows, 5, 8, 10)}
    got = [tuple(r) for r in left.collect()]
    assert sorted(r[0] for r in got) == sorted(want) and set(got) <= {tuple(r) for r in rows}


def test_empty_table(spark):
    check(spark, [])
    assert jaccard.one_of_each(spark.createDataFrame([], SCHEMA)).collect() == []
