"""Local vectors: counts by hand, the factorisation against a dense eigen-solution."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from relmod.operators import local_vectors as lv
from relmod.operators.lm import CandidateModels
from relmod.params import Params
from relmod.plans import pipelines as P


def corpus(spark):
    r = random.Random(3)
    topics = [["sun", "moon", "star", "sky"], ["bread", "butter", "milk", "salt"], ["ship", "sail", "sea", "harbor"]]
    docs = {}
    for d in range(12):
        words = []
        for _ in range(r.randint(3, 9)):
            t = topics[(d + r.choice([0, 0, 0, 1])) % 3]
            words += [r.choice(t) for _ in range(4)]
        docs[d] = words
    docs[12], docs[13] = [], ["alone"]
    cands = {1: list(range(14)), 2: [0, 3, 6], 3: [13], 4: [12]}
    coll = spark.createDataFrame([(d, "", "", " ".join(t)) for d, t in docs.items()], "doc_id long, url string, title string, body string")
    cand = spark.createDataFrame([(q, d) for q, v in cands.items() for d in v], "qid long, doc_id long")
    return docs, cands, CandidateModels(cand, coll, P.EMBEDDING_FIELDS)


def plain_pmi(docs, ids, window, negatives):
    n = Counter()
    for d in ids:
        w = docs[d]
        for i, x in enumerate(w):
            for j in range(max(0, i - window), min(len(w), i + window + 1)):
                if j != i:
                    n[x, w[j]] += 1
    rows = Counter()
    for (t, _), c in n.items():
        rows[t] += c
    total = sum(rows.values())
    m = {(t, w): math.log(c * total / (rows[t] * rows[w] * negatives)) for (t, w), c in n.items()}
    return {k: v for k, v in m.items() if v > 0}


@pytest.mark.parametrize("negatives", [1, 2])
def test_positive_pmi_by_the_definition(spark, negatives):
    docs, cands, models = corpus(spark)
    terms = {r.term_id: r.term for r in models.dictionary.collect()}
    got = {}
    for r in lv.positive_pmi(lv.context_counts(models, 3), negatives).collect():
        got[r.qid, terms[r.t], terms[r.w]] = r.m
    want = {(q, *k): v for q, ids in cands.items() for k, v in plain_pmi(docs, ids, 3, negatives).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert not any(k[0] in (3, 4) for k in got)
    models.unpersist()


def test_factorisation_equals_the_dense_eigen_solution(spark):
    docs, cands, models = corpus(spark)
    dense = plain_pmi(docs, cands[1], 2, 1)
    words = sorted({t for t, _ in dense})
    m = np.array([[dense.get((t, w), 0.0) for w in words] for t in words])
    values, basis = np.linalg.eigh(m)
    order = np.argsort(-abs(values))
    ratios = [abs(values[order[d]] / values[order[d - 1]]) for d in range(1, 5)]
    d = 1 + int(np.argmin(ratios))  # the clearest gap
    rounds = math.ceil(math.log(1e-9) / math.log(min(ratios)))
    top = order[:d]
    want = basis[:, top] * values[top] ** 2 @ basis[:, top].T
    got = {r.term: r.vec for r in lv.local_vectors(models, d, 2, rounds).filter("qid = 1").collect()}
    assert sorted(got) == words
    v = np.array([got[w] for w in words])
    assert abs(v @ v.T - want).max() < 1e-6
    models.unpersist()


def test_few_words_and_no_vectors(spark):
    """More directions than words: zeros; a query without contexts is ranked by its own terms."""
    docs, cands, _ = corpus(spark)
    coll = spark.createDataFrame([(1, "", "", "sun moon"), (2, "", "", "alone")], "doc_id long, url string, title string, body string")
    cand = spark.createDataFrame([(1, 1, 0.0, 1), (2, 2, 0.0, 1)], "qid long, doc_id long, score double, pos int")
    models = CandidateModels(cand, coll, P.EMBEDDING_FIELDS)
    vectors = lv.local_vectors(models, 4, 20, 2).collect()
    assert {(r.qid, r.term) for r in vectors} == {(1, "sun"), (1, "moon")}
    assert all(math.isfinite(x) for r in vectors for x in r.vec) and all(r.vec[2] == r.vec[3] == 0 for r in vectors)
    models.unpersist()
    q = spark.createDataFrame([(1, "sun"), (2, "alone")], "qid long, text string")
    run, exps = P.rerank_local_vectors(q, cand, coll, Params(), d=4, rounds=2)
    assert {r.qid for r in exps.collect()} == {1}
    assert {(r.qid, r.doc_id, r["rank"]) for r in run.collect()} == {(1, 1, 1), (2, 2, 1)}


def by_word(vectors):
    return {(r.qid, r.term): r.vec for r in vectors.collect()}


def test_tables_of_pairs_are_not_stored(spark, monkeypatch):
    """Queries that fit a task are counted and factorised there: no row per query and pair of words is written."""
    _, _, models = corpus(spark)
    written = []
    monkeypatch.setattr(lv, "materialize", lambda df: written.append(df.columns) or df.checkpoint())
    got = by_word(lv.local_vectors(models, 2, 3, 2))
    assert {q for q, _ in got} == {1, 2} and not any({"t", "w"} <= set(c) for c in written)
    models.unpersist()


@pytest.mark.parametrize("some", [False, True])
def test_large_queries_have_the_same_vectors(spark, monkeypatch, some):
    """By joins: all queries, or the one of more tokens than a task takes."""
    docs, cands, models = corpus(spark)
    want = by_word(lv.local_vectors(models, 3, 3, 2, 2))
    sizes = {q: sum(len(docs[d]) for d in ids) for q, ids in cands.items()}
    joined = []
    monkeypatch.setattr(lv, "PAIRS_IN_TASK", sizes[2] * 3 if some else 0)
    one = lv.context_counts
    monkeypatch.setattr(lv, "context_counts", lambda m, w, cset: joined.append({r.qid for r in cset.collect()}) or one(m, w, cset))
    got = by_word(lv.local_vectors(models, 3, 3, 2, 2))
    assert joined == [{1} if some else {1, 2, 3}]
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-9) for k in want)
    models.unpersist()


def test_pairs_are_counted_by_blocks(monkeypatch):
    r = np.random.default_rng(5)
    seq, doc = r.integers(0, 7, 90), np.sort(r.integers(0, 6, 90))
    want = Counter()
    for i in range(90):
        for j in range(i + 1, min(i + 4, 90)):
            if doc[i] == doc[j]:
                want[min(seq[i], seq[j]), max(seq[i], seq[j])] += 1
    for at_once in (1, 20, 1 << 20):
        monkeypatch.setattr(lv, "PAIRS_AT_ONCE", at_once)
        blocks = list(lv._counted(seq, doc, 3, 7))
        assert (len(blocks) == 1) == (at_once > 90 * 3)
        got = [(u, v, n) for b in blocks for u, v, n in zip(*map(np.ndarray.tolist, b))]
        assert len(got) == len(want) and all(want[u, v] == n for u, v, n in got)
    assert not list(lv._counted(seq[:1], doc[:1], 3, 7)) and not list(lv._counted(seq, doc, 0, 7))


def test_documents_without_an_own_id_are_one(spark):
    """Two documents of one id are read as one, place by place; a query without candidates' documents has no vectors."""
    rows = [(1, "", "", "sun moon star"), (1, "", "", "sea ship sail"), (None, "", "", "salt milk")]
    coll = spark.createDataFrame(rows, "doc_id long, url string, title string, body string")
    cand = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 1), ("c", 9)], "qid string, doc_id long")
    for params in (Params(), Params(broadcast_bytes=0)):
        models = CandidateModels(cand, coll, P.EMBEDDING_FIELDS, params)
        got = by_word(lv.local_vectors(models, 2, 20, 2))
        assert {q for q, _ in got} == {"a"} and {t for _, t in got} <= set("sun moon star sea ship sail".split())
        by_joins = by_word(lv._by_joins(models, models.cset, 2, 20, 2, 1))
        assert got.keys() == by_joins.keys() and all(np.allclose(got[k], by_joins[k], atol=1e-9) for k in got)
        models.unpersist()
