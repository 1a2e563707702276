"""Sparse Spark forms against the dense definitions (Task 0 and Score B)."""

import math
from collections import Counter

import numpy as np
import pytest

from relmod.operators import expansion as ex
from relmod.operators import feedback as fb
from relmod.operators.lm import CandidateModels, query_term_freq
from relmod.params import UNK, Params
from relmod.plans import pipelines as P

WORDS = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliet", "kilo", "lima"]


def corpus(seed=7, n_docs=9, n_q=3):
    rng = np.random.default_rng(seed)
    docs = {}
    for d in range(n_docs):
        n = int(rng.integers(0, 40)) if d else 0  # doc 0 is empty
        docs[d] = [WORDS[i] for i in rng.integers(0, len(WORDS), n)]
    queries = {}
    cands = {}
    for q in range(n_q):
        queries[100 + q] = [WORDS[i] for i in rng.integers(0, len(WORDS), 3)] + ["zulu"]  # zulu is OOV
        cands[100 + q] = sorted(int(x) for x in rng.choice(n_docs, size=5, replace=False))
    cands[100] = sorted(set(cands[100]) | {0})
    return queries, cands, docs


def frames(spark, queries, cands, docs):
    q = spark.createDataFrame([(k, " ".join(v)) for k, v in queries.items()], "qid long, text string")
    c = spark.createDataFrame([(k, d, 0.0, i + 1) for k, v in cands.items() for i, d in enumerate(v)], "qid long, doc_id long, score double, pos int")
    coll = spark.createDataFrame([(d, "", "", " ".join(t)) for d, t in docs.items()], "doc_id long, url string, title string, body string")
    return q, c, coll


def background(cands, docs, q, pct=0.5):
    tf = {d: Counter(docs[d]) for d in cands[q]}
    n = sum(len(docs[d]) for d in cands[q])
    cf = Counter()
    for d in cands[q]:
        cf.update(tf[d])
    cf[UNK] = int((pct / 100) * sum(cf.values()))
    return tf, n, cf


def dense_task0(queries, cands, docs, mu=800.0):
    out = {}
    for q, qt in queries.items():
        tf, n, cf = background(cands, docs, q)
        pbg = {t: cf[t] / n for t in cf}

        def p(t, d):
            return (tf[d].get(t, 0) + mu * pbg.get(t, 0)) / (len(docs[d]) + mu)

        toks = [t for t in qt if t in cf]  # OOV tokens skipped (D4)
        lik = {d: math.prod(p(t, d) for t in toks) for d in cands[q]}
        z = sum(lik.values())
        prm = {t: sum(p(t, d) * lik[d] for d in cands[q]) / z for t in cf}
        for d in cands[q]:
            kl = sum(p(t, d) * math.log(p(t, d) / prm[t]) for t in tf[d])
            out[(q, d)] = 1 - kl
    return out


def test_task0_matches_dense(spark):
    queries, cands, docs = corpus()
    q, c, coll = frames(spark, queries, cands, docs)
    run = P.rerank_feedback(q, c, coll)
    got = {(r.qid, r.doc_id): r.score for r in run.collect()}
    want = dense_task0(queries, cands, docs)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)
    assert got[(100, 0)] == 1.0  # empty document (D10)


def dense_score_b(queries, cands, docs, expansions, lam=0.2, mu=800.0):
    out = {}
    for q, qt in queries.items():
        tf, n, cf = background(cands, docs, q)
        pbg = {t: cf[t] / n for t in cf}
        orig = Counter(t if t in cf else UNK for t in qt)
        exps = expansions.get(q, [])
        tot = sum(s for _, s in exps)
        e = {}
        for t, s in exps:
            e[t if t in cf else UNK] = s / tot  # assignment: the last OOV weight survives
        se, so = sum(e.values()), sum(orig.values())
        lam_q = lam if e and se != 0 else 0.0  # no expansion mass: original query alone (D8)
        r = {t: (lam_q * e.get(t, 0) / se if lam_q else 0.0) + (1 - lam_q) * orig.get(t, 0) / so for t in cf}
        for d in cands[q]:
            acc = 0.0
            for t, rt in r.items():
                pd_ = (tf[d].get(t, 0) + mu * pbg[t]) / (len(docs[d]) + mu)
                if rt > 0 and pd_ > 0:
                    acc += rt * math.log10(rt / pd_)
            out[(q, d)] = 1 - acc
    return out


def test_score_b_matches_dense(spark):
    queries, cands, docs = corpus(seed=11, n_docs=12)
    # long enough documents that the <UNK> bucket is not empty (N >= 200)
    docs = {d: (t * 8) for d, t in docs.items()}
    q, c, coll = frames(spark, queries, cands, docs)
    exps = {
        100: [("alpha", 3.0), ("nope1", 2.0), ("bravo", 1.5), ("nope2", 1.0)],
        101: [("charlie", 2.0), ("delta", -0.5)],
        102: [("nope3", 1.0)],
    }
    e = spark.createDataFrame(
        [(qq, i + 1, t, s) for qq, v in exps.items() for i, (t, s) in enumerate(v)], "qid long, rk int, term string, sim double"
    )
    models, qtf = P._embedding_models(q, c, coll, Params())
    rm = ex.relevance_model(ex.expansion_model(e, qtf, models), 0.2)
    got = {(r.qid, r.doc_id): r.score for r in ex.score_b(rm, models).collect()}
    want = dense_score_b(queries, cands, docs, exps)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)


def test_unk_count(spark):
    docs = {1: ["alpha"] * 531}
    q, c, coll = frames(spark, {5: ["alpha"]}, {5: [1]}, docs)
    m = CandidateModels(c, coll, P.FEEDBACK_FIELDS)
    unk = m.bg.filter("term = '<UNK>'").first()
    assert unk.cf == 2 and unk.n == 531


def test_oov_tokens(spark):
    queries, cands, docs = corpus()
    q, c, coll = frames(spark, queries, cands, docs)
    m = CandidateModels(c, coll, P.FEEDBACK_FIELDS)
    oov = fb.oov_tokens(query_term_freq(q), m).collect()
    assert {r.term for r in oov} == {"zulu"}


def test_feedback_model_sums_to_one(spark):
    queries, cands, docs = corpus(seed=3)
    q, c, coll = frames(spark, queries, cands, docs)
    m = CandidateModels(c, coll, P.FEEDBACK_FIELDS)
    p_rm = fb.feedback_model(fb.query_likelihood(query_term_freq(q), m), m)
    sums = {r.qid: r.s for r in p_rm.filter(f"term != '{UNK}'").groupBy("qid").agg({"p_rm": "sum"}).withColumnRenamed("sum(p_rm)", "s").collect()}
    assert sums and all(abs(v - 1.0) < 1e-12 for v in sums.values())


def test_empty_unk_bucket_is_dropped(spark):
    # N < 200 candidate tokens: floor(0.5% * N) = 0, yet the query has an OOV token (D7)
    queries = {1: ["alpha", "zulu"]}
    cands = {1: [1, 2]}
    docs = {1: ["alpha", "bravo"] * 5, 2: ["charlie"] * 7}
    q, c, coll = frames(spark, queries, cands, docs)
    models, qtf = P._embedding_models(q, c, coll, Params())
    empty = spark.createDataFrame([], "qid long, rk int, term string, sim double")
    rm = ex.relevance_model(ex.expansion_model(empty, qtf, models), 0.2)
    got = {r.doc_id: r.score for r in ex.score_b(rm, models).collect()}
    assert set(got) == {1, 2}
    assert all(math.isfinite(v) for v in got.values())
    assert got[1] > got[2]  # the document with the query word ranks first
    # matches the dense definition with the <UNK> term left out
    want = dense_score_b(queries, cands, docs, {})
    for d in got:
        assert got[d] == pytest.approx(want[(1, d)], abs=1e-9)


def test_empty_query_and_ties(spark):
    # a query made of stop-words only has no tokens: every candidate scores 1.0 (D9),
    # and equal scores are ordered by doc_id (D12)
    q = spark.createDataFrame([(9, "the and of")], "qid long, text string")
    c = spark.createDataFrame([(9, 3, 0.0, 1), (9, 1, 0.0, 2), (9, 2, 0.0, 3)], "qid long, doc_id long, score double, pos int")
    coll = spark.createDataFrame(
        [(d, "", "", " ".join(["alpha"] * 300)) for d in (1, 2, 3)], "doc_id long, url string, title string, body string"
    )
    empty = spark.createDataFrame([], "term string, vec array<double>")
    run, _ = P.rerank_embeddings(q, c, coll, empty)
    rows = sorted((r.rank, r.doc_id, r.score) for r in run.collect())
    assert rows == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]
