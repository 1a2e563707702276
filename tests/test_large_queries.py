"""A query that holds nearly all candidate pairs, and the term dictionary."""

import math
import statistics

import pytest
from pyspark.sql import functions as F
from test_scoring import dense_score_b, dense_task0, frames

from relmod.operators import expansion as ex
from relmod.operators import feedback as fb
from relmod.operators import lm
from relmod.operators.lm import CandidateModels
from relmod.params import Params
from relmod.plans import pipelines as P


@pytest.fixture(scope="module")
def skewed():
    """One query with 90 % of 400 pairs, many small ones."""
    import random

    r = random.Random(5)
    words = ["w" + "abcdefghij"[i // 10] + "abcdefghij"[i % 10] for i in range(60)]  # digits would be masked
    docs = {d: [r.choice(words) for _ in range(r.randint(0, 30))] for d in range(360)}
    docs[0] = []
    cands = {1: list(range(360)), **{q: r.sample(range(360), 4) for q in range(2, 12)}}
    queries = {q: [r.choice(words) for _ in range(4)] + ["zulu"] for q in cands}
    return queries, cands, docs


@pytest.fixture()
def small_chunks(monkeypatch):
    monkeypatch.setattr(CandidateModels, "PAIRS_PER_CHUNK", 8)
    monkeypatch.setattr(CandidateModels, "PAIRS_PER_PARTITION", 20)


def test_large_query_equals_the_dense_definition(spark, skewed, small_chunks):
    queries, cands, docs = skewed
    q, c, coll = frames(spark, queries, cands, docs)
    got = {(r.qid, r.doc_id): r.score for r in P.rerank_feedback(q, c, coll).collect()}
    want = dense_task0(queries, cands, docs)
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_large_query_is_spread(spark, skewed, small_chunks):
    queries, cands, docs = skewed
    q, c, coll = frames(spark, queries, cands, docs)
    models, qtf = P._embedding_models(q, c, coll, Params())
    assert models.has_large
    for df in (models.cand_len, models.pairs):
        rows = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert len(rows) == models.partitions and max(rows) <= 2 * statistics.median(rows)
    assert models.pairs.groupBy("qid", "doc_id").count().filter("count > 1").count() == 0
    # Score B on the same models
    exps = {qq: [("wab", 2.0), ("nope", 1.0), ("wac", 0.5)] for qq in queries}
    e = spark.createDataFrame([(k, i + 1, t, s) for k, v in exps.items() for i, (t, s) in enumerate(v)], "qid long, rk int, term string, sim double")
    rm = ex.relevance_model(ex.expansion_model(e, qtf, models), 0.2)
    got = {(r.qid, r.doc_id): r.score for r in ex.score_b(rm, models).collect() if r.qid == 1}
    want = dense_score_b({1: queries[1]}, {1: cands[1]}, docs, exps)
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    # the public forms hold each (qid, term) once, and lead to the same scores
    p_rm = fb.feedback_model(fb.query_likelihood(qtf, models), models)
    for df in (models.bg, p_rm):
        assert df.groupBy("qid", "term").count().filter("count > 1").count() == 0
    a, b = fb.score_a(p_rm, models), fb.rescore(qtf, models)
    off = a.join(b.withColumnRenamed("score", "b"), ["qid", "doc_id"]).agg(F.max(F.abs(F.col("score") - F.col("b"))), F.count("*")).first()
    assert off[0] < 1e-12 and off[1] == 400
    models.unpersist()


def test_softmax_states_merge_without_under_or_overflow(spark):
    values = [(b, g, float(v)) for g, vs in ((1, [-5000.0, -5001, -5000.5, -9000]), (2, [900.0, -900, 899])) for b, v in enumerate(vs)]
    df = spark.createDataFrame(values, "bucket long, g long, v double")
    got = {(r.g, r.v): r.w for r in fb.softmax(df, "v", "g", "bucket", lambda big, small, keys: big.join(small, keys)).collect()}
    for g in (1, 2):
        mine = [v for _, x, v in values if x == g]
        total = sum(math.exp(v - max(mine)) for v in mine)
        assert all(abs(got[g, v] - math.exp(v - max(mine)) / total) < 1e-15 for v in mine)


@pytest.mark.parametrize("bound", [0, 250, 1 << 20])
def test_dictionary_and_vectors(spark, bound):
    docs = {1: "b a b c", 2: "b", 3: "c b d", 4: "", 5: "é b"}
    toks = spark.createDataFrame([(d, t.split()) for d, t in docs.items()], "doc_id long, tokens array<string>")
    dictionary, vectors = lm.document_vectors(toks, Params(broadcast_bytes=bound))
    rows = [(r.term_id, r.term, r.cf) for r in dictionary.orderBy("term_id").collect()]
    assert rows == [(0, "b", 5), (1, "c", 2), (2, "a", 1), (3, "d", 1), (4, "é", 1)]
    got = {r.doc_id: (r.doc_len, r.ids, r.tfs) for r in vectors.collect()}
    assert got == {1: (4, [0, 1, 2], [2, 1, 1]), 2: (1, [0], [1]), 3: (3, [0, 1, 3], [1, 1, 1]), 5: (2, [0, 4], [1, 1])}
