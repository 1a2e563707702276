"""Rows that must not get lost, settings that must not pass, and plans that must not change results."""

import pytest
from pyspark.sql import functions as F

from relmod.operators import evaluate as ev
from relmod.operators.expansion import best_rows
from relmod.operators.ordering import rank_within_auto
from relmod.params import Params, TextOptions
from relmod.plans import pipelines as P
from relmod.session import broadcast_if_small, bytes_of
from relmod.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def test_null_groups_are_ranked_on_both_paths(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 4), (None, "x", 3), (None, "x", 2), (2, "y", 1)], "g long, h string, v int")
    for group in ("g", ["g", "h"]):
        small = rank_within_auto(df, group, [F.desc("v")], "r")
        large = rank_within_auto(df, group, [F.desc("v")], "r", max_group_rows=1)
        cols = ("g", "h", "v", "r")
        assert sorted(map(repr, small.select(*cols).collect())) == sorted(map(repr, large.select(*cols).collect()))
        assert large.count() == 5


@pytest.mark.parametrize("mu", [0, -1, float("nan")])
def test_mu_must_be_positive(mu):
    with pytest.raises(ValueError, match="mu"):
        Params(mu=mu)


def test_mu_of_every_setting_is_checked(spark):
    with pytest.raises(ValueError, match="mu"):
        P.sweep_from_expansions(None, None, None, None, None, [(100, 0.2), (0, 0.2)])


def test_bytes_are_measured(spark):
    df = spark.createDataFrame([("abc", [1.0, 2.0], 7), (None, None, None)], "s string, a array<double>, n long")
    assert bytes_of(df) == (16 + 19 + 32 + 8) + (16 + 16 + 16 + 8)
    assert "broadcast" in broadcast_if_small(df, 1000)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, 10)._jdf.queryExecution().analyzed().toString().lower()


@pytest.fixture(scope="module")
def inputs(spark):
    fx = X.Fixtures(spark, SF)
    return fx.queries(), fx.candidates(), fx.collection(), fx.vectors(), fx.qrels()


def _scores(run):
    return {(r.qid, r.doc_id): (r["rank"], round(r.score, 9)) for r in run.collect()}


def test_results_do_not_depend_on_broadcasts(spark, inputs):
    q, c, coll, vec, qrels = inputs
    none = Params(broadcast_bytes=0)
    assert _scores(P.rerank_feedback(q, c, coll)) == _scores(P.rerank_feedback(q, c, coll, none))
    (a, x), (b, y) = P.rerank_embeddings(q, c, coll, vec), P.rerank_embeddings(q, c, coll, vec, none)
    assert _scores(a) == _scores(b) and sorted(x.collect()) == sorted(y.collect())
    sweep = lambda p: sorted(map(repr, P.sweep_embeddings(q, c, coll, vec, qrels, [(100, 0.2), (800, 0.7)], p).withColumn("ndcg", F.round("ndcg", 9)).collect()))
    assert sweep(Params()) == sweep(none)


def test_nothing_stays_cached(spark, inputs):
    q, c, coll, vec, _ = inputs
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    P.rerank_feedback(q, c, coll).count()
    P.rerank_embeddings(q, c, coll, vec)[0].count()
    P.rerank_local(q, c, coll)[0].count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_field_lists_matter(spark, inputs):
    q, c, coll, *_ = inputs
    whole = _scores(P.rerank_feedback(q, c, coll))
    assert whole != _scores(P.rerank_feedback(q, c, coll.withColumn("url", F.lit(""))))


def test_strict_inputs(spark, inputs):
    q, c, coll, *_ = inputs
    P.check_inputs(q.join(c.select("qid").distinct(), "qid", "left_semi"), c, coll)
    one = c.select("doc_id").first()[0]
    with pytest.raises(ValueError, match="document"):
        P.rerank_feedback(q.join(c.select("qid").distinct(), "qid", "left_semi"), c, coll.filter(F.col("doc_id") != one), strict=True)
    with pytest.raises(ValueError, match="candidates"):
        P.check_inputs(q.unionByName(spark.createDataFrame([(10**9, "x")], "qid long, text string")), c, coll)


def test_skipped_queries_and_trec_mean(spark):
    run = spark.createDataFrame([(1, "A", 1, 0.9), (1, "B", 2, 0.8), (2, "A", 1, 0.9)], "qid long, doc_id string, rank int, score double")
    cand = spark.createDataFrame([(1, "A", 1), (3, "A", 1)], "qid long, doc_id string, pos int")
    gold = spark.createDataFrame([(1, "A", 1), (2, "B", 2), (3, "A", 1), (4, "C", 1)], "qid long, doc_id string, relevance int")
    skipped = {tuple(r) for r in ev.skipped_queries(run, cand, gold).collect()}
    assert skipped == {(2, True, False), (3, False, True), (4, False, False)}
    per_q, mean = ev.evaluate(run, cand, gold)
    assert {r.qid for r in per_q.collect()} == {1}
    assert {(r.stage, r.cutoff): r.ndcg for r in mean.collect()}["after", 5] == 0.25
    trec = {r.cutoff: (r.ndcg, r.n_queries) for r in ev.trec_mean(ev.evaluate_trec(run, gold)).collect()}
    assert trec[0] == (0.5, 2)


def test_best_rows_breaks_ties_by_term():
    import numpy as np

    sims = np.array([1.0, 3.0, 2.0, 2.0, 2.0, 0.0])
    terms = np.array(["f", "e", "d", "b", "c", "a"], object)
    assert terms[best_rows(sims, terms, 3)].tolist() == ["e", "b", "c"]
    assert terms[best_rows(sims, terms, 99)].tolist() == ["e", "b", "c", "d", "f", "a"]


def test_given_stems_are_joined(spark):
    from relmod.functions.stems import stemmed_tokens

    stems = spark.createDataFrame([("runners", "runner"), ("running", "run"), ("the", "the")], "word string, stem string")
    df = spark.createDataFrame([(1, "The Runners were running quickly, 3 times"), (2, ""), (3, None)], "id long, t string")
    out = {r.id: r.tokens for r in stemmed_tokens(df, "id", "t", stems, TextOptions(stemming=True)).collect()}
    assert out == {1: ["runner", "run", "quickly", "<num>", "times"], 2: [], 3: []}


def test_local_contexts_by_hand(spark):
    from collections import Counter

    from relmod.operators.lm import CandidateModels
    from relmod.operators.local_context import contexts

    docs = {1: "alpha bravo charlie alpha delta", 2: "bravo alpha", 3: "echo"}
    coll = spark.createDataFrame([(d, "", "", t) for d, t in docs.items()], "doc_id long, url string, title string, body string")
    cand = spark.createDataFrame([(9, d) for d in docs], "qid long, doc_id long")
    m = CandidateModels(cand, coll, P.EMBEDDING_FIELDS)
    qtf = spark.createDataFrame([(9, "alpha", 1), (9, "zulu", 1)], "qid long, term string, qtf long")
    want = Counter()
    for t in docs.values():
        w = t.split()
        for i, x in enumerate(w):
            want.update(("alpha", y) for j, y in enumerate(w) if x == "alpha" and 0 < abs(i - j) <= 2)
    assert {(r.t, r.w): r.n for r in contexts(m, qtf, 2).collect()} == dict(want)
    m.unpersist()


def test_unknown_expansion_words_are_last_or_summed(spark):
    from relmod.operators import expansion as ex
    from relmod.operators.lm import CandidateModels
    from relmod.params import UNK

    coll = spark.createDataFrame([(1, "", "", "alpha bravo")], "doc_id long, url string, title string, body string")
    cand = spark.createDataFrame([(9, 1)], "qid long, doc_id long")
    words = spark.createDataFrame([(9, 1, "alpha", 4.0), (9, 2, "yy", 3.0), (9, 3, "zz", 1.0)], "qid long, rk int, term string, sim double")
    qtf = spark.createDataFrame([(9, "alpha", 1)], "qid long, term string, qtf long")
    for unk, share in (("last", 0.125 / 0.625), ("sum", 0.5)):
        m = CandidateModels(cand, coll, P.EMBEDDING_FIELDS, Params(unk=unk))
        e = {r.term: r.e for r in ex.expansion_model(words, qtf, m).collect()}
        assert abs(e[UNK] - share) < 1e-12 and abs(e["alpha"] - (1 - share)) < 1e-12
        m.unpersist()
