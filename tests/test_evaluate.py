"""NDCG (PIPE-4, PIPE-5) on hand-computed cases."""

import math

import pytest

from relmod.operators import evaluate as ev


def test_ndcg_example(spark):
    run = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 7)], "qid long, doc_id string, rank int")
    qrels = spark.createDataFrame([(1, "a", 2), (1, "c", 1), (2, "z", 1)], "qid long, doc_id string, relevance int")
    cands = spark.createDataFrame([(1, "c", 1), (1, "a", 2), (1, "b", 3), (1, "c", 4)], "qid long, doc_id string, pos int")
    per_q, mean = ev.evaluate(run, cands, qrels)
    got = {(r.stage, r.cutoff): r.ndcg for r in per_q.collect()}
    ideal = 2 + 1 / math.log2(3)
    assert got[("after", 5)] == pytest.approx((2 + 1 / math.log2(4)) / ideal, abs=1e-12)  # 0.9502
    assert got[("after", 5)] == pytest.approx(0.9502, abs=1e-4)
    # before: c, a, b, c (duplicates kept)
    assert got[("before", 5)] == pytest.approx((1 + 2 / math.log2(3) + 1 / math.log2(5)) / ideal, abs=1e-12)
    # the gold query 2 has no run: it counts as 0 in the mean
    m = {(r.stage, r.cutoff): r.ndcg for r in mean.collect()}
    assert m[("after", 5)] == pytest.approx(got[("after", 5)] / 2, abs=1e-12)


def test_ndcg_bounds_and_ideal(spark):
    run = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "qid long, doc_id string, rank int")
    qrels = spark.createDataFrame([(1, "a", 3), (1, "b", 1)], "qid long, doc_id string, relevance int")
    per_q, _ = ev.evaluate(run, run.selectExpr("qid", "doc_id", "rank as pos"), qrels)
    for r in per_q.collect():
        assert r.ndcg == pytest.approx(1.0)


def test_trec_order(spark):
    run = spark.createDataFrame([(1, "a", 1, 0.5), (1, "b", 2, 0.5), (1, "c", 3, 0.9)], "qid long, doc_id string, rank int, score double")
    qrels = spark.createDataFrame([(1, "a", 1), (1, "x", 0)], "qid long, doc_id string, relevance int")
    got = {r.cutoff: r.ndcg for r in ev.evaluate_trec(run, qrels).collect()}
    # order: c (0.9), then the tie b, a by doc id descending -> a at position 3
    assert got[0] == pytest.approx(1 / math.log2(4), abs=1e-12)
