"""What a run reports about itself: flags per query, metrics of the ranking job, the strict form of D8."""

import pytest

from relmod.params import Params
from relmod.plans import pipelines as P


@pytest.fixture(scope="module")
def inputs(spark):
    q = [(1, "alpha bravo"), (2, "zulu"), (3, "the and of"), (4, "alpha"), (5, "alpha yankee")]
    docs = {1: ["alpha", "bravo"] * 5, 2: ["charlie"] * 7, 3: ["alpha"] * 150 + ["bravo"] * 150}
    cands = [(1, 1), (1, 2), (1, 9), (2, 1), (2, 3), (3, 1), (3, 2), (5, 3), (5, 1)]
    return (
        spark.createDataFrame(q, "qid long, text string"),
        spark.createDataFrame([(a, b, 0.0, i) for i, (a, b) in enumerate(cands)], "qid long, doc_id long, score double, pos int"),
        spark.createDataFrame([(d, "", "", " ".join(t)) for d, t in docs.items()], "doc_id long, url string, title string, body string"),
        spark.createDataFrame([("alpha", [1.0, 0.5]), ("bravo", [0.5, 1.0]), ("xray", [0.9, 0.8])], "term string, vec array<double>"),
    )


def flags(report):
    return {r.qid: (r.n_candidates, r.n_documents, r.n_oov, r.empty_query, r.no_vectors, r.unk_dropped) for r in report.queries.collect()}


def test_embedding_run(spark, inputs):
    q, c, coll, vec = inputs
    report = P.RunReport()
    run, _ = P.rerank_embeddings(q, c, coll, vec, report=report)
    assert flags(report) == {
        1: (3, 2, 0, False, False, True),  # 17 tokens: no <UNK> share, and xray is not in the candidates
        2: (2, 2, 1, False, True, False),  # 310 tokens: a share of 1
        3: (2, 2, 0, True, False, False),
        4: (0, 0, 1, False, False, False),
        5: (2, 2, 1, False, False, False),
    }
    scores = [r.score for r in run.collect()]
    seen = report.metrics
    assert seen["n_ranked"] == len(scores) == 8 and seen["n_queries"] == 4
    assert seen["least"] == min(scores) and seen["greatest"] == max(scores)


def test_feedback_run(spark, inputs):
    q, c, coll, _ = inputs
    report = P.RunReport()
    run = P.rerank_feedback(q, c, coll, report=report)
    assert flags(report) == {
        1: (3, 2, 0, False, False, False),
        2: (2, 2, 1, False, False, False),
        3: (2, 2, 0, True, False, False),
        4: (0, 0, 1, False, False, False),
        5: (2, 2, 1, False, False, False),
    }
    assert report.metrics["n_ranked"] == run.count()


def test_strict_vectors(spark, inputs):
    q, c, coll, vec = inputs
    by_default = {(r.qid, r.doc_id): r.score for r in P.rerank_embeddings(q, c, coll, vec)[0].collect()}
    strictly = {(r.qid, r.doc_id): r.score for r in P.rerank_embeddings(q, c, coll, vec, Params(strict_vectors=True))[0].collect()}
    assert by_default.keys() == strictly.keys()
    for k, score in strictly.items():
        # without a vector, query 2 (and the empty query 3) has no term of positive mass
        assert score == (1.0 if k[0] in (2, 3) else by_default[k])
    assert any(by_default[k] != 1.0 for k in by_default if k[0] == 2)
