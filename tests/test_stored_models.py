"""Models written once and read by other methods, and the bitmap filter of the collection."""

import pytest
from test_scoring import corpus, frames

from relmod.operators import lm
from relmod.operators.lm import CandidateModels
from relmod.params import Params
from relmod.plans import pipelines as P


@pytest.mark.parametrize("chunk", [250, 2])
def test_stored_models_give_the_same_runs_without_exchange(spark, tmpdir_run, monkeypatch, chunk):
    monkeypatch.setattr(CandidateModels, "PAIRS_PER_CHUNK", chunk)
    queries, cands, docs = corpus(seed=21, n_docs=12)
    q, c, coll = frames(spark, queries, cands, {d: t * 5 for d, t in docs.items()})
    vec = spark.createDataFrame([("alpha", [1.0, 0.2]), ("kilo", [0.1, 0.9]), ("nope", [0.8, 0.8])], "term string, vec array<double>")
    models, _ = P._embedding_models(q, c, coll, Params())
    models.save(f"{tmpdir_run}/models")
    models.unpersist()
    stored = CandidateModels.load(spark, f"{tmpdir_run}/models")
    fresh, _ = P.rerank_embeddings(q, c, coll, vec)
    again, exps = P.rerank_embeddings(q, None, None, vec, models=stored)
    assert sorted(map(tuple, fresh.collect())) == sorted(map(tuple, again.collect()))
    a = {tuple(r)[:2]: r.score for r in P.rerank_feedback(q, c, coll).collect()}
    b = {tuple(r)[:2]: r.score for r in P.rerank_feedback(q, None, None, models=stored).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-12
    gold = spark.createDataFrame([(100, 0, 1), (101, 3, 2)], "qid long, doc_id long, relevance int")
    sweep = [sorted(map(tuple, P.sweep_from_expansions(q, c, coll, exps, gold, [(200, 0.2), (800, 0.5)], models=m).collect())) for m in (None, stored)]
    assert sweep[0] == sweep[1]
    # sums within buckets read the stored layout as it is
    sums = stored.exploded().groupBy("bucket", "qid", "term_id").count()
    joined = stored.exploded().join(stored.bucket_bg, ["bucket", "qid", "term_id"]).groupBy("bucket", "qid", "doc_id").count()
    for df in (sums, joined):
        df.collect()
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bound", [0, 4096, 3 * 4096, 64 << 20])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_bitmaps_keep_the_candidates_and_no_others(spark, bound, kind):
    ids = spark.range(0, 20_000, 4).selectExpr(f"cast(id as {kind}) as doc_id")
    docs = spark.range(0, 30_000).selectExpr(f"cast(id as {kind}) as doc_id", "'text' as body").unionByName(
        spark.createDataFrame([(None, "no id")], f"doc_id {kind}, body string")
    )
    got = lm.candidate_documents(ids.unionByName(ids), docs, Params(broadcast_bytes=bound))
    assert sorted(int(r.doc_id) for r in got.collect()) == list(range(0, 20_000, 4))
    plan = got._jdf.queryExecution().executedPlan().toString()
    if bound >= 3 * 4096:
        assert "Exchange hashpartitioning(doc_id" not in plan  # no text is moved
    near = lm.bitmap_filter(docs, ids, 5000, 64 << 20).count()
    assert 5000 <= near < 7000


def test_no_candidates(spark):
    ids = spark.createDataFrame([], "doc_id long")
    assert lm.bitmap_filter(spark.range(5).withColumnRenamed("id", "doc_id"), ids, 0, 1 << 20).collect() == []
