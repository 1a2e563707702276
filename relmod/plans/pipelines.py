"""User-level pipelines: every function takes and returns DataFrames, none collects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from relmod.operators import expansion as ex
from relmod.operators import evaluate as ev
from relmod.operators import feedback as fb
from relmod.operators import local_context as lc
from relmod.operators import local_vectors as lv
from relmod.operators.lm import CandidateModels, query_term_freq
from relmod.operators.ordering import rank_within_auto
from relmod.params import UNK, Params, checked_mu
from relmod.session import materialize

# Task 0 reads url, title and body; the embedding tasks read title and body (PRJ-1).
FEEDBACK_FIELDS = ("url", "title", "body")
EMBEDDING_FIELDS = ("title", "body")

# Scores equal to this many decimals are ties, broken by doc_id ascending (D12).
RANK_DIGITS = 9


class RunReport:
    """What a run met and left out (AGG-22, D4, D7-D9); give one to a re-ranking, read it afterwards.

    ``queries``: (qid, n_candidates, n_documents, n_oov, empty_query, no_vectors,
    unk_dropped), one row per listed query, stored while the run's models still
    stand; none is built for it.
    ``metrics``: n_ranked, n_queries (about) and the least and greatest score, observed by
    the ranking job itself.
    """

    def __init__(self):
        self.queries: DataFrame | None = None
        self._seen = Observation("ranking")

    @property
    def metrics(self) -> dict:
        return self._seen.get

    def observed(self, scores: DataFrame) -> DataFrame:
        return scores.observe(
            self._seen,
            F.count(F.lit(1)).alias("n_ranked"),
            F.approx_count_distinct("qid").alias("n_queries"),
            F.min("score").alias("least"),
            F.max("score").alias("greatest"),
        )

    def describe(self, queries: DataFrame, models: CandidateModels, qtf: DataFrame, exps=None, rm=None) -> None:
        """Fills ``queries``; ``exps`` and ``rm`` are the expansions and relevance model of the embedding tasks."""
        count = lambda df, name: df.groupBy("qid").agg(F.count(F.lit(1)).alias(name))
        flag = lambda df, name: df.select("qid").distinct().withColumn(name, F.lit(True))
        qids = queries.select("qid").distinct()
        parts = [
            count(models.cset, "n_candidates"),
            count(models.cand_len, "n_documents"),
            count(fb.oov_tokens(qtf, models), "n_oov"),
            flag(qids.join(qtf, "qid", "left_anti"), "empty_query"),
        ]
        if exps is not None:
            listed = qids.join(models.cset.select("qid").distinct(), "qid", "left_semi").join(qtf.select("qid").distinct(), "qid", "left_semi")
            parts.append(flag(listed.join(exps, "qid", "left_anti"), "no_vectors"))
            no_share = models.unk.filter("cf = 0").select("qid")
            parts.append(flag(rm.filter((F.col("term") == UNK) & (F.col("r") > 0)).join(no_share, "qid"), "unk_dropped"))
        out = qids
        for part in parts:
            out = out.join(part, "qid", "left")
        no = lambda c: F.coalesce(c, F.lit(False)) if c in out.columns else F.lit(False)
        self.queries = materialize(
            out.select(
                "qid",
                *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_candidates", "n_documents", "n_oov")],
                *[no(c).alias(c) for c in ("empty_query", "no_vectors", "unk_dropped")],
            )
        )


def rank_run(scores: DataFrame, keys=("qid",), report: RunReport | None = None) -> DataFrame:
    """(keys..., doc_id, rank, score): best first, 1-based (WIN-1). The scores are stored before they are ranked."""
    scores = report.observed(scores) if report else scores
    return rank_within_auto(
        scores, list(keys), [F.desc(F.round("score", RANK_DIGITS)), F.asc("doc_id")], "rank"
    ).withColumn("rank", F.col("rank").cast("int"))


def rerank_feedback(
    queries: DataFrame,
    candidates: DataFrame,
    collection: DataFrame,
    params: Params = Params(),
    strict: bool = False,
    report: RunReport | None = None,
    models: CandidateModels | None = None,
) -> DataFrame:
    """Task 0 (PIPE-0): re-rank every query's candidates by 1 - KL against its feedback model.

    ``queries`` (qid, text), ``candidates`` (qid, doc_id, ...), ``collection``
    (doc_id, url, title, body). Returns (qid, doc_id, rank, score). With
    ``strict``, incomplete inputs raise instead of being left out; ``report``
    is told what was. Given ``models`` (``CandidateModels.load``) are used as they
    stand and kept.
    """
    if strict:
        check_inputs(queries, candidates, collection)
    kept = models is not None
    if not kept:
        # JOIN-2: only listed queries are ranked; candidates of unknown queries are ignored
        candidates = candidates.join(queries.select("qid"), "qid", "left_semi")
        models = CandidateModels(candidates, collection, FEEDBACK_FIELDS, params)
    qtf = query_term_freq(queries, params)
    if params.oov == "error":
        bad = fb.oov_tokens(qtf, models).limit(1).count()
        if bad:
            raise ValueError("query terms absent from all candidates (oov='error')")
    run = rank_run(fb.rescore(qtf, models), report=report).select("qid", "doc_id", "rank", "score")
    if report:
        report.describe(queries, models, qtf)
    if not kept:
        models.unpersist()
    return run


def _embedding_models(queries, candidates, collection, params):
    candidates = candidates.join(queries.select("qid"), "qid", "left_semi")
    models = CandidateModels(candidates, collection, EMBEDDING_FIELDS, params)
    return models, query_term_freq(queries, params)


def expansions_from_vectors(queries: DataFrame, vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """(qid, rk, term, sim): top-K expansion words of every query from a vector table (ML-2)."""
    qtf = query_term_freq(queries, params)
    return ex.expand(vectors, ex.centroids(qtf, vectors, params), params.top_k)


def rerank_embeddings(
    queries: DataFrame,
    candidates: DataFrame,
    collection: DataFrame,
    vectors: DataFrame,
    params: Params = Params(),
    strict: bool = False,
    report: RunReport | None = None,
    models: CandidateModels | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Tasks 2.1 / 2.2 (PIPE-2, 3): expansion from given word vectors, then Score B.

    ``vectors`` is (term, vec array<double|float>) from ``read_embeddings`` (GloVe
    or word2vec text) or any table. Returns (run, expansions).
    """
    if strict:
        check_inputs(queries, candidates, collection)
    kept = models is not None
    models, qtf = (models, query_term_freq(queries, params)) if kept else _embedding_models(queries, candidates, collection, params)
    exps = materialize(ex.expand(vectors, ex.centroids(qtf, vectors, params), params.top_k, broadcast_bytes=params.broadcast_bytes))
    return _ranked(queries, models, qtf, exps, params, report, kept), exps


def _ranked(queries, models, qtf, exps, params, report, kept: bool = False) -> DataFrame:
    """The run of Score B that expansions lead to; frees the models unless they are kept."""
    rm = ex.relevance_model(ex.expansion_model(exps, qtf, models), params.lam, params.strict_vectors)
    rm = materialize(rm) if report else rm
    run = rank_run(ex.score_b(rm, models), report=report).select("qid", "doc_id", "rank", "score")
    if report:
        report.describe(queries, models, qtf, exps, rm)
    if not kept:
        models.unpersist()
    return run


def evaluate(run: DataFrame, candidates: DataFrame, qrels: DataFrame, cutoffs=ev.CUTOFFS):
    """PIPE-4: (per_query, mean) NDCG before and after re-ranking."""
    return ev.evaluate(run, candidates, qrels, cutoffs=cutoffs)


def sweep_from_expansions(
    queries: DataFrame,
    candidates: DataFrame,
    collection: DataFrame,
    expansions: DataFrame,
    qrels: DataFrame,
    settings,
    params: Params = Params(),
    cutoffs=ev.CUTOFFS,
    models: CandidateModels | None = None,
) -> DataFrame:
    """PIPE-6/7: NDCG means for every (mu, lambda) setting in one Spark job.

    ``settings`` is a list of (mu, lam). Expansions do not depend on mu or
    lambda and are computed once; the setting id is a grouping key next to
    qid everywhere downstream. Returns (setting_id, mu, lam, stage, cutoff, ndcg).
    """
    settings = [(checked_mu(m), float(l)) for m, l in settings]
    kept = models is not None
    models, qtf = (models, query_term_freq(queries, params)) if kept else _embedding_models(queries, candidates, collection, params)
    return _swept(models, qtf, expansions, candidates, qrels, settings, params, cutoffs, kept)


def _swept(models, qtf, expansions, candidates, qrels, settings, params, cutoffs=ev.CUTOFFS, kept: bool = False) -> DataFrame:
    """A sweep of checked settings on models that stand; frees them unless they are kept."""
    em = ex.expansion_model(expansions, qtf, models)
    grid = F.array(
        *[F.struct(F.lit(i).alias("setting_id"), F.lit(m).alias("mu"), F.lit(l).alias("lam")) for i, (m, l) in enumerate(settings)]
    )
    ems = em.select("*", F.explode(grid).alias("_s")).select("_s.setting_id", "_s.mu", "_s.lam", "qid", "term", "e", "o")
    rm = ex.relevance_model(ems, F.col("lam"), params.strict_vectors)
    scores = ex.score_b(rm, models, settings=[(i, m) for i, (m, _) in enumerate(settings)])
    run = rank_run(scores, keys=("setting_id", "qid"))
    if not kept:
        models.unpersist()
    _, mean = ev.evaluate(run, candidates, qrels, keys=["setting_id"], cutoffs=cutoffs, settings=[(i,) for i in range(len(settings))])
    info = F.array(*[F.struct(F.lit(m).alias("mu"), F.lit(l).alias("lam")) for m, l in settings])
    return mean.select(
        "setting_id",
        F.element_at(info, F.col("setting_id") + 1)["mu"].alias("mu"),
        F.element_at(info, F.col("setting_id") + 1)["lam"].alias("lam"),
        "stage",
        "cutoff",
        "ndcg",
    )


def sweep_embeddings(queries, candidates, collection, vectors, qrels, settings, params: Params = Params()) -> DataFrame:
    """PIPE-6 (mu over Task 2.1) and PIPE-7 (lambda over Task 2.2) with given vectors."""
    exps = expansions_from_vectors(queries, vectors, params)
    return sweep_from_expansions(queries, candidates, collection, exps, qrels, settings, params)


def _local_expansions(queries, candidates, collection, params, window):
    models, qtf = _embedding_models(queries, candidates, collection, params)
    return models, qtf, materialize(lc.local_expansions(models, qtf, params.top_k, window))


def rerank_local(
    queries: DataFrame,
    candidates: DataFrame,
    collection: DataFrame,
    params: Params = Params(),
    window: int = lc.WINDOW,
    report: RunReport | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Task 1 (PIPE-1): expansion from the contexts of a query's own candidates, Score B.

    Returns (run, expansions).
    """
    models, qtf, exps = _local_expansions(queries, candidates, collection, params, window)
    return _ranked(queries, models, qtf, exps, params, report), exps


def rerank_local_vectors(
    queries: DataFrame,
    candidates: DataFrame,
    collection: DataFrame,
    params: Params = Params(),
    d: int = 16,
    window: int = lv.WINDOW,
    rounds: int = 5,
    negatives: int = 1,
    report: RunReport | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Task 1 (PIPE-1) with vectors: each query's own word vectors, the words next to its terms, Score B.

    Returns (run, expansions).
    """
    models, qtf = _embedding_models(queries, candidates, collection, params)
    vectors = materialize(lv.local_vectors(models, d, window, rounds, negatives))
    exps = materialize(lv.local_vector_expansions(vectors, qtf, params.top_k))
    return _ranked(queries, models, qtf, exps, params, report), exps


def sweep_local(queries, candidates, collection, qrels, settings, params: Params = Params(), window: int = lc.WINDOW):
    """PIPE-6 for Task 1: models built and local expansions counted once, then every (mu, lambda) setting."""
    settings = [(checked_mu(m), float(l)) for m, l in settings]
    models, qtf, exps = _local_expansions(queries, candidates, collection, params, window)
    return _swept(models, qtf, exps, candidates, qrels, settings, params)


# ---------------------------------------------------------------------------
# what a run leaves out
# ---------------------------------------------------------------------------
def missing_documents(queries: DataFrame, candidates: DataFrame, collection: DataFrame) -> DataFrame:
    """(qid, doc_id) of listed queries' candidates that the collection lacks (D15)."""
    listed = candidates.join(queries.select("qid"), "qid", "left_semi").select("qid", "doc_id").distinct()
    return listed.join(collection.select("doc_id"), "doc_id", "left_anti").select("qid", "doc_id")


def queries_without_candidates(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """(qid): queries that no candidate names."""
    return queries.select("qid").distinct().join(candidates.select("qid"), "qid", "left_anti")


def check_inputs(queries: DataFrame, candidates: DataFrame, collection: DataFrame) -> None:
    """Strict mode: raises where a query has no candidates or a candidate no document."""
    for name, report in (
        ("queries without candidates", queries_without_candidates(queries, candidates)),
        ("candidates without a document", missing_documents(queries, candidates, collection)),
    ):
        some = report.take(3)
        if some:
            raise ValueError(f"{name}: {', '.join(map(str, map(tuple, some)))} ...")
