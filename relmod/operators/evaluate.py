"""NDCG evaluation of runs before and after re-ranking (PIPE-4, PIPE-5).

DCG@k = sum_{pos <= k} rel / log2(pos + 1), linear gain, positions from 1.
Ideal DCG uses all judged documents of the query, relevance descending.
NDCG = DCG / IDCG, 0 when IDCG <= 0. The mean divides by the number of gold
queries; a gold query without a run or without candidates counts as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relmod.operators.ordering import rank_within_auto, rank_within_large, top_k
from relmod.params import CUTOFFS

FULL_DEPTH = 0  # cutoff value that stands for "all positions"


def _dcg(ranked: DataFrame, keys: list[str], cutoffs) -> DataFrame:
    """(keys..., qid, cutoff, dcg) from (keys..., qid, pos, rel); one aggregation, then unpivot."""
    aggs = [
        F.sum(
            F.when(F.lit(k == FULL_DEPTH) | (F.col("pos") <= k), F.col("rel") / F.log2(F.col("pos") + 1))
        ).alias(f"d{k}")
        for k in cutoffs
    ]
    t = ranked.groupBy(*keys, "qid").agg(*aggs)
    cells = F.array(
        *[F.struct(F.lit(k).cast("int").alias("cutoff"), F.coalesce(F.col(f"d{k}"), F.lit(0.0)).alias("dcg")) for k in cutoffs]
    )
    return t.select(*keys, "qid", F.explode(cells).alias("x")).select(*keys, "qid", "x.cutoff", "x.dcg")


def _with_rel(ranked: DataFrame, qrels: DataFrame) -> DataFrame:
    """Attach relevance (0 when unjudged) to ranked documents (JOIN-13)."""
    return ranked.join(qrels.select("qid", "doc_id", F.col("relevance").alias("_r")), ["qid", "doc_id"], "left").withColumn(
        "rel", F.coalesce("_r", F.lit(0)).cast("double")
    ).drop("_r")


def ideal_dcg(qrels: DataFrame, cutoffs=CUTOFFS, positive_only: bool = False) -> DataFrame:
    """(qid, cutoff, idcg) over all judged documents, relevance descending (AGG-19, WIN-4)."""
    j = qrels.filter(F.col("relevance") > 0) if positive_only else qrels
    order = [F.desc("relevance"), F.asc("doc_id")]
    if FULL_DEPTH in cutoffs:
        # every judged document counts: judged sets are not bounded like candidate lists
        ranked = rank_within_large(j, "qid", order, "pos")
    else:
        ranked = top_k(j, "qid", order, max(cutoffs), "pos")  # only the best max(k) matter
    t = ranked.select("qid", "pos", F.col("relevance").cast("double").alias("rel"))
    return _dcg(t, [], cutoffs).withColumnRenamed("dcg", "idcg")


def run_dcg(run: DataFrame, qrels: DataFrame, keys=(), cutoffs=CUTOFFS, order=None) -> DataFrame:
    """(keys..., qid, cutoff, dcg) of a run in rank order (WIN-2, WIN-6, AGG-18)."""
    keys = list(keys)
    order = order or [F.asc("rank")]
    ranked = _positions(run, [*keys, "qid"], order, cutoffs)
    return _dcg(_with_rel(ranked, qrels), keys, cutoffs)


def _positions(df: DataFrame, group: list, order, cutoffs) -> DataFrame:
    """1-based positions; with finite cutoffs only the first max(k) are kept
    (WindowGroupLimit pre-filters before the shuffle), else every position."""
    if FULL_DEPTH in cutoffs:
        return rank_within_auto(df, group, order, "pos")
    return top_k(df, group, order, max(cutoffs), "pos")


def candidates_dcg(candidates: DataFrame, qrels: DataFrame, cutoffs=CUTOFFS) -> DataFrame:
    """(qid, cutoff, dcg) of the candidate lists in their stored order (WIN-3); duplicates kept."""
    ranked = _positions(candidates.withColumnRenamed("pos", "_order"), ["qid"], [F.asc("_order")], cutoffs).drop("_order")
    return _dcg(_with_rel(ranked, qrels), [], cutoffs)


def evaluate(run: DataFrame, candidates: DataFrame, qrels: DataFrame, keys=(), cutoffs=CUTOFFS, settings=()):
    """NDCG before (candidate order) and after (run order).

    Returns ``(per_query, mean)``: per_query is (keys..., qid, stage, cutoff, ndcg)
    for evaluated queries; mean is (keys..., stage, cutoff, ndcg) over all gold queries.
    With ``keys`` (a sweep), ``settings`` lists the key values of every setting.
    """
    keys = list(keys)
    gold = qrels.select("qid").distinct()
    run_q = run.select(*keys, "qid").distinct()
    evaluated = run_q.join(gold, "qid", "left_semi").join(candidates.select("qid").distinct(), "qid", "left_semi")  # JOIN-14
    idcg = ideal_dcg(qrels, cutoffs)
    after = run_dcg(run, qrels, keys, cutoffs).withColumn("stage", F.lit("after"))
    before = evaluated.join(candidates_dcg(candidates, qrels, cutoffs), "qid").withColumn("stage", F.lit("before"))
    both = after.join(evaluated, [*keys, "qid"], "left_semi").unionByName(before)
    per_query = both.join(idcg, ["qid", "cutoff"], "left").select(
        *keys,
        "qid",
        "stage",
        "cutoff",
        F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(0.0)).alias("ndcg"),
    )
    # AGG-21: every gold query counts; skipped ones as 0
    cells = [F.struct(F.lit(s).alias("stage"), F.lit(k).cast("int").alias("cutoff")) for s in ("before", "after") for k in cutoffs]
    grid = gold.select("qid", F.explode(F.array(*cells)).alias("g")).select("qid", "g.stage", "g.cutoff")
    if keys:
        # the sweep's parameter grid is a short literal list, attached by explode (no join)
        ids = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, row)]) for row in settings])
        grid = grid.select("*", F.explode(ids).alias("_s")).select(
            *[F.col(f"_s.{k}").alias(k) for k in keys], "qid", "stage", "cutoff"
        )
    mean = (
        grid.join(per_query, [*keys, "qid", "stage", "cutoff"], "left")
        .groupBy(*keys, "stage", "cutoff")
        .agg(F.avg(F.coalesce("ndcg", F.lit(0.0))).alias("ndcg"))
    )
    return per_query, mean


def skipped_queries(run: DataFrame, candidates: DataFrame, qrels: DataFrame) -> DataFrame:
    """(qid, in_run, in_candidates) of the gold queries that evaluation leaves out (FLT-5, JOIN-14)."""
    gold = qrels.select("qid").distinct()
    seen = lambda df, name: df.select("qid").distinct().withColumn(name, F.lit(True))
    flags = gold.join(seen(run, "in_run"), "qid", "left").join(seen(candidates, "in_candidates"), "qid", "left")
    return flags.select(
        "qid", F.coalesce("in_run", F.lit(False)).alias("in_run"), F.coalesce("in_candidates", F.lit(False)).alias("in_candidates")
    ).filter(~(F.col("in_run") & F.col("in_candidates")))


def trec_mean(per_query: DataFrame) -> DataFrame:
    """(cutoff, ndcg, n_queries): the mean that the external tool prints, over the queries of ``evaluate_trec``."""
    return per_query.groupBy("cutoff").agg(F.avg("ndcg").alias("ndcg"), F.count(F.lit(1)).alias("n_queries"))


def evaluate_trec(run: DataFrame, qrels: DataFrame, cutoffs=(FULL_DEPTH, *CUTOFFS)) -> DataFrame:
    """(qid, cutoff, ndcg) by the external tool's conventions (PIPE-5).

    Documents are ordered by score descending, ties by document id descending
    (as text); the ideal ranking uses positively judged documents only; only
    queries with both a run and judgements are reported. Cutoff 0 = full depth.
    """
    r = run.withColumn("_doc_txt", F.col("doc_id").cast("string"))
    order = [F.desc(F.round("score", 4)), F.desc("_doc_txt")]  # the run file holds 4 decimals
    dcg = run_dcg(r, qrels, (), cutoffs, order=order)
    idcg = ideal_dcg(qrels, cutoffs, positive_only=True)
    judged = qrels.select("qid").distinct()
    return dcg.join(judged, "qid", "left_semi").join(idcg, ["qid", "cutoff"], "left").select(
        "qid",
        "cutoff",
        F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(0.0)).alias("ndcg"),
    )
