"""Pseudo-relevance feedback (Task 0): query likelihood, feedback model, Score A.

All forms are sparse: they touch only (query, document, term) rows with a
non-zero count, never the candidates x vocabulary or candidates x query-terms
products. With a_d = w_d / (|d| + mu):

  ll(d)   = sum_t qtf ln(mu p_bg) - Qn ln(|d| + mu) + sum_{t in d} qtf ln((tf + mu p_bg) / (mu p_bg))
  w_d     = exp(ll - max ll) / sum exp(ll - max ll)          (= P(q|d) / sum P(q|d'))
  p_rm(t) = sum_{d with t} tf a_d + mu p_bg(t) sum_d a_d
  A(d)    = 1 - sum_{t in d} p(t|d) ln(p(t|d) / p_rm(t))      (empty d -> 1)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relmod.operators.lm import CandidateModels
from relmod.params import checked_mu
from relmod.session import broadcast_if_small, materialize


def in_vocabulary(qtf: DataFrame, models: CandidateModels) -> DataFrame:
    """Query terms found in the candidates, with their background probability (JOIN-5/9)."""
    return models.lookup(qtf).select("qid", "term_id", "qtf", "p_bg")


def oov_tokens(qtf: DataFrame, models: CandidateModels) -> DataFrame:
    """Query terms that occur in no candidate (D4): skipped by Task 0, counted here."""
    flagged = models.in_vocabulary(qtf)
    return flagged.filter(~F.col("in_v")).drop("in_v")


def softmax(df: DataFrame, value: str, group: str, within: str, attach) -> DataFrame:
    """``df`` with ``w``: exp(value) as a share of its group's sum, for groups of any size (AGG-9, D5).

    A group's part in one ``within`` partition gives a state: its maximum and
    the sum of exp(value - maximum). States merge, each sum scaled to the
    greater maximum, so no task sees a whole group and nothing over- or
    underflows. ``attach`` joins the merged states, one row per group, on ``group``.
    """
    part = Window.partitionBy(within, group)  # rows of one partition
    states = (
        df.withColumn("_max", F.max(value).over(part))
        .groupBy(within, group, "_max")
        .agg(F.sum(F.exp(F.col(value) - F.col("_max"))).alias("_sum"))
    )
    top = states.groupBy(group).agg(F.max("_max").alias("_top"))
    scaled = F.sum(F.col("_sum") * F.exp(F.col("_max") - F.col("_top"))).alias("_all")
    merged = states.join(top, group).groupBy(group, "_top").agg(scaled)
    return attach(df, merged, group).withColumn("w", F.exp(F.col(value) - F.col("_top")) / F.col("_all")).drop("_top", "_all")


def query_likelihood(qtf: DataFrame, models: CandidateModels, mu=None) -> DataFrame:
    """(bucket, qid, doc_id, doc_len, ll, w): log query likelihood and its normalised weight (AGG-8, 9)."""
    mu = checked_mu(models.params.mu if mu is None else mu)
    qv = materialize(in_vocabulary(qtf, models).withColumn("mpb", F.lit(mu) * F.col("p_bg")))
    qconst = qv.groupBy("qid").agg(
        F.sum(F.col("qtf") * F.log(F.col("mpb"))).alias("a"), F.sum("qtf").alias("qn")
    )
    keys = ["bucket", "qid", "doc_id"]
    hits = (
        models.attach_terms(models.exploded(), qv.select("qid", "term_id", "qtf", "mpb"), ["qid", "term_id"])
        .groupBy(*keys)
        .agg(F.sum(F.col("qtf") * F.log((F.col("tf") + F.col("mpb")) / F.col("mpb"))).alias("h"))
    )
    ll = models.attach(models.attach(models.lengths(), qconst, "qid", "left"), hits, keys, "left").select(
        *keys,
        "doc_len",
        (
            F.coalesce("a", F.lit(0.0))
            - F.coalesce("qn", F.lit(0)) * F.log(F.col("doc_len") + F.lit(mu))
            + F.coalesce("h", F.lit(0.0))
        ).alias("ll"),
    )
    # checkpointed: the softmax and the feedback model read it more than once
    return materialize(softmax(materialize(ll), "ll", "qid", "bucket", models.attach))


def feedback_model(lik: DataFrame, models: CandidateModels, mu=None) -> DataFrame:
    """(qid, term, p_rm, p_bg) over V_q plus <UNK> (AGG-10), sparse form."""
    in_buckets, s = _feedback(lik, models, mu)
    mu = checked_mu(models.params.mu if mu is None else mu)
    rest = models.attach(models.unk, s, "qid").select(
        "qid", "term_id", (F.lit(mu) * F.col("p_bg") * F.col("s")).alias("p_rm"), "p_bg"
    )
    return models.with_terms(models.by_query(in_buckets).unionByName(rest))


def _feedback(lik: DataFrame, models: CandidateModels, mu=None) -> tuple[DataFrame, DataFrame]:
    """(bucket, qid, large, term_id, p_rm, p_bg) over V_q, partitioned by bucket, and (qid, s): the sum of all a_d."""
    mu = checked_mu(models.params.mu if mu is None else mu)
    a = lik.select("bucket", "qid", "doc_id", (F.col("w") / (F.col("doc_len") + F.lit(mu))).alias("a"))
    s = a.groupBy("qid").agg(F.sum("a").alias("s"))  # one row per query
    sums = (
        models.exploded(models.attach(models.pairs, a, ["bucket", "qid", "doc_id"]))
        .groupBy("bucket", "qid", "large", "term_id")
        .agg(F.sum(F.col("tf") * F.col("a")).alias("direct"))
    )
    direct = models.totals(sums, "direct").drop("large")
    base = models.attach(models.bucket_bg.select("bucket", "qid", "large", "term_id", "p_bg"), s, "qid")
    p_rm = (F.coalesce("direct", F.lit(0.0)) + F.lit(mu) * F.col("p_bg") * F.col("s")).alias("p_rm")
    keys = ["bucket", "qid", "term_id"]
    return base.join(direct, keys, "left").select("bucket", "qid", "large", "term_id", p_rm, "p_bg"), s


def score_a(p_rm: DataFrame, models: CandidateModels, mu=None) -> DataFrame:
    """(qid, doc_id, score): 1 - KL(document || feedback model), natural log (AGG-11).

    ``p_rm`` is (bucket, qid, term_id, p_rm, p_bg), as ``rescore`` makes it, or
    ``feedback_model``'s (qid, term, p_rm, p_bg).
    """
    mu = checked_mu(models.params.mu if mu is None else mu)
    if "bucket" not in p_rm.columns:
        words = broadcast_if_small(models.dictionary.select("term", "term_id"), models.params.broadcast_bytes)
        held = models.bucket_bg.select("bucket", "qid", "term_id")
        p_rm = p_rm.join(words, "term").drop("term").join(held, ["qid", "term_id"])
    keys = ["bucket", "qid", "doc_id"]
    t = models.exploded().join(p_rm.select("bucket", "qid", "term_id", "p_rm", "p_bg"), ["bucket", "qid", "term_id"])
    p = (F.col("tf") + F.lit(mu) * F.col("p_bg")) / (F.col("doc_len") + F.lit(mu))
    kl = t.withColumn("p", p).groupBy(*keys).agg(F.sum(F.col("p") * F.log(F.col("p") / F.col("p_rm"))).alias("kl"))
    # start from the candidates: empty documents have no terms and score 1 (D10)
    return models.attach(models.lengths(), kl, keys, "left").select(
        "qid", "doc_id", (F.lit(1.0) - F.coalesce("kl", F.lit(0.0))).alias("score")
    )


def rescore(qtf: DataFrame, models: CandidateModels, mu=None) -> DataFrame:
    """(qid, doc_id, score): likelihood, feedback model and Score A on the models' own tables (Task 0)."""
    in_buckets, _ = _feedback(query_likelihood(qtf, models, mu), models, mu)
    return score_a(in_buckets, models, mu)
