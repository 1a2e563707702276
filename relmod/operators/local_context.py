"""Query-local expansion from word contexts (ML-1), by counting instead of training.

In a query's candidate documents, a word's association with a query term is
the positive pointwise mutual information of the two standing at most
``window`` tokens apart:

  s(w) = sum_t qtf(t) max(0, ln(n(t, w) N / (cf(t) cf(w))))

where n counts pairs of positions, cf counts occurrences and N tokens, all
over the query's candidates. The K words of the highest s are its expansion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relmod.operators.expansion import SIM_DIGITS
from relmod.operators.lm import CandidateModels
from relmod.operators.ordering import top_k
from relmod.params import UNK

WINDOW = 20


def contexts(models: CandidateModels, qtf: DataFrame, window: int = WINDOW) -> DataFrame:
    """(qid, t, w, n): how often w stands at most ``window`` tokens from query term t in q's candidates.

    Only the places of query terms are expanded, to the tokens around them;
    counts are partially aggregated before they are shuffled.
    """
    terms = qtf.groupBy("qid").agg(F.collect_set("term").alias("_terms"))  # as many as a query has
    docs = models.cset.select("qid", "doc_id").join(models.doc_tokens, "doc_id").join(terms, "qid")
    places = F.filter(F.sequence(F.lit(1), F.size("tokens")), lambda i: F.array_contains("_terms", F.element_at("tokens", i)))
    at = docs.filter(F.size("tokens") > 0).select("qid", "tokens", F.explode(places).alias("i"))
    first = F.greatest(F.col("i") - window, F.lit(1))
    around = at.select(
        "qid",
        F.element_at("tokens", F.col("i")).alias("t"),
        F.explode(
            F.concat(F.slice("tokens", first, F.col("i") - first), F.slice("tokens", F.col("i") + 1, F.lit(window)))
        ).alias("w"),
    )
    return around.groupBy("qid", "t", "w").agg(F.count(F.lit(1)).alias("n"))


def local_expansions(models: CandidateModels, qtf: DataFrame, k: int, window: int = WINDOW) -> DataFrame:
    """(qid, rk, term, sim): the k words that stand with a query's terms most, ties by term."""
    counts = models.bg.filter(F.col("term") != UNK).select("qid", "term", "cf", F.col("n").alias("_all"))
    pairs = (
        contexts(models, qtf, window)
        .join(counts.withColumnsRenamed({"term": "w", "cf": "_w"}), ["qid", "w"])
        .join(counts.select("qid", F.col("term").alias("t"), F.col("cf").alias("_t")), ["qid", "t"])
        .join(qtf.withColumnRenamed("term", "t"), ["qid", "t"])
    )
    ratio = F.col("n").cast("double") * F.col("_all") / (F.col("_t").cast("double") * F.col("_w"))
    sims = pairs.groupBy("qid", F.col("w").alias("term")).agg(
        F.round(F.sum(F.col("qtf") * F.greatest(F.log(ratio), F.lit(0.0))), SIM_DIGITS).alias("sim")
    )
    best = top_k(sims.filter("sim > 0"), "qid", [F.desc("sim"), F.asc("term")], k, "rk")
    return best.select("qid", F.col("rk").cast("int").alias("rk"), "term", "sim")
