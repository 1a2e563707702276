"""Embedding-based query expansion and Score B (Tasks 1, 2.1, 2.2).

* centroid  c_q = sum_t qtf(t) vec(t) over query tokens with a vector (not averaged)
* sim(w)    = vec(w) . c_q for every vocabulary word; top K by sim desc, term asc
* expansion weights w_i = sim_i / sum sim, folded to <UNK> outside V_q with the
  last (lowest-ranked) weight kept, then renormalised
* r(t)      = lam * exp(t) / sum exp + (1 - lam) * orig(t) / sum orig
* B(d)      = 1 - sum_{t: r(t)>0} r log10(r / p(t|d)), computed sparsely as
              1 - C_q + H(d) - R_q log10(|d| + mu) with
              C_q = sum r log10(r / (mu p_bg)), R_q = sum r,
              H(d) = sum_{t in d} r log10((tf + mu p_bg) / (mu p_bg)).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relmod.operators.lm import CandidateModels
from relmod.operators.ordering import dense_index, top_k
from relmod.params import UNK, Params, checked_mu
from relmod.session import broadcast_if_small, materialize

# Similarities are rounded to this many decimals before ranking, so equal
# values (to 1e-9) tie and fall back to the term order on every engine.
SIM_DIGITS = 9


def centroids(qtf: DataFrame, vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """(qid, c array<double>): sum of qtf-weighted vectors of in-vocabulary query tokens (AGG-14).

    The query-term side is broadcast after a size check; the vocabulary streams.
    Per-dimension sums are partially aggregated before the shuffle.
    """
    hit = vectors.join(broadcast_if_small(materialize(qtf), params.broadcast_bytes), "term")  # JOIN-8 / FLT-6
    dims = hit.select("qid", "qtf", F.posexplode("vec").alias("i", "v")).groupBy("qid", "i").agg(
        F.sum(F.col("qtf") * F.col("v")).alias("s")
    )
    return dims.groupBy("qid").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("c")
    )


def best_rows(sims: np.ndarray, terms: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest values, by (value descending, term ascending)."""
    if len(sims) > k:
        least = np.partition(sims, len(sims) - k)[len(sims) - k]
        near = np.flatnonzero(sims >= least)  # the k best and all that tie with the last of them
    else:
        near = np.arange(len(sims))
    return near[np.lexsort((terms[near], -sims[near]))][:k]


#: Words of a block of vectors, queries of a block of centroids, and the blocks that every query visits first.
BLOCK_WORDS = 256
BLOCK_QUERIES = 64
FIRST_BLOCKS = 2
#: What rounding may add to a similarity: that of ranking, and that of floating point sums.
_SLACK, _RELATIVE = 10.0 ** (1 - SIM_DIGITS), 1e-9


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def norm_blocks(vectors: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, bound, terms, m): the vectors by falling norm, in blocks of ``block_words``.

    ``bound`` is the block's greatest norm, ``m`` its vectors one after another.
    """
    rows = vectors.select("term", F.col("vec").cast("array<double>").alias("vec")).withColumn("norm", _norm("vec"))
    placed = dense_index(rows, [F.desc("norm"), F.asc("term")], "at").withColumn("block", F.floor(F.col("at") / block_words))
    packed = placed.groupBy("block").agg(F.max("norm").alias("bound"), F.sort_array(F.collect_list(F.struct("at", "term", "vec"))).alias("v"))
    return materialize(packed.select("block", "bound", F.col("v.term").alias("terms"), F.flatten("v.vec").alias("m")))


def query_blocks(cents: DataFrame, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(need, qids, least, c) of (qid, c, least): queries in blocks, those alike in what they need together.

    ``least`` is the similarity that a query's results must reach, ``need`` the
    least norm of a word that can reach it, for the least demanding query of the block.
    """
    need = (F.col("least") - _SLACK) / _norm("c") * (1 - _RELATIVE)
    rows = cents.withColumn("need", F.when((F.col("least") > _SLACK) & (_norm("c") > 0), need).otherwise(F.lit(float("-inf"))))
    placed = dense_index(rows, [F.asc("need"), F.asc("qid")], "at").withColumn("part", F.floor(F.col("at") / block_queries))
    packed = placed.groupBy("part").agg(
        F.min("need").alias("need"), F.sort_array(F.collect_list(F.struct("at", "qid", "least", "c"))).alias("v")
    )
    return materialize(packed.select("need", F.col("v.qid").alias("qids"), F.col("v.least").alias("least"), F.flatten("v.c").alias("c")))


def expand(
    vectors: DataFrame,
    cents: DataFrame,
    k: int,
    block_words: int = BLOCK_WORDS,
    block_queries: int = BLOCK_QUERIES,
    first: int = FIRST_BLOCKS,
    broadcast_bytes: int = Params.broadcast_bytes,
) -> DataFrame:
    """(qid, rk, term, sim): the k words most similar to each query centroid (ML-2, WIN-5).

    Exact, for any number of queries in the same few jobs. No word's similarity
    exceeds its norm times the centroid's. Every query is multiplied with the
    ``first`` blocks of the largest norms, which gives a similarity that k words
    reach; then each block of queries meets the other blocks of vectors whose
    greatest norm can still reach it, and no others (``visited_blocks`` counts
    them). A pair of blocks is one matrix product that hands on k words per
    query; a final ``row_number() <= k`` picks from these.
    """
    blocks = norm_blocks(vectors, block_words)
    seen, rest, _ = _visits(blocks, cents, k, block_queries, first, broadcast_bytes)
    return _best(seen.unionByName(_products(rest, k, cents)), k)


def visited_blocks(vectors: DataFrame, cents: DataFrame, k: int, block_words=BLOCK_WORDS, block_queries=BLOCK_QUERIES, first=FIRST_BLOCKS) -> DataFrame:
    """(pairs, visited): pairs of blocks in all, and those that ``expand`` multiplies."""
    blocks = norm_blocks(vectors, block_words)
    _, rest, asked = _visits(blocks, cents, k, block_queries, first, Params.broadcast_bytes)
    n = blocks.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("block") < first, 1)).alias("n_first"))
    parts = asked.agg(F.count(F.lit(1)).alias("parts"))
    more = rest.agg(F.count(F.lit(1)).alias("more"))  # one row each
    return n.join(F.broadcast(parts)).join(F.broadcast(more)).select(
        (F.col("n") * F.col("parts")).alias("pairs"), (F.col("n_first") * F.col("parts") + F.col("more")).alias("visited")
    )


def _visits(blocks, cents, k, block_queries, first, broadcast_bytes):
    """What the first blocks give, the pairs of blocks to multiply after them, and the blocks of queries."""
    cents = materialize(cents.withColumn("least", F.lit(float("-inf"))))
    asked = query_blocks(cents, block_queries)
    start = blocks.filter(F.col("block") < first).join(broadcast_if_small(asked, broadcast_bytes))
    seen = materialize(_best(_products(start, k, cents), k).drop("rk"))
    reached = seen.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("reached")).filter(F.col("n") >= k)
    known = cents.drop("least").join(reached.select("qid", "reached"), "qid", "left")
    asked = query_blocks(known.select("qid", "c", F.coalesce("reached", F.lit(float("-inf"))).alias("least")), block_queries)
    rest = blocks.filter(F.col("block") >= first).join(broadcast_if_small(asked, broadcast_bytes), F.col("bound") >= F.col("need"))
    return seen, rest, asked


def _best(found: DataFrame, k: int) -> DataFrame:
    return top_k(found, "qid", [F.desc("sim"), F.asc("term")], k, "rk").select(
        "qid", F.col("rk").cast("int").alias("rk"), "term", "sim"
    )


def _products(pairs: DataFrame, k: int, cents: DataFrame) -> DataFrame:
    """(qid, term, sim): of every pair of blocks, the k most similar words of each query that can be among its results."""
    qtype = cents.schema["qid"].dataType.simpleString()
    return pairs.select("terms", "m", "qids", "least", "c").mapInPandas(_multiplied(k), f"qid {qtype}, term string, sim double")


def _multiplied(k: int):
    def run(batches):
        for batch in batches:
            for terms, m, qids, least, c in zip(*(batch[x] for x in batch.columns), strict=True):
                terms, qids = np.asarray(terms, object), np.asarray(qids)
                m, c = np.asarray(m, np.float64).reshape(len(terms), -1), np.asarray(c, np.float64).reshape(len(qids), -1)
                sims = np.round(m @ c.T, SIM_DIGITS)
                best = []
                for j in range(len(qids)):
                    near = np.flatnonzero(sims[:, j] >= least[j])
                    best.append(near[best_rows(sims[near, j], terms[near], k)])
                yield pd.DataFrame(
                    {
                        "qid": np.repeat(qids, [len(b) for b in best]),
                        "term": np.concatenate([terms[b] for b in best]),
                        "sim": np.concatenate([sims[b, j] for j, b in enumerate(best)]),
                    }
                )

    return run


def expansion_model(expansions: DataFrame, qtf: DataFrame, models: CandidateModels) -> DataFrame:
    """(qid, term, e, o): folded expansion and original-query shares over V_q + <UNK> (ML-3).

    ``e`` and ``o`` are each normalised to 1 per query; r = lam e + (1 - lam) o.
    A query whose expansion mass is 0 or undefined (D8) has e = NULL. All
    tables here hold at most K + |q| rows per query; the vocabulary test
    filters the big background table by their keys (``in_vocabulary``).
    """
    qids = models.cset.select("qid").distinct()
    expansions = models.attach(expansions, qids, "qid", "left_semi")  # at most one row per query
    by_q = Window.partitionBy("qid")
    ex = (
        models.in_vocabulary(expansions)
        .select(
            "qid",
            "rk",
            F.when(F.col("in_v"), F.col("term")).otherwise(F.lit(UNK)).alias("term"),  # JOIN-9
            F.try_divide(F.col("sim"), F.sum("sim").over(by_q)).alias("w"),
        )
        # by assignment, of several <UNK> rows the last (highest rk) survives (AGG-16, D6)
        .groupBy("qid", "term")
        .agg((F.sum("w") if models.params.unk == "sum" else F.max_by("w", "rk")).alias("w"))
    )
    ex_tot = F.sum("w").over(by_q)
    ex = ex.select("qid", "term", F.when(ex_tot != 0, F.col("w") / ex_tot).alias("e"))
    orig = (
        models.in_vocabulary(models.attach(qtf, qids, "qid", "left_semi"))
        .select("qid", F.when(F.col("in_v"), F.col("term")).otherwise(F.lit(UNK)).alias("term"), "qtf")
        .groupBy("qid", "term")
        .agg(F.sum("qtf").alias("c"))
    )
    orig = orig.select("qid", "term", (F.col("c") / F.sum("c").over(by_q)).alias("o"))
    return ex.join(orig, ["qid", "term"], "full")  # JOIN-10


def relevance_model(em: DataFrame, lam, strict: bool = False) -> DataFrame:
    """(qid, term, r) from expansion_model output and a lambda (literal or column) (SCL-11).

    When a query has no usable expansion mass (D8) the expansion weight is 0;
    with ``strict``, such a query has no mass at all.
    """
    lam = F.lit(float(lam)) if not isinstance(lam, Column) else lam
    has_e = F.max(F.col("e").isNotNull().cast("int")).over(_by_keys(em))
    lam_eff = F.when(has_e == 1, lam).otherwise(F.lit(0.0))
    r = lam_eff * F.coalesce("e", F.lit(0.0)) + (F.lit(1.0) - lam_eff) * F.coalesce("o", F.lit(0.0))
    return em.withColumn("r", F.when(has_e == 1, r).otherwise(F.lit(0.0)) if strict else r).drop("e", "o")


def _by_keys(df: DataFrame):
    keys = [c for c in ("setting_id", "qid") if c in df.columns]
    return Window.partitionBy(*keys)


def score_b(rm: DataFrame, models: CandidateModels, mu=None, settings=None) -> DataFrame:
    """(keys..., qid, doc_id, score): 1 - sum_{r>0} r log10(r / p(t|d)) per candidate (AGG-12, FLT-4).

    ``rm`` is (qid, term, r) or, in a sweep, (setting_id, mu, qid, term, r) with
    ``settings`` the list of (setting_id, mu). Terms whose smoothed probability
    is 0 for every document (an empty <UNK> bucket, D7) are left out.
    """
    mu = checked_mu(models.params.mu if mu is None else mu)
    copies = len(settings) if settings else 1
    base = models.lengths()
    if settings:
        keys = ["setting_id"]
        grid = F.array(*[F.struct(F.lit(i).alias("setting_id"), F.lit(checked_mu(m)).alias("mu")) for i, m in settings])
        base = base.select("*", F.explode(grid).alias("_s")).select("_s.setting_id", "_s.mu", "bucket", "qid", "doc_id", "doc_len")
    else:
        keys = []
        base = base.withColumn("mu", F.lit(mu))
        rm = rm.withColumn("mu", F.lit(mu))
    pos = rm.filter((F.col("r") > 0) & ~F.isnan("r"))  # FLT-4
    pos = materialize(pos)
    supp = materialize(
        models.lookup(pos)
        .select(*keys, "mu", "qid", "term_id", "r", "p_bg")
        .withColumn("mpb", F.col("mu") * F.col("p_bg"))
        .filter(F.col("mpb") > 0)
    )
    per_q = supp.groupBy(*keys, "qid").agg(
        F.sum(F.col("r") * F.log10(F.col("r") / F.col("mpb"))).alias("cq"),
        F.sum("r").alias("rq"),
    )
    pair = [*keys, "bucket", "qid", "doc_id"]
    hits = (
        models.attach_terms(models.exploded(), supp.select(*keys, "qid", "term_id", "r", "mpb"), ["qid", "term_id"])
        .groupBy(*pair)
        .agg(F.sum(F.col("r") * F.log10((F.col("tf") + F.col("mpb")) / F.col("mpb"))).alias("h"))
    )
    return (
        models.attach(models.attach(base, per_q, [*keys, "qid"], "left", copies), hits, pair, "left", copies)
        .select(
            *keys,
            "qid",
            "doc_id",
            (
                F.lit(1.0)
                - F.coalesce("cq", F.lit(0.0))
                + F.coalesce("h", F.lit(0.0))
                - F.coalesce("rq", F.lit(0.0)) * F.log10(F.col("doc_len") + F.col("mu"))
            ).alias("score"),
        )
    )
