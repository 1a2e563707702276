"""Word vectors of every query's own candidates (ML-1), by factorising counts.

Skip-gram training with k negative samples factorises, implicitly, the table of
pointwise mutual information less ln k of words and their contexts. Here that
table's positive part is factorised itself: for all queries in one job,

  M(t, w) = max(0, ln(n(t, w) D / (r(t) r(w))) - ln k)

with n the pairs of places at most ``window`` tokens apart in the query's
candidates, r their row sums and D their total. M is symmetric and sparse. Block
power iteration from a fixed start finds the d directions of the largest
eigenvalues: sparse times dense is a sum over M's entries, the block is made
orthonormal by the Cholesky factor of its d x d Gram matrix. A word's vector is
its row of M times that basis, so inner products are those of M squared at rank
d, whatever the basis' rotation.

Where it happens depends on a query's tokens. Their sequences go to the task of
the query, which counts, factorises and hands on vectors alone: M is neither
shuffled nor stored. Queries of more pairs than ``PAIRS_IN_TASK`` are worked on
by joins on (qid, term) and sums, in as many tasks as their pairs fill.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relmod.operators.expansion import SIM_DIGITS
from relmod.operators.lm import CandidateModels, encode_terms
from relmod.operators.ordering import top_k
from relmod.session import broadcast_if_small, materialize

WINDOW = 20
#: Tokens times window of a query that one task works on: its table takes at most 16 bytes a pair.
PAIRS_IN_TASK = 1 << 24
#: Pairs that a task counts at once.
PAIRS_AT_ONCE = 1 << 21
#: Tokens of all queries of a task, if it has several.
TOKENS_PER_TASK = 1 << 20
#: A direction whose remainder is below this share of its square is dependent on those before it.
DEPENDENT = 1e-12


def document_sequences(models: CandidateModels) -> DataFrame:
    """(doc_id, seq): every candidate document's term numbers in the order of its text."""
    places = models.doc_tokens.select("doc_id", F.posexplode("tokens").alias("pos", "term"))
    numbered = encode_terms(places, models.dictionary, models.params.broadcast_bytes)
    entries = numbered.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "term_id"))).alias("s"))
    return entries.select("doc_id", F.col("s.term_id").alias("seq"))


def context_counts(models: CandidateModels, window: int = WINDOW, cset: DataFrame | None = None) -> DataFrame:
    """(qid, t, w, n): pairs of places at most ``window`` apart, in both orders, over a query's candidates.

    A document's pairs are counted once, whatever number of queries list it.
    ``cset`` (qid, doc_id) are the candidates, if not all.
    """
    cset = models.cset if cset is None else cset
    at = document_sequences(models).select("doc_id", "seq", F.posexplode("seq").alias("i", "t"))
    ahead = at.select("doc_id", "t", F.explode(F.slice("seq", F.col("i") + 2, F.lit(window))).alias("w"))
    in_documents = ahead.groupBy("doc_id", "t", "w").agg(F.count(F.lit(1)).alias("n"))
    both = F.array(F.struct(F.col("t"), F.col("w")), F.struct(F.col("w").alias("t"), F.col("t").alias("w")))
    sides = in_documents.select("doc_id", F.explode(both).alias("p"), "n").select("doc_id", "p.t", "p.w", "n")
    pairs = models.attach(sides, cset.select("qid", "doc_id"), "doc_id")
    return pairs.groupBy("qid", "t", "w").agg(F.sum("n").alias("n"))


def positive_pmi(counts: DataFrame, negatives: int = 1) -> DataFrame:
    """(qid, t, w, m): the positive entries of M; ``negatives`` is k."""
    rows = counts.groupBy("qid", "t").agg(F.sum("n").alias("r"))
    total = rows.groupBy("qid").agg(F.sum("r").alias("d"))
    ratio = F.col("n").cast("double") * F.col("d") / (F.col("rt").cast("double") * F.col("rw") * negatives)
    return (
        counts.join(rows.withColumnRenamed("r", "rt"), ["qid", "t"])
        .join(rows.select("qid", F.col("t").alias("w"), F.col("r").alias("rw")), ["qid", "w"])
        .join(total, "qid")
        .select("qid", "t", "w", F.log(ratio).alias("m"))
        .filter("m > 0")
    )


# --- expressions that Spark SQL and other engines read alike


def start_sql(i: int, number) -> str:
    """A fixed number in [-0.5, 0.5) for a term and direction; ``number`` makes one of eight hex digits."""
    return f"{number(f'substr(md5(concat(term, {chr(39)}:{i}{chr(39)})), 1, 8)')} / 4294967296 - 0.5"


def gram_sql(d: int) -> list[tuple[str, str]]:
    return [(f"g_{i}_{j}", f"sum(y_{i} * y_{j})") for i in range(d) for j in range(i + 1)]


def cholesky_sql(d: int) -> list[tuple[str, str]]:
    """(column, expression) one after another: the lower factor of the Gram matrix; dependent directions are 0."""
    out = []
    for j in range(d):
        for i in range(j, d):
            left = " - ".join([f"g_{i}_{j}", *[f"l_{i}_{k} * l_{j}_{k}" for k in range(j)]])
            if i == j:
                out.append((f"l_{j}_{j}", f"CASE WHEN {left} > {DEPENDENT} * g_{j}_{j} THEN sqrt({left}) ELSE 0.0 END"))
            else:
                out.append((f"l_{i}_{j}", f"CASE WHEN l_{j}_{j} > 0 THEN ({left}) / l_{j}_{j} ELSE 0.0 END"))
    return out


def orthonormal_sql(d: int) -> list[tuple[str, str]]:
    """(column, expression) one after another: a row of the block times the inverse of the factor."""
    out = []
    for i in range(d):
        left = " - ".join([f"y_{i}", *[f"l_{i}_{k} * x_{k}" for k in range(i)]])
        out.append((f"x_{i}", f"CASE WHEN l_{i}_{i} > 0 THEN ({left}) / l_{i}_{i} ELSE 0.0 END"))
    return out


def _with(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    for name, expression in columns:
        df = df.withColumn(name, F.expr(expression))
    return df


def _starts(d: int) -> list[tuple[str, str]]:
    return [(f"x_{i}", start_sql(i, lambda digits: f"cast(conv({digits}, 16, 10) AS DOUBLE)")) for i in range(d)]


def factorise(m: DataFrame, terms: DataFrame, d: int, rounds: int, attach, partitions: int) -> DataFrame:
    """(qid, term_id, vec array<double>) of (qid, t, w, m), all queries at once.

    ``terms`` is (qid, term_id, term) of all rows of M. Queries whose table has
    a rank below ``d`` get zeros in the directions that it lacks.
    """
    m = m.repartition(partitions, "qid", "w").persist(StorageLevel.MEMORY_AND_DISK)

    def times(x: DataFrame) -> DataFrame:
        hit = m.join(x.withColumnRenamed("term_id", "w"), ["qid", "w"])
        sums = hit.groupBy("qid", F.col("t").alias("term_id")).agg(*[F.sum(F.col("m") * F.col(f"x_{i}")).alias(f"y_{i}") for i in range(d)])
        return materialize(sums)  # read twice: by the Gram matrix and by the next step

    names = [f"x_{i}" for i in range(d)]
    x = _with(terms, _starts(d)).select("qid", "term_id", *names)
    for _ in range(rounds):
        y = times(x)
        gram = y.groupBy("qid").agg(*[F.expr(e).alias(c) for c, e in gram_sql(d)])
        factor = _with(gram, cholesky_sql(d)).select("qid", *[c for c, _ in cholesky_sql(d)])
        x = _with(attach(y, factor, "qid"), orthonormal_sql(d)).select("qid", "term_id", *names)
    out = times(x).select("qid", "term_id", F.array(*[f"y_{i}" for i in range(d)]).alias("vec"))
    m.unpersist()
    return out


def _counted(seq: np.ndarray, doc: np.ndarray, window: int, words: int):
    """Blocks (u, v, n) of the pairs u <= v at most ``window`` places apart in a document, each pair in one block."""

    def ahead(k: int) -> tuple[np.ndarray, np.ndarray]:
        same = doc[k:] == doc[:-k]
        a, b = seq[:-k][same], seq[k:][same]
        return np.minimum(a, b), np.maximum(a, b)

    steps = range(1, min(window, len(seq) - 1) + 1)
    held = np.zeros(words + 1, np.int64)
    for k in steps:
        held[1:] += np.bincount(ahead(k)[0], minlength=words)
    block = np.cumsum(held) // PAIRS_AT_ONCE  # of every word, by the pairs of those before it
    cuts = np.flatnonzero(np.diff(block[:-1], prepend=-1))
    for first, end in zip(cuts, [*cuts[1:], words]):
        keys = []
        for k in steps:
            low, high = ahead(k)
            if len(cuts) > 1:
                some = (low >= first) & (low < end)
                low, high = low[some], high[some]
            keys.append(low * words + high)
        if sum(map(len, keys)):
            keys, n = np.unique(np.concatenate(keys), return_counts=True)
            yield (keys // words).astype(np.int32), (keys % words).astype(np.int32), n


def _orthonormal(y: np.ndarray) -> np.ndarray:
    """``y`` times the inverse of the Cholesky factor of its Gram matrix, by the steps of ``cholesky_sql`` and ``orthonormal_sql``."""
    d = y.shape[1]
    factor, x = np.zeros((d, d)), np.zeros_like(y)
    for j in range(d):
        for i in range(j, d):
            g = left = float(y[:, i] @ y[:, j])
            for k in range(j):
                left -= factor[i, k] * factor[j, k]
            if i == j:
                factor[j, j] = math.sqrt(left) if left > DEPENDENT * g else 0.0
            elif factor[j, j] > 0:
                factor[i, j] = left / factor[j, j]
    for i in range(d):
        if factor[i, i] > 0:
            left = y[:, i].copy()
            for k in range(i):
                left -= factor[i, k] * x[:, k]
            x[:, i] = left / factor[i, i]
    return x


def _vectors_of(seq: np.ndarray, doc: np.ndarray, x: np.ndarray, window: int, rounds: int, negatives: int) -> tuple[np.ndarray, np.ndarray]:
    """The words with a positive entry in M and their vectors; ``seq`` numbers the words of the start ``x``, ``doc`` the documents."""
    words, d = x.shape
    counts = list(_counted(seq, doc, window, words))
    r = np.zeros(words)
    for u, v, n in counts:
        r += np.bincount(u, n, words) + np.bincount(v, n, words)
    total = r.sum()
    m, has = [], np.zeros(words, bool)
    while counts:
        u, v, n = counts.pop()
        n = n * np.where(u == v, 2.0, 1.0)
        value = np.log(n * total / (r[u] * r[v] * negatives))
        some = value > 0
        u, v, value = u[some], v[some], value[some]
        m.append((u, v, np.where(u == v, value / 2, value)))  # a pair is added to the rows of both
        has[u] = has[v] = True

    def times(x: np.ndarray) -> np.ndarray:
        y = np.zeros_like(x)
        for u, v, value in m:
            for i in range(d):
                y[:, i] += np.bincount(u, value * x[v, i], words) + np.bincount(v, value * x[u, i], words)
        return y

    x = np.asfortranarray(x)
    for _ in range(rounds):
        x = _orthonormal(times(x))
    return np.flatnonzero(has), times(x)[has]


def _in_tasks(models: CandidateModels, cset: DataFrame, tokens: int, d: int, window: int, rounds: int, negatives: int) -> DataFrame:
    """(qid, term, vec): a query's vectors made in the task that its documents' sequences of ``tokens`` tokens in all go to."""
    slots = cset.sparkSession.sparkContext.defaultParallelism
    tasks = slots * max(1, math.ceil(tokens / TOKENS_PER_TASK / slots))
    listed = models.attach(document_sequences(models), cset.select("qid", "doc_id"), "doc_id")
    # kept until the models are freed: read twice, and shuffled but once
    docs = models.keep(listed.select("qid", "seq").repartition(tasks, "qid"))
    held = docs.select(F.col("qid").alias("_qid"), F.explode_outer(F.array_distinct("seq")).alias("term_id")).distinct()
    starts = _with(models.dictionary.select("term_id", "term"), _starts(d))
    words = held.join(broadcast_if_small(starts, models.params.broadcast_bytes), "term_id")
    names = [f"x_{i}" for i in range(d)]
    qtype = cset.schema["qid"].dataType.simpleString()

    def made(docs: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("term_id")
        seq = np.searchsorted(words["term_id"].to_numpy(), pc.list_flatten(docs["seq"]).to_numpy())
        doc = np.repeat(np.arange(len(docs), dtype=np.int32), pc.list_value_length(docs["seq"]).to_numpy())
        x = np.column_stack([words[c].to_numpy() for c in names])
        at, vec = _vectors_of(seq, doc, x, window, rounds, negatives)
        lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * d, vec.ravel())
        return words.select(["_qid", "term"]).rename_columns(["qid", "term"]).take(at).append_column("vec", lists)

    words = words.select("_qid", "term_id", "term", *names).groupBy("_qid")
    return docs.groupBy("qid").cogroup(words).applyInArrow(made, f"qid {qtype}, term string, vec array<double>")


def _by_joins(models: CandidateModels, cset: DataFrame, d: int, window: int, rounds: int, negatives: int) -> DataFrame:
    """(qid, term, vec): vectors of queries of any number of tokens."""
    m = materialize(positive_pmi(materialize(context_counts(models, window, cset)), negatives))
    terms = models.with_terms(m.select("qid", F.col("t").alias("term_id")).distinct().withColumn("_id", F.col("term_id")))
    terms = materialize(terms.select("qid", F.col("_id").alias("term_id"), "term"))
    vectors = factorise(m, terms, d, rounds, models.attach, models.partitions)
    return vectors.join(terms, ["qid", "term_id"]).select("qid", "term", "vec")


def local_vectors(
    models: CandidateModels, d: int = 16, window: int = WINDOW, rounds: int = 5, negatives: int = 1
) -> DataFrame:
    """(qid, term, vec array<double>): vectors of every query's candidate words (ML-1).

    A word without any other word within the window has none. ``rounds`` and the
    start are fixed, so the same input gives the same vectors.
    """
    most = PAIRS_IN_TASK // max(window, 1)
    in_task = F.col("n") <= most
    small, large = models.n.agg(F.sum(F.when(in_task, F.col("n"))), F.count(F.when(~in_task, 1))).first()
    cset = models.attach(models.cset.select("qid", "doc_id"), models.n, "qid")  # a null query has no vectors
    settings = (d, window, rounds, negatives)
    out = _in_tasks(models, cset.filter(in_task), small or 0, *settings)
    return out.unionByName(_by_joins(models, cset.filter(~in_task), *settings)) if large else out


def local_vector_expansions(vectors: DataFrame, qtf: DataFrame, k: int) -> DataFrame:
    """(qid, rk, term, sim): the k words of the highest inner product with the sum of a query's word vectors (ML-2)."""
    d = F.size("vec")
    hit = vectors.join(qtf, ["qid", "term"]).select("qid", "qtf", F.posexplode("vec").alias("i", "v"))  # the query's words
    sums = hit.groupBy("qid", "i").agg(F.sum(F.col("qtf") * F.col("v")).alias("s"))
    centre = sums.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("c"))
    products = F.transform(F.sequence(F.lit(1), d), lambda i: F.element_at("vec", i) * F.element_at("c", i))
    sim = F.round(F.aggregate(products, F.lit(0.0), lambda a, b: a + b), SIM_DIGITS).alias("sim")
    best = top_k(vectors.join(centre, "qid").select("qid", "term", sim), "qid", [F.desc("sim"), F.asc("term")], k, "rk")
    return best.select("qid", F.col("rk").cast("int").alias("rk"), "term", "sim")
