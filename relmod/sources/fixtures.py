"""Inputs derived from the parquet test tables (same derivation as the DuckDB oracle).

* queries     = ``benchmark``: item_id as qid, text
* collection  = ``documents``: doc_id, url from source and lang, title = the
                text up to its first full stop or line end, body = text
* candidates  = per query the ``depth`` documents with most distinct shared
                terms (at least one), ties by doc_id; score = that count; pos = rank
* qrels       = 2 if a token 5-gram of the query occurs in the document; else 1 if
                at least 30 % of the query's distinct terms occur; else no row
* vectors     = terms ordered by collection frequency desc, term asc; the i-th term
                takes ``embeddings.vec_id = i-1``, as array<double>
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relmod.functions.text import tokens
from relmod.operators.ordering import dense_index, top_k
from relmod.params import Params
from relmod.session import broadcast_if_small, materialize, spread_by

GRAM = 5
# A document's title: its text up to the first full stop or line end.
FIRST_WORDS = r"^[^.\n]*"
SHARE_NUM, SHARE_DEN = 3, 10  # 30 %


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("https://"), F.coalesce("source", F.lit("")), F.lit(".example.org/"), F.coalesce("lang", F.lit(""))).alias("url"),
        F.regexp_extract(F.coalesce("text", F.lit("")), FIRST_WORDS, 0).alias("title"),
        F.col("text").alias("body"),
    )


def query_tokens(spark: SparkSession, sf_dir: str, params: Params = Params()) -> DataFrame:
    return queries(spark, sf_dir).select("qid", tokens("text", params.text).alias("tokens"))


def doc_tokens(spark: SparkSession, sf_dir: str, params: Params = Params()) -> DataFrame:
    """(doc_id, tokens), partitioned by doc_id."""
    docs = spread_by(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", tokens("text", params.text).alias("tokens"))


def query_terms(spark: SparkSession, sf_dir: str, params: Params = Params()) -> DataFrame:
    """(qid, term, n_qterms): the distinct terms of every query and their number."""
    qt = query_tokens(spark, sf_dir, params).select("qid", F.explode(F.array_distinct("tokens")).alias("term"))
    n = Window.partitionBy("qid")
    return materialize(qt.withColumn("n_qterms", F.count(F.lit(1)).over(n)))


def candidate_lists(toks: DataFrame, qt: DataFrame, depth: int, params: Params = Params()) -> DataFrame:
    """(qid, doc_id, score double, pos int): per query the ``depth`` documents of most shared terms.

    The query terms are broadcast after a size check, so postings stream
    through without a shuffle on ``term`` (hot terms cannot pile up in one
    task). ``toks`` is partitioned by doc_id, so that pairs are counted where
    they are, and only the best ``depth`` per query and task are shuffled.
    """
    # outer: an inner explode makes Spark test the size of the tokens first, and so compute them twice
    dt = toks.select("doc_id", F.explode_outer(F.array_distinct("tokens")).alias("term"))
    pairs = dt.join(broadcast_if_small(qt.filter("qid IS NOT NULL"), params.broadcast_bytes), "term")
    shared = pairs.groupBy("qid", "doc_id").agg(F.count(F.lit(1)).alias("n_shared"))
    ranked = top_k(shared, "qid", [F.desc("n_shared"), F.asc("doc_id")], depth, rank_col="pos")
    return ranked.select("qid", "doc_id", F.col("n_shared").cast("double").alias("score"), F.col("pos").cast("int"))


def candidates(spark: SparkSession, sf_dir: str, depth: int = 100, params: Params = Params()) -> DataFrame:
    """(qid, doc_id, score double, pos int): the candidate lists, best first."""
    return candidate_lists(doc_tokens(spark, sf_dir, params), query_terms(spark, sf_dir, params), depth, params)


def _gram(tokens_col: str, i):
    """The token n-gram at 1-based place ``i``, joined by a space."""
    return F.array_join(F.slice(tokens_col, i, GRAM), " ")


#: Anchors are runs of three tokens at every third place: each n-gram of five tokens holds one of them whole.
ANCHOR = 3
ANCHOR_STEP = GRAM - ANCHOR + 1


def _anchor(tokens_col: str, i):
    """The tokens from 1-based place ``i`` joined by a space, which no token holds."""
    return F.array_join(F.slice(tokens_col, i, ANCHOR), " ")


def _anchors(tokens_col: str):
    """The anchors at places 1, 4, 7, ... of a token array; none if it holds no n-gram."""
    places = F.sequence(F.lit(1), F.size(tokens_col) - (ANCHOR - 1), F.lit(ANCHOR_STEP))
    return F.when(F.size(tokens_col) >= GRAM, F.transform(places, lambda i: _anchor(tokens_col, i))).otherwise(F.array().cast("array<string>"))


def judgements(toks: DataFrame, q_tokens: DataFrame, qt: DataFrame, params: Params = Params()) -> DataFrame:
    """(qid, doc_id, relevance int) graded 2 / 1 as described in the module doc.

    One pass over the documents. Their terms meet those of the queries; their
    anchors meet those that the queries' n-grams hold, and only where they do is the n-gram around them compared.
    ``toks`` is partitioned by doc_id, so that both are counted per pair where
    they are.
    """
    starts = F.sequence(F.lit(1), F.size("tokens") - (GRAM - 1))
    grams = q_tokens.filter(F.size("tokens") >= GRAM).select("qid", "tokens", F.explode(starts).alias("at"))
    grams = grams.select("qid", "tokens", "at", F.explode(F.sequence(F.lit(0), F.lit(ANCHOR_STEP - 1))).alias("before"))
    grams = grams.select("qid", _anchor("tokens", F.col("at") + F.col("before")).alias("key"), _gram("tokens", F.col("at")).alias("gram"), "before")
    terms = qt.filter("qid IS NOT NULL").select("qid", F.col("term").alias("key"), "n_qterms")
    asked = materialize(grams.distinct().unionByName(terms, allowMissingColumns=True))
    # outer: an inner explode makes Spark test the size of the tokens first, and so compute them twice
    held = toks.select("doc_id", "tokens", F.posexplode_outer(F.concat(_anchors("tokens"), F.array_distinct("tokens"))).alias("no", "key"))
    start = F.col("no") * ANCHOR_STEP + 1 - F.col("before")
    same = F.when(F.col("gram").isNull(), True).when(start >= 1, F.col("gram") == _gram("tokens", F.greatest(start, F.lit(1)))).otherwise(False)
    pairs = held.join(broadcast_if_small(asked, params.broadcast_bytes), "key").filter(same)
    pairs = pairs.groupBy("qid", "doc_id").agg(
        F.count(F.when(F.col("gram").isNull(), 1)).alias("n_shared"), F.max("n_qterms").alias("n_qterms"), F.count("gram").alias("n_grams")
    )
    enough = F.col("n_shared") * SHARE_DEN >= F.col("n_qterms") * SHARE_NUM
    # documents without an id are no one document: one grade does not replace the other
    grades = F.array(F.when(F.col("n_grams") > 0, 2), F.when(enough & ((F.col("n_grams") == 0) | F.col("doc_id").isNull()), 1))
    return pairs.select("qid", "doc_id", F.explode(F.filter(grades, lambda g: g.isNotNull())).alias("relevance"))


def qrels(spark: SparkSession, sf_dir: str, params: Params = Params()) -> DataFrame:
    """(qid, doc_id, relevance int) graded 2 / 1 as described in the module doc."""
    q_tokens = query_tokens(spark, sf_dir, params)
    return judgements(doc_tokens(spark, sf_dir, params), q_tokens, query_terms(spark, sf_dir, params), params)


def term_vectors(toks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(term, vec array<double>): embedding rows assigned to the most frequent terms."""
    terms = toks.select(F.explode_outer("tokens").alias("term")).filter(F.col("term").isNotNull())
    ranked = dense_index(terms.groupBy("term").agg(F.count(F.lit(1)).alias("cf")), [F.desc("cf"), F.asc("term")], "vec_id")
    emb = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    return ranked.join(emb, "vec_id").select("term", "vec")


def vectors(spark: SparkSession, sf_dir: str, params: Params = Params()) -> DataFrame:
    """(term, vec array<double>): embedding rows assigned to the most frequent terms."""
    return term_vectors(doc_tokens(spark, sf_dir, params), table(spark, sf_dir, "embeddings"))


class Fixtures:
    """The derived inputs of one test-table folder, sharing their common parts.

    Document tokens are computed once, kept, and feed the candidate lists, the
    judgements and the vector assignment, which are checkpointed (lineage cut).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = Params()):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params
        self._cache: dict = {}

    def _get(self, key, build):
        if key not in self._cache:
            self._cache[key] = materialize(build())
        return self._cache[key]

    def queries(self) -> DataFrame:
        return queries(self.spark, self.sf_dir)

    def collection(self) -> DataFrame:
        return collection(self.spark, self.sf_dir)

    def doc_tokens(self) -> DataFrame:
        # the whole collection's tokens: kept in the block store (memory, then
        # executor disk) rather than written out as a second copy of the corpus
        if "doc_tokens" not in self._cache:
            self._cache["doc_tokens"] = doc_tokens(self.spark, self.sf_dir, self.params).persist(StorageLevel.MEMORY_AND_DISK)
        return self._cache["doc_tokens"]

    def query_terms(self) -> DataFrame:
        if "query_terms" not in self._cache:
            self._cache["query_terms"] = query_terms(self.spark, self.sf_dir, self.params)
        return self._cache["query_terms"]

    def candidates(self, depth: int = 100) -> DataFrame:
        return self._get(("candidates", depth), lambda: candidate_lists(self.doc_tokens(), self.query_terms(), depth, self.params))

    def qrels(self) -> DataFrame:
        q_tokens = query_tokens(self.spark, self.sf_dir, self.params)
        return self._get("qrels", lambda: judgements(self.doc_tokens(), q_tokens, self.query_terms(), self.params))

    def vectors(self) -> DataFrame:
        return self._get("vectors", lambda: term_vectors(self.doc_tokens(), table(self.spark, self.sf_dir, "embeddings")))
