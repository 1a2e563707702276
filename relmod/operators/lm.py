"""Unigram language models on a term dictionary.

Terms get numbers by falling frequency. A document model is one row: the
document's term numbers in order and their counts, as parallel arrays, and its
length. The background model of a query's candidate set is (qid, term, cf, n,
p_bg) including the <UNK> row whose count is floor(pct/100 * N) and which does
not raise N. Dirichlet smoothing: p(t|d) = (tf + mu * p_bg) / (|d| + mu).
"""

from __future__ import annotations

import math
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.functions.stems import stemmed_tokens
from relmod.functions.text import fields_text, tokens
from relmod.operators.ordering import dense_index
from relmod.params import UNK, Params, checked_mu
from relmod.session import broadcast_if_small, bytes_of, materialize, spread

#: The number of the out-of-vocabulary bucket, which no document holds.
UNK_ID = -1


def candidate_set(candidates: DataFrame) -> DataFrame:
    """Distinct (qid, doc_id): a query's candidate *set* (AGG-3)."""
    return candidates.select("qid", "doc_id").distinct()


#: Bits of one bitmap, which takes 4 KB; and bits per candidate id.
BITMAP_BITS = 32768
BITS_PER_ID = 32


def bitmap_filter(rows: DataFrame, ids: DataFrame, n_ids: int, max_bytes: int) -> DataFrame:
    """``rows`` whose doc_id may be one of ``ids``, filtered where they are.

    Ids are hashed to places, and the places taken are kept as bitmaps, one row
    per ``BITMAP_BITS`` places; these are broadcast and take at most
    ``max_bytes``. No id is missed; of the others about one in ``BITS_PER_ID``
    passes, more where the bound allows fewer bits. A null doc_id is no candidate's.
    """
    bitmaps = max(1, min(-(-n_ids * BITS_PER_ID // BITMAP_BITS), max_bytes // (BITMAP_BITS // 8)))
    place = F.pmod(F.xxhash64(F.lit("bitmap"), F.col("doc_id")), F.lit(bitmaps * BITMAP_BITS)) + 1
    taken = ids.select(F.bitmap_bucket_number(place).alias("_map"), F.bitmap_bit_position(place).alias("_bit"))
    maps = taken.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    near = rows.filter(F.col("doc_id").isNotNull()).withColumn("_map", F.bitmap_bucket_number(place)).withColumn("_bit", F.bitmap_bit_position(place))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.get(F.array(*[byte.bitwiseAND(1 << b) for b in range(8)]), F.col("_bit").bitwiseAND(7).cast("int")) != 0
    return near.join(F.broadcast(maps), "_map").filter(hit).drop("_map", "_bit", "_bits")


def candidate_documents(candidates: DataFrame, collection: DataFrame, params: Params = Params()) -> DataFrame:
    """Collection rows whose doc_id is a candidate of any query (JOIN-1, left semi).

    Few ids are broadcast. Of more, bitmaps filter the collection in place; what
    passes wrongly is found by ids alone, without the texts, and taken out.
    """
    ids = materialize(candidates.select("doc_id").distinct())
    if bytes_of(ids) <= params.broadcast_bytes:
        return collection.join(F.broadcast(ids), "doc_id", "left_semi")
    if params.broadcast_bytes < BITMAP_BITS // 8:
        return collection.join(ids, "doc_id", "left_semi")
    near = bitmap_filter(collection, ids, ids.count(), params.broadcast_bytes)
    wrong = materialize(near.select("doc_id").distinct().join(ids, "doc_id", "left_anti"))
    if bytes_of(wrong) <= params.broadcast_bytes:
        return near.join(F.broadcast(wrong), "doc_id", "left_anti")
    return near.join(ids, "doc_id", "left_semi")


def document_tokens(docs: DataFrame, fields, params: Params = Params()) -> DataFrame:
    """(doc_id, tokens) of the given text fields joined by a space (PRJ-1, SCL-7).

    With the stemming switch on, words take their stems from the given table (SCL-4).
    """
    if params.text.stemming:
        return stemmed_tokens(docs.select("doc_id", fields_text(*fields).alias("_text")), "doc_id", "_text", params.text.stems, params.text)
    return docs.select("doc_id", tokens(fields_text(*fields), params.text).alias("tokens"))


def doc_lengths(doc_tok: DataFrame) -> DataFrame:
    """(doc_id, doc_len); empty documents keep length 0 (AGG-2)."""
    return doc_tok.select("doc_id", F.size("tokens").cast("long").alias("doc_len"))


def doc_term_freq(doc_tok: DataFrame) -> DataFrame:
    """(doc_id, term, tf) (AGG-1)."""
    return (
        doc_tok.select("doc_id", F.explode("tokens").alias("term"))
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def query_term_freq(queries: DataFrame, params: Params = Params()) -> DataFrame:
    """(qid, term, qtf): query token histogram (AGG-13)."""
    if params.text.stemming:
        toks = stemmed_tokens(queries, "qid", "text", params.text.stems, params.text)
    else:
        toks = queries.select("qid", tokens("text", params.text).alias("tokens"))
    return (
        toks.select("qid", F.explode("tokens").alias("term"))
        .groupBy("qid", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def term_dictionary(tf: DataFrame) -> DataFrame:
    """(term, term_id, cf) of (doc_id, term, tf): numbers from 0 by falling frequency, ties by term."""
    counts = tf.groupBy("term").agg(F.sum("tf").alias("cf"))
    return dense_index(counts, [F.desc("cf"), F.asc("term")], "term_id").select("term", "term_id", "cf")


def encode_terms(tf: DataFrame, dictionary: DataFrame, broadcast_bytes: int) -> DataFrame:
    """``tf`` with ``term_id`` in place of ``term``.

    The dictionary's frequent head, as much of it as the bound allows, is
    broadcast; only rows of the tail's terms are shuffled by term, and none of
    these is more frequent than the head's last one, so no task gathers a hot term.
    """
    n, size = dictionary.count(), bytes_of(dictionary)
    head = dictionary.select("term", "term_id")
    if size <= broadcast_bytes:
        return tf.join(F.broadcast(head), "term").drop("term")
    known = int(n * broadcast_bytes / size)
    front = tf.join(broadcast_if_small(head.filter(F.col("term_id") < known), broadcast_bytes), "term", "left")
    tail = front.filter(F.col("term_id").isNull()).drop("term_id").join(head.filter(F.col("term_id") >= known), "term")
    return front.filter(F.col("term_id").isNotNull()).drop("term").unionByName(tail.drop("term"))


def document_vectors(doc_tok: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(dictionary, vectors): vectors are (doc_id, doc_len, ids, tfs), one row per document with a token (AGG-1).

    ``ids`` are in order, so frequent terms come first; ``tfs`` runs parallel to
    them. Tokens partitioned by doc_id are counted where they are.
    """
    tf = doc_term_freq(doc_tok).persist(StorageLevel.MEMORY_AND_DISK)
    dictionary = materialize(term_dictionary(tf))
    # half the bytes where the numbers allow it
    number = "int" if dictionary.count() < 1 << 31 else "long"
    dictionary = dictionary.withColumn("term_id", F.col("term_id").cast(number))
    entry = F.struct("term_id", F.col("tf").cast("int").alias("tf"))
    packed = (
        encode_terms(tf, dictionary, params.broadcast_bytes)
        .groupBy("doc_id")
        .agg(F.sum("tf").alias("doc_len"), F.sort_array(F.collect_list(entry)).alias("v"))
    )
    vectors = materialize(packed.select("doc_id", "doc_len", F.col("v.term_id").alias("ids"), F.col("v.tf").alias("tfs")))
    tf.unpersist()
    return dictionary, vectors


def dirichlet(tf: Column, doc_len: Column, p_bg: Column, mu) -> Column:
    """Dirichlet-smoothed probability (SCL-9)."""
    mu = F.lit(float(mu)) if not isinstance(mu, Column) else mu
    return (tf + mu * p_bg) / (doc_len + mu)


def _share(cf: str, n: str) -> Column:
    return F.try_divide(F.col(cf).cast("double"), F.col(n).cast("double"))


class CandidateModels:
    """Document and background models of every query's candidate set.

    Built once and shared by all scorers: documents are tokenised and numbered
    once each, however many queries list them.

    Physical design. ``pairs`` has one row per (qid, doc_id) with the document's
    arrays. A query's candidates are cut into chunks, and chunks are dealt evenly
    into buckets, so that a query of any size is worked on by as many tasks as
    its pairs fill. Every table of candidates or of their terms is partitioned by
    bucket. Most queries are one chunk, whose sums are final where they are made;
    only sums of queries of several chunks meet in a shuffle by (qid, term_id)
    and go back to the buckets that hold the term (``totals``). Where the
    session has ``spark.sql.requireAllClusterKeysForCoPartition=false``
    (``local_session`` sets it) joins within buckets add no exchange; elsewhere
    Spark adds them. Per-candidate tables of fixed width are broadcast when the
    number of pairs bounds their bytes (``attach``); all else is Spark's choice.
    Partitions grow with the pairs.
    """

    # candidate pairs per bucket (each pair brings its document's distinct
    # terms, a few hundred), and per chunk: what a query of several has in a bucket
    PAIRS_PER_PARTITION = 2000
    PAIRS_PER_CHUNK = 250
    # chunks up to so many are numbered by one task
    FEW_CHUNKS = 200_000

    def __init__(self, candidates: DataFrame, collection: DataFrame, fields, params: Params = Params()):
        spark = candidates.sparkSession
        self.params = params
        self.kept = []
        cset = materialize(candidate_set(candidates))
        sizes = cset.groupBy("qid").agg(F.ceil(F.count(F.lit(1)) / self.PAIRS_PER_CHUNK).alias("chunks"), F.count(F.lit(1)).alias("docs"))
        pairs, chunks, most = sizes.agg(F.sum("docs"), F.sum("chunks"), F.max("chunks")).first()
        self.n_pairs, self.has_large = pairs or 0, (most or 0) > 1
        self.partitions = self._partition_count(spark, self.n_pairs)
        self.cset = materialize(self._in_buckets(cset, sizes, chunks or 0))
        self.collection = collection
        pairs = broadcast_if_small(self.cset, params.broadcast_bytes)
        # token arrays of the candidate documents: read for lengths, term counts
        # and local contexts, so they are tokenised once and kept
        toks = document_tokens(spread(candidate_documents(cset, collection, params)), fields, params)
        self.doc_tokens = toks.repartition(self.partitions, "doc_id").persist(StorageLevel.MEMORY_AND_DISK)
        self.dictionary, vectors = document_vectors(self.doc_tokens, params)
        # inner joins: candidates whose document is missing are dropped (JOIN-3)
        self.cand_len = materialize(doc_lengths(self.doc_tokens).join(pairs, "doc_id").repartition(self.partitions, "bucket"))
        # kept in the block store until ``unpersist``; lost blocks are recomputed
        # from the checkpointed inputs above
        self.pairs = vectors.join(pairs, "doc_id").repartition(self.partitions, "bucket").persist(StorageLevel.MEMORY_AND_DISK)
        n = self.cand_len.groupBy("qid").agg(F.sum("doc_len").alias("n"))  # AGG-6
        self.n = n = materialize(n)
        cf = self.totals(self.exploded().groupBy("bucket", "qid", "large", "term_id").agg(F.sum("tf").alias("cf")), "cf")  # AGG-5
        #: (bucket, qid, large, term_id, cf, n, p_bg): the background model's terms in every bucket that holds them.
        self.bucket_bg = (
            self.attach(cf, n, "qid")
            .select("bucket", "qid", "large", "term_id", "cf", "n", _share("cf", "n").alias("p_bg"))
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        self.unk = self._unk(n)

    def _unk(self, n: DataFrame) -> DataFrame:
        """(qid, term_id, cf, n, p_bg) of the <UNK> bucket (AGG-7)."""
        share = F.floor(F.lit(self.params.unk_pct / 100.0) * F.col("n")).cast("long").alias("cf")
        number = self.dictionary.schema["term_id"].dataType
        return n.select("qid", F.lit(UNK_ID).cast(number).alias("term_id"), share, "n").withColumn("p_bg", _share("cf", "n"))

    @classmethod
    def _partition_count(cls, spark, n_pairs: int) -> int:
        """pairs / PAIRS_PER_PARTITION, rounded up to a multiple of the task slots."""
        slots = spark.sparkContext.defaultParallelism
        return slots * max(1, math.ceil(n_pairs / cls.PAIRS_PER_PARTITION / slots))

    def _in_buckets(self, cset: DataFrame, sizes: DataFrame, chunks: int) -> DataFrame:
        """(qid, doc_id, large, bucket): chunks of queries dealt to the buckets, the large ones first.

        Buckets are named so that hash partitioning gives each its own partition.
        """
        if self.has_large:
            sizes = sizes.select("qid", "chunks", (F.col("chunks") > 1).alias("large"))
            chunk = F.pmod(F.xxhash64("doc_id"), "chunks").alias("chunk")
            cut = materialize(self.attach(cset, sizes, "qid").select("qid", "doc_id", chunk, "large"))
        else:
            cut = cset.select("qid", "doc_id", F.lit(0).cast("long").alias("chunk"), F.lit(False).alias("large"))
        units = cut.groupBy("qid", "chunk").agg(F.count(F.lit(1)).alias("docs"))
        order = [F.desc("docs"), F.asc("qid"), F.asc("chunk")]
        if chunks <= self.FEW_CHUNKS:
            dealt = units.withColumn("at", F.row_number().over(Window.orderBy(*order)))
        else:
            dealt = dense_index(units, order, "at")
        n = self.partitions
        names = (
            cset.sparkSession.range(64 * n + 64)
            .groupBy(F.pmod(F.hash("id"), F.lit(n)).cast("long").alias("partition"))
            .agg(F.min("id").alias("bucket"))
        )
        named = dealt.withColumn("partition", (F.col("at") % n).cast("long")).join(F.broadcast(names), "partition", "left")  # a row per partition
        bucket = F.coalesce("bucket", "partition").alias("bucket")
        return self.attach(cut, named.select("qid", "chunk", bucket), ["qid", "chunk"]).select("qid", "doc_id", "large", "bucket")

    def exploded(self, pairs: DataFrame | None = None) -> DataFrame:
        """``pairs`` with term_id and tf in place of the arrays, a row per term of a document."""
        pairs = self.pairs if pairs is None else pairs
        keep = [c for c in pairs.columns if c not in ("ids", "tfs")]
        both = F.arrays_zip(F.col("ids").alias("term_id"), F.col("tfs").alias("tf"))
        return pairs.select(*keep, F.inline(both).alias("term_id", "tf"))

    def totals(self, sums: DataFrame, value: str) -> DataFrame:
        """Sums per (bucket, qid, large, term_id), of one bucket each, made sums over all of the query's buckets."""
        if not self.has_large:
            return sums
        parts = sums.filter("large").repartition(self.partitions, "qid", "term_id")
        whole = parts.groupBy("qid", "term_id").agg(F.sum(value).alias("_all"))
        back = parts.join(whole, ["qid", "term_id"]).withColumn(value, F.col("_all")).select(*sums.columns)
        return sums.filter("NOT large").unionByName(back.repartition(self.partitions, "bucket"))

    def by_query(self, in_buckets: DataFrame) -> DataFrame:
        """One row per (qid, term_id) of a table of totals."""
        if not self.has_large:
            return in_buckets.drop("bucket", "large")
        rest = in_buckets.filter("large").drop("bucket", "large").dropDuplicates(["qid", "term_id"])
        return in_buckets.filter("NOT large").drop("bucket", "large").unionByName(rest)

    def with_terms(self, df: DataFrame) -> DataFrame:
        """``df`` with ``term`` in place of ``term_id``."""
        words = broadcast_if_small(self.dictionary.select("term_id", "term"), self.params.broadcast_bytes)
        named = df.join(words, "term_id", "left").withColumn("term", F.coalesce("term", F.lit(UNK)))
        return named.select(*["term" if c == "term_id" else c for c in df.columns])

    @property
    def bg(self) -> DataFrame:
        """(qid, term, cf, n, p_bg) over V_q plus <UNK> (AGG-5, 6, 7, SET-3, SCL-8)."""
        return self.with_terms(self.by_query(self.bucket_bg).unionByName(self.unk))

    def lookup(self, small: DataFrame) -> DataFrame:
        """Rows of ``small`` (qid, term, ...) whose term is in V_q or is <UNK>, with term_id, cf, n and p_bg (JOIN-5).

        ``small`` is measured once; within the bound it is broadcast to the
        dictionary, and the rows found there, which are no more, to the model.
        """
        small = materialize(small)
        hint = F.broadcast if bytes_of(small) <= self.params.broadcast_bytes else (lambda df: df)
        unk = small.filter(F.col("term") == UNK).withColumn("term_id", F.lit(UNK_ID).cast(self.dictionary.schema["term_id"].dataType))
        ids = self.dictionary.select("term", "term_id").join(hint(small), "term").unionByName(unk)
        held = self.bucket_bg.drop("bucket").join(hint(ids), ["qid", "term_id"])
        if self.has_large:  # a large query's term is in several buckets
            held = held.distinct()
        return held.drop("large").unionByName(self.unk.join(hint(ids.filter(F.col("term") == UNK)), ["qid", "term_id"]))

    def attach(self, big: DataFrame, small: DataFrame, keys, how: str = "inner", copies: int = 1) -> DataFrame:
        """Join a table of at most one row per candidate pair (times ``copies``).

        With columns of fixed width the pair count bounds its bytes, and within
        the bound it is broadcast; otherwise Spark chooses.
        """
        fixed = all(isinstance(f.dataType, (T.NumericType, T.BooleanType)) for f in small.schema.fields)
        most = self.n_pairs * copies * (16 + 8 * len(small.columns))
        return big.join(F.broadcast(small) if fixed and most <= self.params.broadcast_bytes else small, keys, how)

    def attach_terms(self, big: DataFrame, small: DataFrame, keys, how: str = "inner") -> DataFrame:
        """Join a stored table of query terms, broadcast if its measured bytes allow it."""
        return big.join(broadcast_if_small(small, self.params.broadcast_bytes), keys, how)

    def in_vocabulary(self, small: DataFrame, keys=("qid", "term")) -> DataFrame:
        """``small`` with a boolean ``in_v``: is (qid, term) in V_q (incl. <UNK>)? (JOIN-9)

        The big vocabulary table is filtered by the small key set first, so the
        left join that keeps every row of ``small`` is between small tables.
        """
        keys = list(keys)
        small = materialize(small)
        found = self.lookup(small.select(*keys).distinct()).select(*keys)
        return small.join(found.withColumn("in_v", F.lit(True)), keys, "left").withColumn("in_v", F.coalesce("in_v", F.lit(False)))

    def missing_documents(self) -> DataFrame:
        """(qid, doc_id) of candidates whose document is not in the collection (D15 report)."""
        return self.cset.join(self.collection.select("doc_id"), "doc_id", "left_anti").select("qid", "doc_id")

    def lengths(self) -> DataFrame:
        """(bucket, qid, doc_id, doc_len), partitioned by bucket."""
        return self.cand_len.select("bucket", "qid", "doc_id", "doc_len")

    def term_probs(self, mu=None) -> DataFrame:
        """(qid, doc_id, term, tf, doc_len, p_bg, p) for every term present in d (JOIN-4/5/7)."""
        mu = checked_mu(self.params.mu if mu is None else mu)
        t = self.exploded().join(self.bucket_bg.select("bucket", "qid", "term_id", "p_bg"), ["bucket", "qid", "term_id"])
        t = t.withColumn("p", dirichlet(F.col("tf"), F.col("doc_len"), F.col("p_bg"), mu))
        return self.with_terms(t.select("qid", "doc_id", "term_id", "tf", "doc_len", "p_bg", "p"))

    #: Stored tables, and whether they are laid out by bucket.
    _STORED = {"pairs": True, "bucket_bg": True, "cand_len": True, "cset": True, "n": False, "dictionary": False}

    def save(self, path: str) -> None:
        """Writes the models to a folder, tables of candidates bucketed by ``bucket`` and sorted, with their layout.

        ``load`` reads them for another method, setting or session; joins within
        buckets then need no exchange, as with freshly built models. Local
        contexts need the texts and are not stored.
        """
        spark = self.cset.sparkSession
        for name, bucketed in self._STORED.items():
            df = getattr(self, name)
            if not bucketed:
                df.write.parquet(f"{path}/{name}")
                continue
            order = [c for c in ("bucket", "qid", "term_id", "doc_id") if c in df.columns]
            table = f"relmod_{uuid.uuid4().hex}"
            placed = df.repartition(self.partitions, "bucket")  # one file a bucket
            placed.write.bucketBy(self.partitions, "bucket").sortBy(*order).option("path", f"{path}/{name}").saveAsTable(table)
            spark.sql(f"DROP TABLE {table}")  # the files stay
        layout = (self.partitions, self.n_pairs, self.has_large, self.params.unk_pct)
        spark.createDataFrame([layout], "partitions int, n_pairs long, has_large boolean, unk_pct double").write.parquet(f"{path}/layout")

    @classmethod
    def load(cls, spark, path: str, params: Params = Params()) -> CandidateModels:
        """Stored models. ``params`` may differ in what scores depend on; the texts' options are those of the build."""
        layout = spark.read.parquet(f"{path}/layout").first()
        self = cls.__new__(cls)
        self.params = params.with_(unk_pct=layout["unk_pct"])
        self.partitions, self.n_pairs, self.has_large = layout["partitions"], layout["n_pairs"], layout["has_large"]
        self.collection, self.doc_tokens, self.kept = None, None, []
        for name, bucketed in cls._STORED.items():
            df = spark.read.parquet(f"{path}/{name}")
            if bucketed:
                table = f"relmod_{uuid.uuid4().hex}"
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
                spark.sql(
                    f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}/{name}'"
                    f" CLUSTERED BY (bucket) INTO {self.partitions} BUCKETS"
                )
                df = spark.table(table)
            setattr(self, name, df)
        self.unk = self._unk(self.n)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, kept in the block store until ``unpersist``."""
        self.kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.kept[-1]

    def unpersist(self) -> None:
        """Frees what the models keep; call it once everything computed from them is stored."""
        for df in (self.pairs, self.bucket_bg, self.doc_tokens, *self.kept):
            if df is not None:
                df.unpersist()
