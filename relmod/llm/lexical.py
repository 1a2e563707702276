"""Ranked lexical search on a length-stratified index.

A document's normaliser m is a step function of its length, so documents of
equal m form a stratum, and within a stratum a posting's impact depends on its
tf alone. The index holds, for every stratum, each term's postings grouped by
tf: an impact is computed once for a group, however many documents it has. A
term's best impact in a stratum is that of its greatest tf there; summed over a
query's terms, these bound the score of every document of the stratum.

A search visits every query's strata of the highest bounds first, which gives a
score that k documents reach. Then all strata are passed, and of each only the
queries are scored whose bound reaches that score, or the better one that the
task has met meanwhile. What is skipped cannot belong to a result.

Score and weights are integers: with N documents that hold a term, L terms in
all of them, n in one of them and df documents that hold a term,

  w = floor(1000 ln((2 N + 2) / (2 df + 1))),   m = 75 + (25 n N) div L,
  score = sum over the query's terms of w ((10^9 tf) div (1000 tf + 12 m)).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.llm.common import give_back, stored
from relmod.operators.ordering import top_k
from relmod.session import broadcast_if_small, bytes_of

#: A term is a maximal match; only A-Z are lower-cased.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms of a stratum's documents in one row of the index; larger strata are split.
TERMS_PER_PART = 2_000_000
#: Strata parts that a query visits before the others.
FIRST_VISITS = 8
#: Queries of up to so many bytes are searched at once.
SLICE_BYTES = 8 << 20
BROADCAST_BYTES = 32 << 20
DOCS_AT_ONCE = 1000

_TABLE = bytes(
    b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """A text's terms in UTF-8, in their order."""
    return (text or "").encode().translate(_TABLE).split()


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Index(NamedTuple):
    """parts: a stored table, one row per part of a stratum:

    m, part, docs (keys in order), terms (in order, joined by a space), groups
    (per term, how many tf it has), tf and sizes (per group, its tf and how
    many documents), slots (all groups' documents as places in ``docs``).
    documents, length: N and L.
    """

    parts: DataFrame
    documents: int
    length: int


# ---------------------------------------------------------------- index


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        met: Counter[int] = Counter()
        for low in range(0, batch.num_rows, DOCS_AT_ONCE):
            met.update(len(terms_of(t)) for t in batch.column(0).slice(low, DOCS_AT_ONCE).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(met.keys(), pa.int64()), pa.array(met.values(), pa.int64())], ["n", "docs"])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, text): n, distinct terms joined by a space, and their tf (little-endian uint32)."""
    for batch in batches:
        for low in range(0, batch.num_rows, DOCS_AT_ONCE):
            some = batch.slice(low, DOCS_AT_ONCE)
            n, bags, tfs = [], [], []
            for t in some.column(1).to_pylist():
                terms = terms_of(t)
                bag = Counter(terms)
                n.append(len(terms))
                bags.append(b" ".join(bag))
                tfs.append(np.fromiter(bag.values(), "<u4", len(bag)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(n, pa.int64()), pa.array(bags, pa.binary()), pa.array(tfs, pa.binary())], ["key", "n", "bag", "tfs"]
            )
        give_back()


def _part_of(key: tuple, rows: pa.Table) -> pa.Table:
    """One index row of the documents of a stratum's part."""
    order = pc.sort_indices(rows.column("key"), null_placement="at_start")
    rows = rows.take(order)
    tfs = [np.frombuffer(b, "<u4") for b in rows.column("tfs").to_pylist()]
    tf = np.concatenate(tfs).astype(np.int64)
    slots = np.repeat(np.arange(len(tfs)), [len(t) for t in tfs])
    met = pa.array(b" ".join(rows.column("bag").to_pylist()).split(), pa.binary()).dictionary_encode()
    by_bytes = pc.sort_indices(met.dictionary).to_numpy()
    rank = np.empty(len(by_bytes), np.int64)
    rank[by_bytes] = np.arange(len(by_bytes))
    group = rank[met.indices.to_numpy()] << 32 | tf
    at = np.argsort(group, kind="stable")  # documents stay in order within a group
    group, slots = group[at], slots[at]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    groups = np.bincount(group[starts] >> 32, minlength=len(rank))
    terms = b" ".join(met.dictionary.take(pa.array(by_bytes)).to_pylist())

    def one(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int32)))

    docs = rows.column("key").combine_chunks()
    out = pa.table(
        [
            pa.array([key[0].as_py()], pa.int64()),
            pa.array([key[1].as_py()], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
            pa.array([terms], pa.binary()),
            one(groups),
            one(group[starts] & 0xFFFFFFFF),
            one(sizes),
            one(slots),
        ],
        names=["m", "part", "docs", "terms", "groups", "tf", "sizes", "slots"],
    )
    give_back()
    return out


def build_index(df: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """The index of all rows' whole texts.

    Texts without a term (null and empty ones among them) are not in it and
    count nowhere. Repeated keys are documents of their own; a null key is a
    key and stands first. An empty table gives an empty index. Other columns
    are not read.

    Documents are shuffled once, as their distinct terms and counts, by stratum
    and part: a stratum of any share of the rows is cut into parts of about
    ``TERMS_PER_PART`` terms, by a hash of key, terms and input partition.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    lengths = stored(
        rows.select("text").mapInArrow(_lengths, "n long, docs long").filter("n > 0").groupBy("n").agg(F.sum("docs").alias("docs")), "lengths"
    )
    documents, length = lengths.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
    documents, length = documents or 0, length or 0
    m = F.expr(f"{100 - 25} + (25 * n * {documents}L) div {max(length, 1)}L").alias("m")
    by_length = lengths.select("n", "docs", m)
    size = F.sum(F.col("n") * F.col("docs"))
    strata = by_length.groupBy("m").agg(F.ceil(size / F.lit(TERMS_PER_PART)).cast("long").alias("parts"))
    strata = stored(by_length.select("n", "m").join(strata, "m"), "strata")  # at most a row per length
    schema = T.StructType(
        [
            T.StructField("key", df.schema[key].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("bag", T.BinaryType()),
            T.StructField("tfs", T.BinaryType()),
        ]
    )
    bags = rows.mapInArrow(_bags, schema).filter("n > 0").join(broadcast_if_small(strata, BROADCAST_BYTES), "n")
    part = F.pmod(F.xxhash64("key", "bag", F.spark_partition_id()), "parts").alias("part")
    ints = T.ArrayType(T.IntegerType())
    parts_schema = T.StructType(
        [
            T.StructField("m", T.LongType()),
            T.StructField("part", T.LongType()),
            T.StructField("docs", T.ArrayType(df.schema[key].dataType)),
            T.StructField("terms", T.BinaryType()),
            *[T.StructField(c, ints) for c in ("groups", "tf", "sizes", "slots")],
        ]
    )
    parts = stored(bags.select("m", part, "key", "bag", "tfs").groupBy("m", "part").applyInArrow(_part_of, parts_schema), "index")
    return Index(parts, documents, length)


# ---------------------------------------------------------------- search


class Queries(NamedTuple):
    """A slice of queries for the tasks: entry e says that query ``query[e]`` holds ``wanted[term[e]]``, worth ``weight[e]``."""

    wanted: pa.Array
    query: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    least: np.ndarray  # by query, the score that its results must reach


def _numbers(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _places(terms: bytes, wanted: pa.Array) -> np.ndarray:
    """Where a part's terms hold the wanted ones, -1 where they don't."""
    found = pc.index_in(wanted, value_set=pa.array(terms.split(), pa.binary()))
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _found_terms(shared):
    """Of (m, part, terms, groups, tf, sizes): m, part, term (its number), df and greatest tf of the wanted terms."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.binary())
        for batch in batches:
            for row in range(batch.num_rows):
                places = _places(batch.column(2)[row].as_py(), wanted)
                term = np.flatnonzero(places >= 0)
                ends = np.cumsum(_numbers(batch.column(3), row))
                counts = np.concatenate([[0], np.cumsum(_numbers(batch.column(5), row))])
                last = ends[places[term]]
                first = np.where(places[term] > 0, ends[places[term] - 1], 0)
                n = len(term)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column(0)[row].as_py())),
                        pa.array(np.full(n, batch.column(1)[row].as_py())),
                        pa.array(term.astype(np.int32)),
                        pa.array(counts[last] - counts[first]),
                        pa.array(_numbers(batch.column(4), row)[last - 1]),
                    ],
                    ["m", "part", "term", "df", "max_tf"],
                )

    return find


class _Best:
    """The k best scores that a task has met for each query."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k
        self.scores: dict[int, np.ndarray] = {}

    def add(self, query: int, scores: np.ndarray) -> None:
        kept = np.sort(np.concatenate([self.scores.get(query, scores[:0]), scores]))[-self.k :]
        self.scores[query] = kept
        if len(kept) == self.k:
            self.least[query] = max(self.least[query], kept[0])


def _scored(shared, k: int, key_type: pa.DataType | None = None):
    """Of index rows, and queries to visit if they have a ninth column: q, doc_id, score of each part's k best."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best = _Best(queries.least, k)
        bounds_at = np.flatnonzero(np.concatenate([[True], queries.query[1:] != queries.query[:-1]])) if len(queries.query) else np.empty(0, np.int64)
        ends = np.append(bounds_at[1:], len(queries.query))
        for batch in batches:
            for row in range(batch.num_rows):
                m, docs = batch.column(0)[row].as_py(), batch.column(2)[row].values
                places = _places(batch.column(3)[row].as_py(), queries.wanted)
                group_ends = np.cumsum(_numbers(batch.column(4), row))
                worth = impact(_numbers(batch.column(5), row), m)  # once per term and tf
                sizes, slots = _numbers(batch.column(6), row), _numbers(batch.column(7), row)
                slot_ends = np.cumsum(sizes)
                place = places[queries.term]
                most = np.where(place >= 0, worth[group_ends[place] - 1], 0) * queries.weight
                bound = np.add.reduceat(most, bounds_at) if len(bounds_at) else most
                visit = (bound > 0) & (bound >= best.least[queries.query[bounds_at]])
                if batch.num_columns > 8:
                    visit &= np.isin(queries.query[bounds_at], _numbers(batch.column(8), row))
                postings: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for v in np.flatnonzero(visit).tolist():
                    query = int(queries.query[bounds_at[v]])
                    total = np.zeros(len(docs), np.int64)
                    for e in range(bounds_at[v], ends[v]):
                        at = int(place[e])
                        if at < 0:
                            continue
                        if at not in postings:
                            low, high = int(group_ends[at - 1]) if at else 0, int(group_ends[at])
                            first = int(slot_ends[low - 1]) if low else 0
                            postings[at] = slots[first : int(slot_ends[high - 1])], np.repeat(worth[low:high], sizes[low:high])
                        where, each = postings[at]
                        total[where] += queries.weight[e] * each
                    near = np.flatnonzero(total >= max(1, int(best.least[query])))
                    if len(near) > k:  # of equal scores, the first keys
                        near = near[np.argsort(-total[near], kind="stable")[:k]]
                    if len(near):
                        best.add(query, total[near])
                        out.append((np.full(len(near), query), near, total[near]))
                if out:
                    q, near, total = (np.concatenate(c) for c in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q.astype(np.int32)), docs.take(pa.array(near)), pa.array(total)], ["q", "doc_id", "score"]
                    )
            give_back()

    return score


def search(index: Index, queries: DataFrame, k: int = 20, key: str = "item_id", text: str = "text") -> DataFrame:
    """One row per query and result: ``key``, rank (from 1), doc_id, score; the ``k`` highest scores above 0.

    Equal scores stand by ascending doc_id, null first. A query's terms count
    with their repeats; every row of ``queries`` is a query of its own, so
    repeated keys have their results each. Null texts and texts without terms
    have none, nor has an empty index or table. Other columns are not read.

    Queries come to the tasks in slices of ``SLICE_BYTES``; a task holds one
    part of the index at a time, and k results per query and part are sent on.
    """
    spark = queries.sparkSession
    asked = stored(queries.select(F.col(key).alias("key"), F.col(text).alias("text")), "queries")
    slices = max(1, math.ceil(bytes_of(asked) / SLICE_BYTES))
    cut = F.pmod(F.xxhash64("key", "text"), F.lit(slices))
    doc_type, key_type = index.parts.schema["docs"].dataType.elementType, asked.schema["key"].dataType
    out = None
    for i in range(slices):
        rows = asked.filter(cut == i).collect()  # about SLICE_BYTES
        found = _search_slice(spark, index, [terms_of(r["text"]) for r in rows], k, doc_type)
        names = spark.createDataFrame(
            [(n, r["key"]) for n, r in enumerate(rows)], T.StructType([T.StructField("q", T.IntegerType()), T.StructField(key, key_type)])
        )
        named = found.join(F.broadcast(names), "q").select(key, "rank", "doc_id", "score")  # a part of the slice
        out = named if out is None else out.unionByName(named)
    return out


def _search_slice(spark: SparkSession, index: Index, asked: list[list[bytes]], k: int, doc_type: T.DataType) -> DataFrame:
    """q, rank, doc_id, score of one slice of queries, as their terms."""
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("doc_id", doc_type), T.StructField("score", T.LongType())])
    wanted = sorted({t for terms in asked for t in terms})
    share = spark.sparkContext.broadcast
    stats = index.parts.select("m", "part", "terms", "groups", "tf", "sizes")
    found = stored(stats.mapInArrow(_found_terms(share(wanted)), "m long, part long, term int, df long, max_tf long"), "found_terms")
    df = dict(found.groupBy("term").agg(F.sum("df")).collect())  # at most a row per term of the slice
    weight = {t: math.floor(1000 * math.log((2 * index.documents + 2) / (2 * df[t] + 1))) for t in df}
    number = {t: n for n, t in enumerate(wanted)}
    entries = [
        (q, number[t], n * weight[number[t]])
        for q, terms in enumerate(asked)
        for t, n in sorted(Counter(terms).items())
        if weight.get(number[t], 0) > 0
    ]
    held = spark.createDataFrame(entries, "q int, term int, weight long")
    # every query's parts of the highest bounds are visited first
    best = impact_column(F.col("max_tf"), F.col("m")) * F.col("weight")
    bounds = found.join(broadcast_if_small(held, BROADCAST_BYTES), "term").groupBy("q", "m", "part").agg(F.sum(best).alias("bound"))
    first = top_k(bounds, "q", [F.desc("bound"), F.asc("m"), F.asc("part")], FIRST_VISITS)
    visits = first.groupBy("m", "part").agg(F.collect_list("q").alias("visits"))  # of the slice's queries
    packed = [np.array(c, np.int64) for c in zip(*entries, strict=True)] if entries else [np.empty(0, np.int64)] * 3

    def scored(rows: DataFrame, least: np.ndarray) -> DataFrame:
        shared = share(Queries(pa.array(wanted, pa.binary()), *packed, least))
        columns = ["m", "part", "docs", "terms", "groups", "tf", "sizes", "slots", *(["visits"] if "visits" in rows.columns else [])]
        return top_k(rows.select(columns).mapInArrow(_scored(shared, k), schema), "q", [F.desc("score"), F.asc("doc_id")], k, "rank")

    least = np.ones(len(asked), np.int64)
    seen = scored(index.parts.join(F.broadcast(visits), ["m", "part"]), least)  # FIRST_VISITS rows a query
    for q, score in seen.filter(F.col("rank") == k).select("q", "score").collect():  # at most one a query
        least[q] = score
    return stored(scored(index.parts, least), "results")


def impact_column(tf: Column, m: Column) -> Column:
    """``impact`` of columns."""
    return F.call_function("div", tf * F.lit(1_000_000_000).cast("long"), tf * 1000 + m * 12)


# ---------------------------------------------------------------- SQL


def search_sql(k: int, upper: str, lower: str) -> str:
    """SQL of ``search`` of benchmark's items over the documents."""
    terms = f"regexp_extract_all(translate(text, '{upper}', '{lower}'), '{TERM_PATTERN}')"
    return f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, {terms} AS terms FROM documents),
        t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
        n AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
        a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
        m AS (SELECT r, doc_id, 75 + (25 * n * docs) // total AS m FROM n, a),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
              FROM (SELECT term, count(*) AS df FROM t GROUP BY term), a),
        i AS (SELECT item_id, row_number() OVER () AS q, {terms} AS terms FROM benchmark),
        q AS (SELECT q, item_id, term, count(*) AS qtf FROM (SELECT q, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
        s AS (SELECT q, item_id, r, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
              FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST))::INTEGER AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= {k}
    """
