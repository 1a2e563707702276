"""Readers and writers for the retrieval text formats (SRC-1..8, SNK-1..3).

All readers use ``spark.read.text`` (quotes are literal, never CSV-parsed),
attach a file-order key straight after the read, and express the format
rules as column predicates:

* ``[query_id]`` header lines are skipped wherever they stand (FLT-1)
* blank lines are skipped (FLT-3); surrounding whitespace is stripped, and
  lines with exactly the expected field count are kept (FLT-2). With ``strict``
  any other line raises; ``malformed_lines`` lists them
* duplicates: the later line wins (AGG-17), except word2vec text files
  (the first vector of a word wins)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relmod.operators.ordering import last_wins, rank_within_auto, with_line_order
from relmod.params import WHITESPACE_CLASS

HEADER = "[query_id]"
_WS_RUN = WHITESPACE_CLASS  # one or more whitespace characters
_STRIP = f"^{_WS_RUN}|{_WS_RUN}$"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return with_line_order(spark.read.text(path), "line_no")


def _strip(c: Column) -> Column:
    """Python's str.strip(): remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(c, _STRIP, "")


def _fields(lines: DataFrame, n: int, sep: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(lines of exactly ``n`` fields as ``f``, the others): header and blank lines are in neither (FLT-1, 2, 3)."""
    stripped = _strip(F.col("value"))
    rows = lines.filter(stripped != "")
    if header:
        rows = rows.filter(~F.col("value").startswith(HEADER))
    rows = rows.withColumn("f", F.split(stripped, sep))
    return rows.filter(F.size("f") == n), rows.filter(F.size("f") != n)


def _checked(spark: SparkSession, path: str, n: int, sep: str, strict: bool, header: bool = True) -> DataFrame:
    good, bad = _fields(_lines(spark, path), n, sep, header)
    if strict:
        some = bad.select("value").take(1)
        if some:
            raise ValueError(f"{path}: a line has not {n} fields: {some[0][0][:200]!r}")
    return good


TAB = "\t"
#: Field count and separator of each format.
FORMATS = {
    "queries": (2, TAB),
    "candidates": (3, TAB),
    "scoring_candidates": (3, _WS_RUN),
    "collection": (4, TAB),
    "qrels": (4, _WS_RUN),
    "run": (6, _WS_RUN),
}


def malformed_lines(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """(line, n_fields) of the lines that a reader of ``fmt`` leaves out for their number of fields."""
    n, sep = FORMATS[fmt]
    _, bad = _fields(_lines(spark, path), n, sep, header=fmt != "collection")
    return bad.select(F.col("value").alias("line"), F.size("f").alias("n_fields"))


def read_queries(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(qid string, text string) from ``qid<TAB>text`` lines; a repeated qid keeps its last text (SRC-1)."""
    f = _checked(spark, path, *FORMATS["queries"], strict)
    rows = f.select(F.col("f")[0].alias("qid"), F.col("f")[1].alias("text"), "line_no")
    return last_wins(rows, "qid", "line_no")


def read_candidates(spark: SparkSession, path: str, scoring: bool = False, strict: bool = False) -> DataFrame:
    """(qid, doc_id, score double, pos int): candidate lists in file order (SRC-2, SRC-6).

    ``scoring=False``: tab-separated, 3 fields, qid string (ranking scripts).
    ``scoring=True``: whitespace-separated, blank lines skipped, qid int (evaluation).
    Duplicates are kept; ``pos`` is the 1-based position of the line within its query.
    """
    f = _checked(spark, path, *FORMATS["scoring_candidates" if scoring else "candidates"], strict)
    qid = F.col("f")[0].cast("int") if scoring else F.col("f")[0]
    rows = f.select(qid.alias("qid"), F.col("f")[1].alias("doc_id"), F.col("f")[2].try_cast("double").alias("score"), "line_no")
    return rank_within_auto(rows, "qid", [F.asc("line_no")], "pos").withColumn("pos", F.col("pos").cast("int")).drop("line_no")


def read_collection(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(doc_id, url, title, body): lines with exactly 4 tab fields after strip; last duplicate wins (SRC-3)."""
    f = _checked(spark, path, *FORMATS["collection"], strict, header=False)
    rows = f.select(
        F.col("f")[0].alias("doc_id"),
        F.col("f")[1].alias("url"),
        F.col("f")[2].alias("title"),
        F.col("f")[3].alias("body"),
        "line_no",
    )
    return last_wins(rows, "doc_id", "line_no")


def read_qrels(spark: SparkSession, path: str, columns=("qid", "doc_id", "relevance", "run"), strict: bool = False) -> DataFrame:
    """(qid int, doc_id, relevance int): whitespace judgements; last duplicate wins (SRC-4).

    ``columns`` names the four fields in file order; the TREC tool's order is
    ("qid", "run", "doc_id", "relevance") (D16).
    """
    f = _checked(spark, path, *FORMATS["qrels"], strict)
    idx = {c: i for i, c in enumerate(columns)}
    rows = f.select(
        F.col("f")[idx["qid"]].cast("int").alias("qid"),
        F.col("f")[idx["doc_id"]].alias("doc_id"),
        F.col("f")[idx["relevance"]].cast("int").alias("relevance"),
        "line_no",
    )
    return last_wins(rows, ["qid", "doc_id"], "line_no")


def read_run(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(qid int, doc_id, rank int, score double): run lines; keyed by (qid, rank), last wins (SRC-5)."""
    f = _checked(spark, path, *FORMATS["run"], strict)
    rows = f.select(
        F.col("f")[0].cast("int").alias("qid"),
        F.col("f")[2].alias("doc_id"),
        F.col("f")[3].cast("int").alias("rank"),
        F.col("f")[4].try_cast("double").alias("score"),
        "line_no",
    )
    return last_wins(rows, ["qid", "rank"], "line_no")


def read_embeddings(spark: SparkSession, path: str, fmt: str = "glove") -> DataFrame:
    """(term, vec array<double>) from GloVe or word2vec text vectors (SRC-7, SRC-8, SCL-15).

    GloVe: no header, doubles, a repeated word keeps its last vector. word2vec
    text: single precision, a repeated word keeps its first vector, and a
    table has one ``count dim`` header however many files hold it: a line of
    exactly two integers is the header where the table's other lines are
    longer. Of one-dimensional vectors, the table's first line is.
    """
    lines = _lines(spark, path)
    stripped = _strip(F.col("value"))
    f = lines.filter(stripped != "").withColumn("f", F.split(stripped, _WS_RUN))
    kind = "double"
    if fmt == "word2vec":
        kind = "float"
        widest, first = f.agg(F.max(F.size("f")), F.min("line_no")).first()
        two_integers = (F.size("f") == 2) & F.forall("f", lambda x: x.rlike(r"^\d+$"))
        if (widest or 0) > 2:
            f = f.filter(~two_integers)
        elif widest is not None:
            f = f.filter(~(two_integers & (F.col("line_no") == F.struct(*[F.lit(x).alias(n) for x, n in zip(first, "fbm")]))))
    rows = f.select(
        F.col("f")[0].alias("term"),
        F.slice("f", 2, F.size("f") - 1).cast(f"array<{kind}>").alias("vec"),
        "line_no",
    )
    if fmt == "word2vec":
        return rows.groupBy("term").agg(F.min_by("vec", "line_no").alias("vec"))
    return last_wins(rows, "term", "line_no")


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
def run_lines(run: DataFrame) -> DataFrame:
    """(qid, rank, line): ``qid Q0 doc rank score runid1`` with 4 decimals (SNK-1, PRJ-4)."""
    return run.select(
        "qid",
        "rank",
        F.format_string("%s Q0 %s %d %.4f runid1", F.col("qid").cast("string"), F.col("doc_id").cast("string"), "rank", "score").alias("line"),
    )


def write_run(run: DataFrame, path: str) -> None:
    """Write a run, queries in order and each best first."""
    (
        run_lines(run)
        .repartitionByRange("qid")
        .sortWithinPartitions("qid", "rank")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )


def expansion_lines(expansions: DataFrame) -> DataFrame:
    """(qid, line): ``qid: w1, w2, ...`` best first (SNK-2); at most K words per query."""
    words = F.transform(F.array_sort(F.collect_list(F.struct("rk", "term"))), lambda x: x["term"])
    return expansions.groupBy("qid").agg(
        F.concat(F.col("qid").cast("string"), F.lit(": "), F.array_join(words, ", ")).alias("line")
    )


def write_expansions(expansions: DataFrame, path: str) -> None:
    expansion_lines(expansions).repartitionByRange("qid").sortWithinPartitions("qid").select("line").write.mode(
        "overwrite"
    ).text(path)


def write_metrics(per_query: DataFrame, mean: DataFrame, path: str) -> None:
    """Per-query and mean NDCG tables as Parquet (SNK-3)."""
    per_query.write.mode("overwrite").parquet(f"{path}/per_query")
    mean.write.mode("overwrite").parquet(f"{path}/mean")


def read_metrics(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(per_query, mean) as ``write_metrics`` wrote them."""
    return spark.read.parquet(f"{path}/per_query"), spark.read.parquet(f"{path}/mean")


def write_lines(df: DataFrame, path: str, order) -> None:
    """The ``value`` column as lines; the part files read back in the order of the ``order`` columns."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def write_tsv(df: DataFrame, cols, path: str, header: str | None = None, order=()) -> None:
    """Write columns as tab-separated lines (fields must hold no tab or line break).

    With ``order`` the lines are range-partitioned and sorted so that the part
    files read back in that order; an optional header line comes first.
    """
    order = list(order)
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("value")
    out = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], line)
    if header is not None:
        head = df.sparkSession.createDataFrame([(header,)], "value string")
        for i, c in enumerate(order):
            head = head.withColumn(f"_o{i}", F.lit(None).cast(df.schema[c].dataType))
        out = head.unionByName(out)
    keys = [F.asc_nulls_first(f"_o{i}") for i in range(len(order))]
    if keys:
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out.select("value").write.mode("overwrite").text(path)
