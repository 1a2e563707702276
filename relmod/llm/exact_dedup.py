"""Exact deduplication by a content sort [native].

The normalised bytes of every document are range-partitioned by sampled
splitters and sorted (Spark's external sort, which spills), so that equal
contents stand next to each other; neighbours are then compared in full and
each run of equal neighbours keeps one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from relmod.llm.common import squeezed, stored, tasks_for

#: Code points of the content that a splitter carries. Splitters only deal
#: rows out; equality is decided on whole contents.
SPLITTER_CHARS = 48
#: A content is hot if it holds more than 1/HOT_SHARE of the rows, so there are
#: fewer than HOT_SHARE hot contents, whatever the input's size.
HOT_SHARE = 500
ROWS_PER_TASK = 20_000


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text", normalise=squeezed) -> DataFrame:
    """One row per row of ``df``: its group of equal normalised contents.

    Columns: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised
    content). Of a group, the row with the most code points in its original
    text stays, of several the smallest key; null keys come last. Null and
    empty texts are one group. Fully repeated rows (same key, same length) all
    name the same keep_id and only one of them is kept. An empty table gives
    an empty result; other columns are not read.

    A content that holds a large share of all rows is dealt out over many
    tasks by a salt of its key; the runs' winners of such contents (one row for
    each run) then meet in a small aggregation.
    """
    spark = df.sparkSession
    content = normalise(F.col(text))
    rows = df.select(
        F.col(key).alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("_chars"),
        content.alias("_content"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_hash", F.xxhash64("_content"))

    counts = stored(
        df.select(F.xxhash64(content).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")), "contents"
    )
    n = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.filter(F.col("_n") * HOT_SHARE > n).select("_hash", F.lit(True).alias("_hot"))
    tasks = tasks_for(n, ROWS_PER_TASK, spark)

    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_row"), F.lit(4 * tasks))).otherwise(F.lit(0)).cast("int")
    spread = rows.join(F.broadcast(hot), "_hash", "left").select(
        "doc_id",
        "_chars",
        "_content",
        "_hash",
        "_row",
        F.coalesce("_hot", F.lit(False)).alias("_hot"),
        salt.alias("_salt"),
        F.substring("_content", 1, SPLITTER_CHARS).alias("_head"),
    )
    # equal contents have equal heads and hashes: the window below needs no further exchange
    placed = spread.repartitionByRange(tasks, "_head", "_hash", "_salt")
    run = (
        Window.partitionBy("_head", "_hash", "_salt", "_content")
        .orderBy(F.desc("_chars"), F.asc_nulls_last("doc_id"), F.asc("_row"))
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    runs = stored(
        placed.select(
            "doc_id",
            "_chars",
            "_row",
            "_hot",
            F.sha2("_content", 256).alias("text_sha256"),
            F.first(F.struct("_chars", "doc_id", "_row")).over(run).alias("_best"),
            F.count(F.lit(1)).over(run).alias("_n"),
        ),
        "runs",
    )
    cold = runs.filter(~F.col("_hot")).select("doc_id", "_row", "text_sha256", "_best", "_n")
    winners = (
        runs.filter(F.col("_hot"))
        .groupBy("text_sha256", "_best")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("text_sha256")
        .agg(F.min(_rank("_best")).alias("_min"), F.sum("_n").alias("_n"))
        .select("text_sha256", "_min", "_n")
    )
    warm = (
        runs.filter(F.col("_hot"))
        .select("doc_id", "_row", "text_sha256")
        .join(F.broadcast(winners), "text_sha256")  # fewer than HOT_SHARE rows
        .select(
            "doc_id",
            "_row",
            "text_sha256",
            F.struct((-F.col("_min.c")).alias("_chars"), F.col("_min.k").alias("doc_id"), F.col("_min.r").alias("_row")).alias("_best"),
            "_n",
        )
    )
    return cold.unionByName(warm).select(
        "doc_id",
        F.col("_best.doc_id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_best._row")).alias("kept"),
        "text_sha256",
    )


def _rank(best: str) -> Column:
    """A struct that is smallest for the row that stays, in the order of the runs."""
    return F.struct(
        (-F.col(f"{best}._chars")).alias("c"),
        F.col(f"{best}.doc_id").isNull().alias("n"),
        F.col(f"{best}.doc_id").alias("k"),
        F.col(f"{best}._row").alias("r"),
    )
