"""The derived inputs at scale: bounded tasks, one pass over the texts, pairs counted where they are."""

import os

import pytest
from pyspark.sql import functions as F

from relmod import session
from relmod.functions import text as T
from relmod.params import TextOptions
from relmod.sources import fixtures as X

QUERY = "alpha beta gamma delta epsilon zeta"


@pytest.fixture()
def tables(spark, tmpdir_run):
    """A folder whose documents hold an n-gram of the query at places 1, 2, ...; ids come twice or are null."""
    rows = [(i, "x " * i + "alpha beta gamma delta epsilon") for i in range(9)]
    rows += [(20, "alpha x beta x gamma"), (21, "alpha"), (22, None), (23, "beta gamma delta epsilon"), (24, "x " * 9 + "beta gamma delta epsilon zeta")]
    rows += [(30, "alpha"), (30, "beta"), (None, "alpha beta gamma delta epsilon"), (40, "alpha beta gamma\tdelta\x07epsilon")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(os.path.join(tmpdir_run, "documents.parquet"))
    spark.createDataFrame([(1, QUERY), (2, "alpha"), (None, QUERY)], "item_id long, text string").write.parquet(os.path.join(tmpdir_run, "benchmark.parquet"))
    return tmpdir_run


def test_qrels_find_ngrams_at_every_place(spark, tables):
    found = sorted(map(tuple, X.qrels(spark, tables).collect()), key=str)
    held = [*range(9), 24, 40]
    graded = [(1, d, 2) for d in held] + [(None, d, 2) for d in held] + [(1, 20, 1), (1, 23, 1), (1, 30, 1)]
    graded += [(2, d, 1) for d in [*range(9), 20, 21, 30, 40, None]]
    graded += [(1, None, 2), (None, None, 2), (1, None, 1)]
    assert found == sorted(graded, key=str)
    fx = X.Fixtures(spark, tables)
    assert sorted(map(tuple, fx.qrels().collect()), key=str) == found
    assert sorted(map(tuple, fx.candidates().collect()), key=str) == sorted(map(tuple, X.candidates(spark, tables).collect()), key=str)


def test_pairs_are_not_shuffled(spark, tables):
    for df in (X.candidates(spark, tables), X.qrels(spark, tables)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(qid" not in plan or "doc_id" not in plan.split("hashpartitioning(qid")[1].split(")")[0]
        assert plan.count("split(") <= 4  # the chain once, with and without control characters


def test_a_task_takes_a_bounded_number_of_texts(spark):
    n = 3 * spark.sparkContext.defaultParallelism
    df = spark.range(n * 10).withColumn("text", F.lit("a"))
    assert session.spread_by(df, "id", rows_per_task=10).rdd.getNumPartitions() == n
    assert session.spread_by(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_one_split_gives_the_tokens_of_the_chain(spark):
    texts = ["the\x07cat", "a b\xa0The c", "3.14 x9y ٣٫٤ 1,000", "İstanbul ΣΑΣ don't", "\x00\x01", " \t\r\n\x1c ", None, "a_b <b> \x85c　d", "“q” —"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for opts in (TextOptions(), TextOptions(stopwords=False)):
        rows = df.select(T.tokens("t", opts).alias("a"), T.split_tokens(T.preprocess("t", opts)).alias("b")).collect()
        assert all(r.a == r.b for r in rows)
    # a text without control characters is split at single spaces only
    plan = df.select(T.tokens("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert ",  , -1)" in plan
