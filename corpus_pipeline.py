"""From raw documents to packed sequences: language, repeated lines, near duplicates, packing.

Every stage works on all that the stage before it kept, and is written and
read again before the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relmod.llm import jaccard, langid, line_dedup, packing
from relmod.llm.common import stored, table
from relmod.llm.queries import TOKENIZER, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents' own languages; ``lang`` becomes the predicted one.

    Rejected are documents without a letter (or text), whose language stays
    undetermined. How sure a prediction is decides nothing: a short text of
    words that languages share, or of new ones, is no worse a document.
    """
    names = docs.columns
    found = langid.predict(docs.withColumnRenamed("lang", "_lang_given"), langid.train(docs), keep=[c if c != "lang" else "_lang_given" for c in names])
    known = found.filter(F.col("lang_pred") != langid.UNDETERMINED)
    return known.withColumn("lang", F.col("lang_pred")).select(*names)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents share stay in one; ``n_chars`` follows the text."""
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of those that links of Jaccard similarity 0.8 on five-word shingles connect."""
    return jaccard.one_of_each(docs, words=5, num=8, den=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, its place in a sequence and its token ids."""
    return packing.pack(docs, tokenizer_path(TOKENIZER), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("packing", pack),
]

#: SQL expresses none of the stages but the second; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
