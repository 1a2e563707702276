"""Stemming (SCL-4) as a join with a (word, stem) table, a given one or that of the English rules."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.functions.english import english_stems
from relmod.functions.text import normalize, spaced, split_tokens
from relmod.params import WHITESPACE_CLASS, TextOptions

#: Bytes of text in a block, whose distinct words meet their stems once.
BLOCK_BYTES = 16 << 20


def text_words(df: DataFrame, id_col: str, text_col: str, opts: TextOptions = TextOptions()) -> DataFrame:
    """(id, pos, word): whitespace words of the normalised text."""
    return df.select(
        id_col, F.posexplode(F.split(normalize(text_col, opts), WHITESPACE_CLASS)).alias("pos", "word")
    ).filter(F.col("word") != "")


def stem_lexicon(words: DataFrame) -> DataFrame:
    """(word, stem) by the English rules, each distinct word stemmed once."""
    return english_stems(words.select("word").distinct())


def block_words(block: pa.Table) -> pa.Table:
    """(block, word): the distinct words of a block's texts."""
    words = pc.unique(pc.split_pattern(block["text"], " ").combine_chunks().flatten())
    words = words.filter(pc.not_equal(words, ""))
    return pa.table({"block": pa.repeat(block["block"][0], len(words)), "word": words})


def with_stems(stop: tuple[str, ...]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The step for a block's texts (block, id, text) and stems (block, word, stem): (id, text), a row for each text.

    A text is the stems that are no stop-words, joined by spaces. Words of rows
    with the same id are one text, in the order of their places and stems; a
    null id has none.
    """

    def step(texts: pa.Table, stems: pa.Table) -> pa.Table:
        lists = pc.split_pattern(texts["text"], " ").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        words = lists.flatten()
        some = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        # places count words, and the empty one before leading white space
        upto = np.concatenate([[0], np.cumsum(some)])
        first = np.cumsum(sizes) - sizes
        place = (upto[:-1] - upto[first][row] + ~some[first][row])[some]
        row, words = row[some], words.filter(pa.array(some))

        stems = stems.sort_by([("word", "ascending"), ("stem", "ascending")])
        known = pc.unique(stems["word"])
        code = pc.index_in(words, value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)
        # a word's stems are neighbours: one, or as many as a given table has
        n = np.bincount(pc.index_in(stems["word"], value_set=known).to_numpy().astype(np.int64), minlength=len(known))
        times = n[code]
        ends = np.cumsum(times)
        at = np.repeat((np.cumsum(n) - n)[code] - ends + times, times) + np.arange(int(ends[-1]) if len(ends) else 0)
        kept = ~pc.is_in(stems["stem"], value_set=pa.array(stop, stems["stem"].type)).to_numpy(zero_copy_only=False)[at]
        at, row, place = at[kept], np.repeat(row, times)[kept], np.repeat(place, times)[kept]

        # the first row of each row's id; a null id's words are not in its text
        ids = texts["id"].combine_chunks().dictionary_encode()
        of = ids.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        count = len(ids.dictionary)
        if (of < 0).any():
            held = of[row] >= 0
            at, row, place = at[held], row[held], place[held]
        owner = of[row]
        if count < len(of) - int((of < 0).sum()):
            order = np.lexsort([at_rank(stems["stem"])[at], place, owner])
            at, owner = at[order], owner[order]
        elif (np.diff(owner) < 0).any():
            order = np.argsort(owner, kind="stable")
            at, owner = at[order], owner[order]
        offsets = np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)
        taken = stems["stem"].combine_chunks().take(pa.array(at))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), taken), " ")
        text = joined.take(pa.array(of, mask=of < 0)).fill_null("")
        return pa.table({"id": texts["id"], "text": text})

    return step


def at_rank(values: pa.ChunkedArray) -> np.ndarray:
    """Each value's rank in byte order, equal values alike."""
    return pc.rank(values, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)


def stemmed_tokens(
    df: DataFrame, id_col: str, text_col: str, stems: DataFrame | None = None, opts: TextOptions = TextOptions()
) -> DataFrame:
    """(id, tokens) with the full chain and stems (SCL-7 with the stemming switch).

    normalise -> whitespace words with their places -> their stems by a join
    (a word that the table lacks is its own stem) -> stop-words -> join by a
    space per document -> delimiter tokenizer. ``stems`` has one row per word;
    without it, the words' stems are those of the English rules.

    Texts are dealt by id into blocks of about ``BLOCK_BYTES``. The join is
    over the blocks' distinct words, which come back to their block with their
    stems; a word's occurrences are neither moved nor sorted.
    """
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    spark = df.sparkSession
    parts = max(blocks, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # rows without an id end up empty: any block will do
    dealt = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(id_col))
    texts = df.select(
        F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"), F.col(id_col).alias("id"), spaced(text_col, opts).alias("text")
    ).repartition(parts, "block")
    words = (
        texts.groupBy("block")
        .applyInArrow(block_words, "block int, word string")
        .repartition(parts, "word")
        .groupBy("word")
        .agg(F.collect_list("block").alias("blocks"))
    )
    if stems is None:
        known = english_stems(words)
    else:
        known = words.join(stems.select("word", "stem"), "word", "left").withColumn("stem", F.coalesce("stem", "word"))
    back = known.select(F.explode("blocks").alias("block"), "word", "stem")
    stop = tuple(opts.stop_words) if opts.stopwords else ()
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("text", T.StringType())])
    out = texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(with_stems(stop), schema)
    return out.select(F.col("id").alias(id_col), split_tokens(F.col("text")).alias("tokens"))
