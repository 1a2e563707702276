"""Text pre-processing as native Spark column expressions (no UDF).

The chain is: lower-case -> delete ASCII punctuation -> digit runs to <NUM>
-> (stem) -> whitespace split and stop-word removal -> join by one space ->
lower-case again -> split on the delimiter class, dropping empty strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relmod.params import (
    CONTROL_DELIMITERS,
    DELIMITER_CLASS,
    DIGITS_PATTERN,
    NUM_TOKEN,
    PUNCTUATION,
    WHITESPACE_CHARS,
    WHITESPACE_CLASS,
    TextOptions,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fields_text(*cols) -> Column:
    """Document text = the given fields joined by one space (nulls count as '')."""
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in cols])


def normalize(text, opts: TextOptions = TextOptions()) -> Column:
    """Lower-case, punctuation deletion and digit masking (SCL-1, 2, 3)."""
    t = F.coalesce(_col(text), F.lit(""))
    if opts.lowercase:
        t = F.lower(t)
    if opts.punctuation:
        t = F.translate(t, PUNCTUATION, "")
    if opts.digits:
        t = F.regexp_replace(t, DIGITS_PATTERN, NUM_TOKEN)
    return t


def spaced(text, opts: TextOptions = TextOptions()) -> Column:
    """The normalised text with a space for every white-space character, in one pass less."""
    t = F.coalesce(_col(text), F.lit(""))
    if opts.lowercase:
        t = F.lower(t)
    t = F.translate(t, WHITESPACE_CHARS + (PUNCTUATION if opts.punctuation else ""), " " * len(WHITESPACE_CHARS))
    return F.regexp_replace(t, DIGITS_PATTERN, NUM_TOKEN) if opts.digits else t


def words(text, opts: TextOptions = TextOptions()) -> Column:
    """Whitespace words after normalisation and stop-word removal (SCL-5)."""
    parts = F.split(normalize(text, opts), WHITESPACE_CLASS)
    if opts.stopwords:
        stop = list(opts.stop_words)
        return F.filter(parts, lambda w: (w != "") & ~w.isin(stop))
    return F.filter(parts, lambda w: w != "")


def preprocess(text, opts: TextOptions = TextOptions()) -> Column:
    """The pre-processed text as one string (SCL-7), without stemming.

    Stems come from a table; ``relmod.functions.stems`` joins it.
    """
    return F.array_join(words(text, opts), " ")


def split_tokens(text: Column) -> Column:
    """The delimiter tokenizer (SCL-6): lower-case, split on delimiter runs, drop empties."""
    return F.filter(F.split(F.lower(text), DELIMITER_CLASS), lambda x: x != "")


def tokens(text, opts: TextOptions = TextOptions()) -> Column:
    """Token array of a text with the default chain (stemming off).

    With case, punctuation and digits switched on, a word holds no delimiter but
    the control characters. A text without these is split once, at single
    spaces, which the pass that deletes punctuation makes of all whitespace.
    """
    chain = split_tokens(preprocess(text, opts))
    if not (opts.lowercase and opts.punctuation and opts.digits):
        return chain
    t = F.coalesce(_col(text), F.lit(""))
    spaced = F.translate(F.lower(t), WHITESPACE_CHARS + PUNCTUATION, " " * len(WHITESPACE_CHARS))
    parts = F.split(F.regexp_replace(spaced, DIGITS_PATTERN, NUM_TOKEN.lower()), " ")
    stop = list(opts.stop_words) if opts.stopwords else []
    once = F.filter(parts, lambda w: (w != "") & ~w.isin(stop)) if stop else F.filter(parts, lambda w: w != "")
    return F.when(t.rlike(CONTROL_DELIMITERS), chain).otherwise(once)
