"""Edge-case literals of the pre-processing chain (SCL-1..7)."""

import pytest
from pyspark.sql import functions as F

from relmod.functions.text import fields_text, preprocess, tokens
from relmod.params import TextOptions

CASES = [
    ("don't stop", ["dont", "stop"]),  # apostrophe deleted: 'dont' is no stop-word
    ("3.14", ["<num>"]),
    ("covid19 b2b", ["covid<num>", "b<num>b"]),
    ("“quoted” — café", ["“quoted”", "—", "café"]),
    ("١٢", ["<num>"]),
    ("https://a.example/x", ["httpsaexamplex"]),
    ("The cat and the hat", ["cat", "hat"]),
    ("", []),
    ("a an the", []),
]


def _tok(spark, text, opts=TextOptions()):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(tokens("t", opts).alias("x")).first()["x"]


@pytest.mark.parametrize("text,expected", CASES)
def test_tokens(spark, text, expected):
    assert _tok(spark, text) == expected


def test_switches(spark):
    # digits off: '4' and '2' stay; the delimiter class holds 8 and 9 only
    assert _tok(spark, "x48y", TextOptions(digits=False)) == ["x4", "y"]
    # stop-words off keeps 'the'
    assert _tok(spark, "the cat", TextOptions(stopwords=False)) == ["the", "cat"]


def test_preprocess_string(spark):
    df = spark.createDataFrame([("It's 3.5 MILES, don't guess",)], "t string")
    assert df.select(preprocess("t")).first()[0] == "<NUM> miles dont guess"


def test_fields_text_nulls(spark):
    df = spark.createDataFrame([(None, "Title", "Body")], "u string, t string, b string")
    assert df.select(fields_text("u", "t", "b")).first()[0] == " Title Body"


def test_control_characters_split(spark):
    # \x07 is a delimiter but not whitespace: it splits a word after stop-word removal
    assert _tok(spark, "ab\x07cd") == ["ab", "cd"]
