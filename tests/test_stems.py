"""Stems by blocks: every occurrence of a word takes its stem, whatever the ids, and none is moved."""

import contextlib
import io
import random
import re

import pytest

from relmod.functions import stems as S
from relmod.params import TextOptions

STEMS = {"runs": "run", "running": "run", "bees": "bee", "the": "the", "thes": "the", "ants": "ant", "x": None, "two": ""}


def plain(rows, stop, stems):
    """Per id, the stems of all its rows in the order of their places, ties by stem; a null id has none."""
    found = {}
    for i, t in rows:
        for place, w in enumerate(re.split(r"\s+", (t or "").lower())):
            if w:
                found.setdefault(i, []).extend((place, s) for s in stems(w) if s not in stop)
    return sorted(((i, [w for _, w in sorted(found.get(i, []) if i is not None else []) if w]) for i, _ in rows), key=str)


def tables(seed):
    r = random.Random(seed)
    bits = [*STEMS, "Ants", "RUNS", "word", "été", "日本", " ", " ", " ", " ", " ", "  ", "\n", "\t", "　", "\x85", " "]
    text = lambda: "".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randint(0, 12)))
    rows = [(i, text()) for i in range(60)] + [(r.randrange(10), text()) for _ in range(20)] + [(None, text()) for _ in range(5)]
    return [*rows, rows[3], rows[3], (70, None), (71, ""), (72, " \n "), (None, None)]


@pytest.mark.parametrize("block_bytes", [16 << 20, 100])
@pytest.mark.parametrize("stopwords", [True, False])
def test_repeated_and_null_ids_as_in_a_plain_version(spark, monkeypatch, block_bytes, stopwords):
    monkeypatch.setattr(S, "BLOCK_BYTES", block_bytes)
    opts = TextOptions(stemming=True, stopwords=stopwords)
    rows = tables(1)
    given = [*STEMS.items(), ("bees", "wasp"), ("bees", "bee")]  # a table that repeats a word gives it all its stems

    def stems(w):
        return [w if s is None else s for k, s in given if k == w] or [w]

    got = S.stemmed_tokens(
        spark.createDataFrame(rows, "id long, t string"), "id", "t", spark.createDataFrame(given, "word string, stem string"), opts
    ).collect()
    assert sorted(((r.id, r.tokens) for r in got), key=str) == plain(rows, opts.stop_words if stopwords else (), stems)


def test_text_ids_and_no_words_at_all(spark):
    opts = TextOptions(stemming=True)
    rows = [("a", "Running ponies"), ("b", None), ("c", "... the")]
    got = S.stemmed_tokens(spark.createDataFrame(rows, "name string, body string"), "name", "body", opts=opts)
    assert got.columns == ["name", "tokens"]
    assert sorted(map(tuple, got.collect())) == [("a", ["run", "poni"]), ("b", []), ("c", [])]
    empty = spark.createDataFrame([("b", None), ("b", ""), (None, " ")], "name string, body string")
    assert [r.tokens for r in S.stemmed_tokens(empty, "name", "body", opts=opts).collect()] == [[], [], []]
    assert S.stemmed_tokens(empty.limit(0), "name", "body", opts=opts).collect() == []


def test_switches_off(spark):
    rows = [(1, "Dogs' RUNNING, 12.5 ponies"), (2, "a--b  c d")]
    df = spark.createDataFrame(rows, "id long, t string")
    stems = spark.createDataFrame([("RUNNING,", "Run"), ("ponies", "pony")], "word string, stem string")
    off = TextOptions(lowercase=False, punctuation=False, digits=False, stopwords=False, stemming=True)
    got = dict(map(tuple, S.stemmed_tokens(df, "id", "t", stems, off).collect()))
    assert got == {1: ["dogs", "run", "12", "5", "ponies".replace("ies", "y")], 2: ["a", "b", "c", "d"]}


def test_occurrences_are_not_moved(spark):
    df = spark.createDataFrame([(i, "ants run " * 50) for i in range(40)], "id long, t string")
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        S.stemmed_tokens(df, "id", "t", opts=TextOptions(stemming=True)).explain()
    assert "posexplode" not in plan.getvalue()  # a row for each occurrence, shuffled and sorted twice
    assert len(S.stemmed_tokens(df, "id", "t", opts=TextOptions(stemming=True)).first().tokens) == 100
