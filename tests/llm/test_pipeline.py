"""The pipeline against a plain version of its stages."""

import random

import corpus_pipeline
import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(prose):
    r = random.Random(3)
    shared = "This very line is the same in a lot of these documents."
    rows = []
    for i in range(150):
        text = prose(i, r.choice((5, 40, 120)))
        if i % 4 == 0:
            text = shared + "\n" + text
        if i % 10 == 9:
            text = rows[-3][1]
        rows.append((i, text, "aa", "s", len(text)))
    rows += [(200, None, "aa", None, None), (201, "", None, "s", 0), (202, "12 34 !!", "aa", "s", 8), (203, prose(500, 9000), "aa", "s", 1)]
    rows += [(None, prose(501, 30), None, None, None), (204, shared, "aa", "s", 1), (1, rows[1][1], "aa", "s", 1)]
    return rows


def test_stages_against_plain_versions(spark, prose, tmpdir_run):
    from test_jaccard import plain as similar
    from test_line_dedup import plain as lines

    rows = documents(prose)
    docs = spark.createDataFrame(rows, SCHEMA)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_jaccard", "packing"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "")
        if name != "packing":
            assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got.write.parquet(f"{tmpdir_run}/{name}")
        docs = spark.read.parquet(f"{tmpdir_run}/{name}")
        out[name] = docs.collect()

    first = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(((r.doc_id, r.text) for r in out["language_id"]), key=repr) == sorted(((r[0], r[1]) for r in first), key=repr)
    second = lines([(r[0], r[1]) for r in first], 5, 40)
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in out["line_dedup"]), key=repr) == sorted(((i, t, len(t)) for i, t, *_ in second), key=repr)
    known = similar([(i, t) for i, t, *_ in second], 5, 8, 10)
    assert sorted((r.doc_id for r in out["ngram_jaccard"]), key=repr) == sorted({c for _, _, c in known}, key=repr)
    assert {(r.doc_id, r.text) for r in out["ngram_jaccard"]} <= {(i, t) for i, t, *_ in second}

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(corpus_pipeline.tokenizer_path(corpus_pipeline.TOKENIZER))
    tokens = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in out["ngram_jaccard"]}
    packed, ids = {}, {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for r in out["ngram_jaccard"]}
    for r in out["packing"]:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length]
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == tokens[r.doc_id]
    assert packed == tokens


def test_short_texts_of_several_languages_stay(spark):
    """Only texts without a letter go, whatever the languages share and however little is known of a text."""
    texts = {
        "aa": ["la casa roja la mesa", "la casa es la casa de mesa"],
        "bb": ["le chat la maison", "la maison de le chat"],
        "cc": ["das haus la katze", "das haus de katze"],
        "dd": ["the house the cat", "a cat de house la"],
    }
    rows = [(k * 10 + i, t, lang, "s", len(t)) for k, (lang, some) in enumerate(texts.items()) for i, t in enumerate(some)]
    short = ["la", "de", "xyzzy", "Ω", "日本", "q 1", "la de", "a"]
    rows += [(100 + i, t, None, "s", len(t)) for i, t in enumerate(short)]
    rows += [(200, "123", "aa", "s", 3), (201, "", "bb", "s", 0), (202, None, "cc", "s", 0), (203, "?! .", None, "s", 4)]
    got = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows if r[0] < 200)
    assert {r.lang for r in got} <= set(texts)
    right = {r[0]: r[2] for r in rows if r[0] < 100}
    assert all(r.lang == right[r.doc_id] for r in got if r.doc_id in right)


def test_run_equals_its_stages(spark, prose, tmpdir_run):
    spark.createDataFrame(documents(prose), SCHEMA).write.parquet(f"{tmpdir_run}/documents.parquet")
    docs = spark.read.parquet(f"{tmpdir_run}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tmpdir_run)
    facts = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(map(repr, docs.select(*facts).collect())) == sorted(map(repr, corpus_pipeline.run(spark, tmpdir_run).select(*facts).collect()))


def test_empty_documents(spark, tmpdir_run):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmpdir_run}/documents.parquet")
    assert corpus_pipeline.run(spark, tmpdir_run).collect() == []
