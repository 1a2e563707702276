import random

import pytest

from relmod.llm import token_counts as C

sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_tokens string, n_bytes int"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_whole_tokens_stay_whole_inside_texts(model):
    # a run of marks belongs to the word after it, so it is a word only at a text's end
    whole = sorted(w for w in C.whole_tokens(model) if w.strip(C.MARK))
    assert len(whole) > 10_000
    assert len(model.encode(" ".join(whole))) == len(whole)
    r = random.Random(0)
    for _ in range(200):
        some = [r.choice(whole) for _ in range(30)]
        assert len(model.encode("qzxv " + " ".join(some) + " qzxv")) == 30 + 2 * len(model.encode("qzxv"))


def test_random_texts_against_the_library(model):
    counts, r = C.WordCounts(PATH), random.Random(1)
    letters = list("abetinghosr.,\n\t éß日①▁😀\0") + [" the", "  ", "<s>", "</s>", "<0x0A>", "<unk>", "\r\n", "▁▁", "  "]
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert counts.of(text) == len(model.encode(text)), repr(text)


def test_few_kept_words_change_nothing(model, prose, monkeypatch):
    monkeypatch.setattr(C, "KEPT_WORDS", 3)
    counts = C.WordCounts(PATH)
    for seed in range(5):
        assert counts.of(prose(seed, 300)) == len(model.encode(prose(seed, 300)))
    assert len(counts) == counts.most


def test_hard_rows(spark, model, prose):
    rows = [
        (1, None), (2, ""), (3, " "), (4, "a"), (5, "two  spaces\nand\tmore"), (6, "①②"), (7, "\0 zero"), (8, prose(1, 30_000)),
        (9, "x" * 200_000), (None, "no key"), (10, "twice"), (10, "twice"), (11, "ends "), (12, "日本" * 20_000),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = C.count_tokens(df, PATH, 4096).collect()
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    exact = len(model.encode(rows[4][1]))  # a limit that is met is not passed
    assert [r.over_limit for r in C.count_tokens(df.filter("doc_id = 5"), PATH, exact).collect()] == [False]


def test_empty_table_and_other_models(spark):
    assert C.count_tokens(spark.createDataFrame([], SCHEMA), PATH, 10).collect() == []


def test_given_documents(spark, model):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    got = C.count_tokens(df, PATH, 4096).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), len(model.encode(texts[r.doc_id])))
