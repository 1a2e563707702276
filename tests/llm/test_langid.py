import random
import zlib

from relmod.llm import langid

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"
STEMS = {"aa": "abcd", "bb": "bcde", "cc": "xyzé"}


def words(r, lang, n):
    letters = STEMS[lang]
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))


def documents(n, seed=0):
    r = random.Random(seed)
    return [(i, words(r, lang, r.randint(5, 60)), lang, "clash", "clash") for i in range(n) for lang in [r.choice(sorted(STEMS))]]


def test_held_out_accuracy(spark):
    rows = documents(600)
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.train(df.filter(~langid.held_out()))
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {r[0] for r in df.filter(langid.held_out()).select("doc_id").collect()} == {r[0] for r in held}
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_only_text_decides(spark):
    df = spark.createDataFrame(documents(200), SCHEMA)
    model = langid.train(df)
    one = [r[0] for r in langid.predict(df.orderBy("doc_id"), model, keep=["text"]).select("lang_pred").collect()]
    other = spark.createDataFrame([(None, t, None, None, None) for _, t, *_ in documents(200)], SCHEMA)
    assert one == [r[0] for r in langid.predict(other, model, keep=["text"]).select("lang_pred").collect()]


def test_counts_are_those_of_all_rows(spark):
    rows = [*documents(80), (1, None, "aa", "", ""), (2, "text", None, "", ""), (3, "12 ²", "aa", "", "")]
    want = {}
    for _, text, lang, *_ in rows:
        for w in langid.words_of(text or "") if lang else []:
            want[lang, w] = want.get((lang, w), 0) + 1
    got = langid.word_counts(spark.createDataFrame(rows, SCHEMA), "lang", "text").collect()
    assert {(r.lang, r.feature): r.n for r in got} == want


def test_backoff_by_hand(spark):
    df = spark.createDataFrame([(1, "abc abc", "x", "", ""), (2, "abd zz", "y", "", "")], SCHEMA)
    m = langid.train(df)
    assert set(m.words) == {"abc", "abd", "zz"}
    # an unseen word: the longest size with a known n-gram alone, the mean of its known ones
    known = [m.grams[g] for g in ("_abc", "abc_") if g in m.grams]
    assert (m.word_scores("qabc") == m.scores[[m.grams["abc_"]]].mean(axis=0)).all()
    assert (m.word_scores("abcq") == m.scores[[m.grams["_abc"]]].mean(axis=0)).all() and len(known) == 2
    assert m.word_scores("éé") is None
    assert m.predict("abc")[0] == "x" and m.predict("zz")[0] == "y"


def test_hard_rows(spark):
    rows = [(1, "abab", "aa", "", ""), (1, "abab", "aa", "", ""), (2, "bcde", "bb", "", ""), (3, None, "bb", None, None), (4, "", None, None, None)]
    rows += [(5, "12 ... ²½", "aa", "", ""), (6, "日本語", None, "", ""), (None, "abab " * 100_000, None, "", ""), (7, "ab²", None, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.predict(df, langid.train(df)).collect()), key=repr)
    by = {r[0]: r[1:] for r in got}
    assert len(got) == len(rows)
    assert by[3] == by[4] == by[5] == ("und", 0.0)
    assert by[6] == ("aa", 0.5) and by[None][0] == "aa" and by[7][0] == "aa"


def test_nothing_learned_and_empty_table(spark):
    df = spark.createDataFrame([(1, "words", None, "", "")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.predict(df, langid.train(df)).collect()] == [("und", 0.0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.predict(empty, langid.train(empty)).collect() == []


def test_a_bounded_model_still_backs_off(spark, monkeypatch):
    monkeypatch.setattr(langid, "WORDS", 10)
    df = spark.createDataFrame(documents(300), SCHEMA)
    m = langid.train(df)
    assert len(m.words) <= 10
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, m).collect()}
    assert sum(got[r[0]] == r[2] for r in documents(300)) > 270


def test_features_out_of_memory_count_alike(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, words(r, lang, 8), lang, "", "") for i in range(400) for lang in ["aa" if i % 20 else "cc"]]  # one in twenty
    asked = rows[:60] + [(900, "xyzé", "", "", ""), (901, "qqq", "", "", ""), (902, None, "", "", ""), (903, "12", "", "", ""), (904, "zzxq é", "", "", "")]
    df, ask = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(asked + asked[:3], SCHEMA)
    whole = langid.train(df)
    want = sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.predict(ask, whole).collect())
    for most, grams in ((10, 30_000), (100_000, 3), (5, 2), (0, 0)):
        monkeypatch.setattr(langid, "WORDS", most)
        monkeypatch.setattr(langid, "GRAMS", grams)
        m = langid.train(df)
        assert len(m.words) + len(m.grams) < len(whole.words) + len(whole.grams)
        assert sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.predict(ask, m).collect()) == want
