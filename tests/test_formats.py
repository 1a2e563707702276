"""Text format readers and writers (SRC-1..8, SNK-1, SNK-2)."""

import os

from relmod.sources import textfiles as TF


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_queries_header_and_last_wins(spark, tmpdir_run):
    p = f"{tmpdir_run}/q.tsv"
    _write(p, "[query_id]\ttext\n1\tfirst\n2\tother\n1\tsecond\nbad line\n")
    rows = {r.qid: r.text for r in TF.read_queries(spark, p).collect()}
    assert rows == {"1": "second", "2": "other"}


def test_collection_rules(spark, tmpdir_run):
    p = f"{tmpdir_run}/docs.tsv"
    _write(p, "D1\tu\tt\told\nD1\tu\tt\tnew\nD2\tu\tt\t\nD3\tu\tt\tb\tx\n  D4\tu\tt\tbody  \n")
    rows = {r.doc_id: r.body for r in TF.read_collection(spark, p).collect()}
    assert rows == {"D1": "new", "D4": "body"}


def test_candidates_order(spark, tmpdir_run):
    p = f"{tmpdir_run}/top.tsv"
    _write(p, "[query_id]\tdoc\tscore\n1\tB\t-1.5\n1\tA\t-2\n2\tC\t0\n1\tB\t-3\n")
    rows = sorted((r.qid, r.pos, r.doc_id, r.score) for r in TF.read_candidates(spark, p).collect())
    assert rows == [("1", 1, "B", -1.5), ("1", 2, "A", -2.0), ("1", 3, "B", -3.0), ("2", 1, "C", 0.0)]


def test_qrels_and_run(spark, tmpdir_run):
    q = f"{tmpdir_run}/qrels.tsv"
    _write(q, "[query_id] doc rel run\n12 D7 2 0\n\n12 D7 1 0\n12 D8 0 0\n")
    rows = sorted((r.qid, r.doc_id, r.relevance) for r in TF.read_qrels(spark, q).collect())
    assert rows == [(12, "D7", 1), (12, "D8", 0)]
    r = f"{tmpdir_run}/run"
    _write(r, "12 Q0 D7 1 0.8312 runid1\n12 Q0 D9 1 0.5 runid1\n12 Q0 D8 3 0.1 runid1\n")
    rows = sorted((x.qid, x.rank, x.doc_id) for x in TF.read_run(spark, r).collect())
    assert rows == [(12, 1, "D9"), (12, 3, "D8")]


def test_embeddings(spark, tmpdir_run):
    g = f"{tmpdir_run}/glove.txt"
    _write(g, "a 1 2\nb 3 4\na 5 6\n")
    rows = {r.term: r.vec for r in TF.read_embeddings(spark, g, "glove").collect()}
    assert rows == {"a": [5.0, 6.0], "b": [3.0, 4.0]}
    w = f"{tmpdir_run}/w2v.txt"
    _write(w, "3 2\na 1 2\nb 3 4\na 5 6\n")
    rows = {r.term: r.vec for r in TF.read_embeddings(spark, w, "word2vec").collect()}
    assert rows == {"a": [1.0, 2.0], "b": [3.0, 4.0]}


def test_run_and_expansion_lines(spark):
    run = spark.createDataFrame([(12, "D7", 1, 0.83125)], "qid long, doc_id string, rank int, score double")
    assert TF.run_lines(run).first()["line"] == "12 Q0 D7 1 0.8313 runid1"
    ex = spark.createDataFrame([(12, 2, "far"), (12, 1, "miles"), (12, 3, "distance")], "qid long, rk int, term string")
    assert TF.expansion_lines(ex).first()["line"] == "12: miles, far, distance"


def test_write_run_roundtrip(spark, tmpdir_run):
    run = spark.createDataFrame([(1, "A", 2, 0.5), (1, "B", 1, 0.9), (2, "C", 1, 0.1)], "qid long, doc_id string, rank int, score double")
    TF.write_run(run, f"{tmpdir_run}/out")
    back = sorted((r.qid, r.rank, r.doc_id) for r in TF.read_run(spark, f"{tmpdir_run}/out").collect())
    assert back == [(1, 1, "B"), (1, 2, "A"), (2, 1, "C")]


def test_crlf_and_header_anywhere(spark, tmpdir_run):
    p = f"{tmpdir_run}/q_crlf.tsv"
    _write(p, "1\tone\r\n[query_id]\ttext\r\n2\ttwo\r\n")
    rows = {r.qid: r.text for r in TF.read_queries(spark, p).collect()}
    assert rows == {"1": "one", "2": "two"}


def test_qrels_tabs_and_spaces(spark, tmpdir_run):
    p = f"{tmpdir_run}/qrels_ws.tsv"
    _write(p, "7\tD1\t1\t0\n7  D2   2 0\n   \n")
    rows = sorted((r.qid, r.doc_id, r.relevance) for r in TF.read_qrels(spark, p).collect())
    assert rows == [(7, "D1", 1), (7, "D2", 2)]


def test_trec_column_order(spark, tmpdir_run):
    p = f"{tmpdir_run}/qrels_trec.tsv"
    _write(p, "7 0 D1 2\n")
    rows = TF.read_qrels(spark, p, columns=("qid", "run", "doc_id", "relevance")).collect()
    assert [(r.qid, r.doc_id, r.relevance) for r in rows] == [(7, "D1", 2)]


def test_candidates_scoring_mode(spark, tmpdir_run):
    p = f"{tmpdir_run}/top_ws.tsv"
    _write(p, "[query_id] doc score\n3 A 1.5\n\n3 B 2\n3 A 0.5\n")
    rows = sorted((r.qid, r.pos, r.doc_id) for r in TF.read_candidates(spark, p, scoring=True).collect())
    assert rows == [(3, 1, "A"), (3, 2, "B"), (3, 3, "A")]


def test_word2vec_header_once_in_a_split_table(spark, tmpdir_run):
    d = f"{tmpdir_run}/w2v_dir"
    _write(f"{d}/part-0.txt", "4 2\na 1 2\n7 3 4\n")
    _write(f"{d}/part-1.txt", "c 5 6\nd 7 8\n")
    rows = {r.term: r.vec for r in TF.read_embeddings(spark, d, "word2vec").collect()}
    assert rows == {"a": [1.0, 2.0], "7": [3.0, 4.0], "c": [5.0, 6.0], "d": [7.0, 8.0]}


def test_word2vec_of_one_dimension(spark, tmpdir_run):
    p = f"{tmpdir_run}/w2v_1d.txt"
    _write(p, "2 1\n5 3\n6 4\n")
    assert {r.term: r.vec for r in TF.read_embeddings(spark, p, "word2vec").collect()} == {"5": [3.0], "6": [4.0]}


def test_word2vec_without_header_and_in_single_precision(spark, tmpdir_run):
    p = f"{tmpdir_run}/w2v_plain.txt"
    _write(p, "a 0.1 2\nb 3 4\n")
    df = TF.read_embeddings(spark, p, "word2vec")
    assert df.schema["vec"].dataType.elementType.simpleString() == "float"
    assert df.count() == 2


def test_strict_readers_name_the_malformed_line(spark, tmpdir_run):
    import pytest

    p = f"{tmpdir_run}/bad.tsv"
    _write(p, "1\tone\n\n[query_id]\tx\ty\n2\ttwo\tthree\n")
    assert TF.read_queries(spark, p).count() == 1
    assert [tuple(r) for r in TF.malformed_lines(spark, p, "queries").collect()] == [("2\ttwo\tthree", 3)]
    with pytest.raises(ValueError, match="two"):
        TF.read_queries(spark, p, strict=True)
