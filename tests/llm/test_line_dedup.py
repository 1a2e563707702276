import random

import numpy as np

from relmod.llm import line_dedup

SCHEMA = "doc_id long, text string, n_lines string, _gone int, shard int"


def plain(rows, min_docs, min_chars):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    held = {}
    for n, (doc_id, text, *_) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                held.setdefault(k, []).append((doc_id if doc_id is not None else -(2**63), n))
    out = []
    for doc_id, text, *_ in rows:
        mine = doc_id if doc_id is not None else -(2**63)
        lines = (text or "").split("\n")
        gone = [len(held.get(key(x), ())) >= min_docs and max(held[key(x)])[0] != mine for x in lines]
        left = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((doc_id, text if not any(gone) else left, len(lines), sum(gone)))
    return sorted(out, key=repr)


def check(spark, rows, min_docs=5, min_chars=40):
    df = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, SCHEMA), min_docs=min_docs, min_chars=min_chars)
    assert df.columns == ["doc_id", "text", "_gone", "shard", "n_lines", "n_dropped"]
    got = sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)
    assert got == plain(rows, min_docs, min_chars)


def test_perfect_hash_is_minimal():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 20_000):
        hi, lo = (r.integers(-(2**63), 2**63 - 1, n, dtype=np.int64) for _ in range(2))
        levels = line_dedup.build_levels(hi, lo)
        assert sorted(line_dedup.numbers(levels, hi, lo).tolist()) == list(range(n))
    same = np.zeros(50, np.int64)  # keys that differ in one half only
    assert sorted(line_dedup.numbers(line_dedup.build_levels(same, np.arange(50)), same, np.arange(50)).tolist()) == list(range(50))


def test_hard_rows(spark):
    a, b = "This line is a passage that many documents share.", "É" * 39 + "x"
    c = (1, 1)
    rows = [(i, f"own {i}\n  {a}\t\nmore\r\n{a.upper()}\n\n{b}", "clash", *c) for i in range(6)]
    rows += [
        (50, a + "\x0b", "", *c),
        (51, a[:-1], "", *c),
        (52, None, None, None, None),
        (53, "", "", *c),
        (54, "\n\n", "", *c),
        (55, a + "\n" + "word " * 100_000, "", *c),
        (55, a, "", *c),
        (55, a, "", *c),
        (None, a + "\n" + b, "", *c),
        (None, "x\n" + a, "", *c),
        (56, " " + a, "", *c),
    ]
    check(spark, rows)
    check(spark, rows, min_docs=2, min_chars=1)


def test_hot_line_and_random_lines(spark):
    r = random.Random(5)
    lines = [f"line number {i} of a small collection of lines" for i in range(60)]
    rows = [(i, "\n".join(["hot line in every document of the table, long enough"] + r.choices(lines, k=6)), "", 1, 1) for i in range(400)]
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [])


def test_lists_of_one_key_hold_one_documents_lines(spark):
    lines = [f"line number {i} of a small collection of lines" for i in range(12)]
    rows = [(None if i % 2 else 7, "\n".join(lines[i % 9 : i % 9 + 3]), "", 1, 1) for i in range(300)]
    rows += [(9, "\n".join(lines), "", 1, 1)]
    lists = line_dedup.lists_to_drop(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", 5, 40).collect()
    assert len(lists) == 18 and all(len(r.gone) == 3 for r in lists)
    check(spark, rows)
