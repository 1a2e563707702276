import hashlib
import re

from relmod.llm import exact_dedup

SCHEMA = "doc_id long, text string, kept string, group_size int, _hash int"


def plain(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id is None, doc_id, text))
    out = []
    for content, members in groups.items():
        keep = min(members, key=lambda m: m[:2] + (m[2] or 0,))[2]
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(m[2], keep, len(members), sha) for m in members]
    return sorted(out, key=repr)


def check(spark, rows):
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_hard_rows(spark):
    nbsp = "a\u00a0b"
    rows = [
        (5, "a b", "x", 1, 1),
        (3, "ab", "x", 1, 1),
        (9, "a \t\n\x0b\x0c\r b", "x", 1, 1),
        (8, "a \t\n\x0b\x0c\r b", "x", 1, 1),
        (1, None, "x", 1, 1),
        (2, "", None, None, None),
        (None, " ", "x", 1, 1),
        (None, "zz", "x", 1, 1),
        (7, nbsp, "x", 1, 1),
        (6, "AB", "x", 1, 1),
        (10, "long " * 50_000, "x", 1, 1),
        (11, "long" * 50_000, "x", 1, 1),
        (12, "same", "x", 1, 1),
        (12, "same", "x", 1, 1),
    ]
    check(spark, rows)


def test_empty_table(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_contents_are_salted_and_whole(spark):
    rows = [(i, "hot text " + " " * (i % 7) if i % 3 == 0 else f"text {i // 2}", "x", 1, 1) for i in range(3000)]
    check(spark, rows)


def test_only_long_common_heads_differ_at_the_end(spark):
    head = "x" * 300
    check(spark, [(i, head + str(i % 5), "x", 1, 1) for i in range(100)])
