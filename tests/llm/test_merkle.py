import hashlib
import random

import pytest
from pyspark.sql import functions as F

from relmod.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int, index string, place long"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(leaves):
    """All levels of a tree, by the plain definition."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        low = i - i % 8
        out += nodes[low:i] + nodes[i + 1 : low + 8]
        i //= 8
    return out


def refold(levels, i, digest):
    for nodes in levels[:-1]:
        run = nodes[i - i % 8 : i - i % 8 + 8]
        run[i % 8] = digest
        digest, i = h(*run), i // 8
    return digest


def leaf_of(row, text):
    fields = [None if v is None else str(v) for v in (*row[:4], text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def plain(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, leaf_of(r, r[4])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = [levels_of([leaf for _, leaf in groups[g]]) for g in order]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(order):
        for i, (r, leaf) in enumerate(groups[g]):
            other = leaf_of(r, lower(r[4]) if r[4] is not None and r[0] is not None and r[0] % 3 == 0 else r[4])
            folded = refold(top, k, refold(trees[k], i, other))
            proof = h(*path_of(trees[k], i), *path_of(top, k))
            out.append((r[0], leaf, trees[k][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def lowered():
    return {"text": F.when(F.col("doc_id") % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))}


def small_blocks(monkeypatch, levels):
    monkeypatch.setattr(M, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(M, "BLOCK_BITS", 3 * levels)
    monkeypatch.setattr(M, "BLOCK", 8**levels)


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 513, 600, 4097])
def test_positions_are_those_of_the_postorder(leaves):
    want = []

    def visit(level, index):
        if level:
            for child in range(8 * index, min(8 * index + 8, M.nodes_at(level - 1, leaves))):
                visit(level - 1, child)
        want.append((level, index))

    visit(M.height(leaves), 0)
    assert [M.position(level, i, leaves) for level, i in want] == list(range(len(want)))
    assert M.subtree_size(M.height(leaves), leaves) == len(want)
    # the log is written in this very order
    digests = [h(str(i)).encode() for i in range(leaves)]
    log, levels = M.append_log(digests, M.height(leaves)), levels_of([d.decode() for d in digests])
    assert [log[64 * k : 64 * k + 64].decode() for k in range(len(want))] == [levels[a][b] for a, b in want]


def test_hard_rows(spark, prose):
    rows = [
        (1, "s", "en", 3, "ABC"), (2, None, "en", 0, ""), (3, "s", None, None, None), (3, "s", "en", 3, "Abc"), (6, "é", "é", 1, "É"),
        (None, "s", "en", 1, "A"), (9, "s", "en", 40_000, prose(3, 40_000).upper()), (12, "", "", 1, "X"), (12, "", "", 1, "X"), (15, "s", None, 1, "q"),
    ]
    rows += [(100 + i, "s", "en", 1, "T" * (i % 3)) for i in range(75)]
    df = spark.createDataFrame([(*r, "clash", 1, "clash", 5) for r in rows], SCHEMA)
    got = M.proofs(M.build(df, COLUMNS, altered=lowered()))
    assert got.columns == ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]
    out = got.collect()
    assert sorted((tuple(r)[:7] for r in out), key=repr) == sorted(plain(rows), key=repr)
    assert all(h(r.proof) == r.proof_sha256 for r in out)
    assert {r.verified for r in out} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_many_tiers(spark, monkeypatch, levels):
    small_blocks(monkeypatch, levels)
    r = random.Random(levels)
    langs = [None, "a", "b", *[f"l{i}" for i in range(12)]]
    rows = [(i, None, "hot" if r.random() < 0.6 else r.choice(langs), i, f"Text {i}") for i in range(700)]
    df = spark.createDataFrame([(*x, "", 1, "", 5) for x in rows], SCHEMA)
    manifest = M.build(df, COLUMNS, altered=lowered())
    out = M.proofs(manifest, with_proof=False).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(plain(rows), key=repr)
    # every tree's log holds each position once, and ends with its last node
    entries, trees = {}, {t.tree: t for t in manifest.trees.collect()}
    for e in M.log_entries(manifest).collect():
        entries.setdefault(e.tree, {})[e.position] = e
    for tree, t in trees.items():
        size = M.subtree_size(M.height(t.leaves), t.leaves)
        assert sorted(entries[tree]) == list(range(size)) and entries[tree][size - 1].digest == t.subroot
    assert max(entries[-1].items())[1].digest == next(iter(trees.values())).root


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(7, "s", "en", 1, "T", "", 1, "", 5)], SCHEMA)
    r = M.proofs(M.build(one, COLUMNS)).first()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof == "" and r.verified
    assert M.proofs(M.build(spark.createDataFrame([], SCHEMA), COLUMNS)).collect() == []
