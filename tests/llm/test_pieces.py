import itertools
import random
import zlib

import pytest

from relmod.llm import pieces

pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, rank string, score int, ids string"


@pytest.fixture(scope="module")
def lattice():
    return pieces.Lattice(PATH)


def every_way(lattice, word):
    """All segmentations, sorted: (-score, ids from the end, ids)."""
    edges, out = lattice.edges_to(word), []

    def walk(j, ids, starts, score):
        if not j:
            out.append((-score, tuple(ids), lattice._spelled(word, list(zip(ids[::-1], starts[::-1], strict=True)))))
        for i, piece, s in edges[j]:
            walk(i, [*ids, piece], [*starts, i], score + s)

    walk(len(word), [], [], 0.0)
    return sorted(out)


def best_texts(lattice, text, n):
    """The n best segmentations of a text, out of all of its words' ones."""
    ways = [list(enumerate(every_way(lattice, w)[:n])) for w in lattice.words_of(text)]
    if not ways:
        return [(0.0, b"")]
    mixed = (
        (sum(x[1][0] for x in pick), tuple(x[0] for x in pick)[::-1], b"".join(x[1][2] for x in pick)) for pick in itertools.product(*ways)
    )
    return [(-total, ids) for total, _, ids in sorted(mixed)[:n]]


LETTERS = list("▁abetinghosr.,\néß日①")


def test_search_and_batches_against_all_segmentations(lattice):
    r = random.Random(0)
    words = ["".join(r.choice(LETTERS) for _ in range(r.randint(1, 9))) for _ in range(400)]
    low = len(lattice.count)
    row = {w: low + i for i, w in enumerate(lattice.learn(list(set(words))))}
    for w in words:
        all_ways = every_way(lattice, w)
        assert lattice.search(w, 5) == [(-s, ids) for s, _, ids in all_ways[:5]]
        k = row[w]
        gap = all_ways[1][0] - all_ways[0][0] if len(all_ways) > 1 else float("inf")
        ids = lattice.pool[lattice.start[k] : lattice.start[k] + lattice.count[k]].tobytes()
        assert (ids, lattice.score[k], lattice.gap[k]) == (all_ways[0][2], -all_ways[0][0], gap)


def test_texts_against_all_segmentations(lattice):
    r = random.Random(1)
    for _ in range(120):
        t = " ".join("".join(r.choice(LETTERS[1:]) for _ in range(r.randint(0, 4))) for _ in range(r.randint(1, 4)))
        assert "".join(lattice.words_of(t)) == lattice.model.normalize(t)
        for n in (1, 2, 4, 6):
            got = list(lattice.encode([t], n))[0]
            assert got == best_texts(lattice, t, n)
            assert all(lattice.decode(ids) == t.encode() for _, ids in got)


def test_hard_rows(spark, lattice, prose):
    rows = [
        (1, None), (2, ""), (3, " "), (4, "a"), (5, "two  spaces\nand\tmore"), (6, "①②"), (7, "\0 zero"), (8, prose(1, 4000)),
        (9, "x" * 3000), (None, "no key"), (10, "twice"), (10, "twice"), (11, "ends "),
    ]
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)
    out = pieces.encode_nbest(df, PATH, 3, check=True)
    got = out.collect()
    by = {}
    for r in got:
        assert r.exact and r.ids_crc32 == zlib.crc32(r.ids) and r.n_pieces * 4 == len(r.ids)
        by.setdefault(r.doc_id, []).append((r["rank"], r.score, r.ids))
    assert sorted(by, key=repr) == sorted({r[0] for r in rows}, key=repr)
    for doc_id, text in rows:
        if doc_id in (4, 5, 6, 7, 11):
            assert [x[1:] for x in sorted(by[doc_id])] == best_texts(lattice, text, 3)
        scores = [s for _, s, _ in sorted(by[doc_id])]
        assert scores == sorted(scores, reverse=True)
    assert by[1] == by[2] == [(1, 0.0, b"")]
    back = {(r.doc_id, r.text) for r in pieces.decode(out.filter("rank = 1"), PATH).collect()}
    assert back == {(i, t or "") for i, t in rows}


def test_empty_table(spark):
    assert pieces.encode_nbest(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    assert pieces.decode(spark.createDataFrame([], "doc_id long, ids binary"), PATH).collect() == []
