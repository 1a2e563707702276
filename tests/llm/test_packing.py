import os
import random
import zlib
from array import array

import pytest

from relmod.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length string, block int, offset int"


def test_words_give_the_tokenizers_ids():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = tokenizers.Tokenizer.from_file(PATH)
    encode = packing.Encoder(PATH)
    r = random.Random(1)
    bits = [" ", "  ", "\n", "\t", " \n", "\r", " ", " ", "a", "B", "é", "1", "23", "'s", "'ll", ".", ",", "!?", "a.", "b,", "é!", "ź."]
    bits += ["日.", "A?", "1.", "<|endoftext|>", "\0", "ß", "日本", "\x85", "\x1c", "​", "👍"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(20_000)]
    want = [array("I", t.encode(x, add_special_tokens=False).ids).tobytes() for x in texts]
    texts = [x.encode() for x in texts]
    assert encode(texts) == want
    assert encode(texts[::-1]) == want[::-1]
    assert encode([]) == [] and encode([b"", b""]) == [b"", b""]


def test_long_texts_in_portions(monkeypatch, prose):
    from relmod.llm import words

    t = tokenizers.Tokenizer.from_file(PATH)
    texts = [prose(1, 900), "no_spaces" * 300, " ".join("é à ü" for _ in range(300)), "  \n  " * 200 + "end", prose(2, 30), "", prose(3, 5)]
    want = [array("I", t.encode(x, add_special_tokens=False).ids).tobytes() for x in texts]
    monkeypatch.setattr(packing, "BYTES_AT_ONCE", 300)
    monkeypatch.setattr(words, "BLOCK", 64)
    assert packing.Encoder(PATH)([x.encode() for x in texts]) == want
    assert all(b"".join(packing.portions(x.encode(), 100)) == x.encode() for x in texts)


def test_words_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 40)
    t = tokenizers.Tokenizer.from_file(PATH)
    encode = packing.Encoder(PATH)
    for i in range(30):
        texts = [f"word{j} and w{j}x, common text." for j in range(i, i + 9)] + ["common text."]
        assert encode([x.encode() for x in texts]) == [array("I", t.encode(x, add_special_tokens=False).ids).tobytes() for x in texts]


def test_words_with_other_endings_are_learned_once():
    t = tokenizers.Tokenizer.from_file(PATH)
    encode = packing.Encoder(PATH)
    ends = ["###", ").", "'s", "'s,", "123", "\n", "\nNext", "...\nNext", "é", "é$$$", "×", "×."]
    texts = [f"The w{chr(97 + i)}rd{e} ends" for i in range(20) for e in ends]
    assert encode([x.encode() for x in texts]) == [array("I", t.encode(x, add_special_tokens=False).ids).tobytes() for x in texts]
    assert len(encode.count) < 100  # of 240 between spaces


def test_cuts_at_letters_give_the_tokenizers_ids():
    t = tokenizers.Tokenizer.from_file(PATH)
    r = random.Random(3)
    bits = [" ", " ", " ", "\n", "\n\n", "\t", "a", "B", "é", "É", "×", "÷", "ȿ", "ɏ", "'s", "'", "7", "$$$", "x\ny", "\xa0", "\u0301", "²"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(5_000)]
    texts += ["so<|endoftext|>it is<|endoftext|>", "a<|endoftext", "b|> c<|endoftext|>"]
    want = [array("I", t.encode(x, add_special_tokens=False).ids).tobytes() for x in texts]
    encode = packing.Encoder(PATH)
    some = [encode([x.encode() for x in texts[i : i + 50]]) for i in range(0, len(texts), 50)]
    assert sum(some, []) == want
    encode = packing.Encoder(PATH)
    encode.bytes_of = encode.bytes_of + 1  # words that are not told apart are encoded one by one
    assert encode([x.encode() for x in texts]) == want


def check(spark, rows, size):
    t = tokenizers.Tokenizer.from_file(PATH)
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), PATH, size=size, with_ids=True).collect()
    tokens = sorted(t.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows)
    by_sequence, by_doc = {}, {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, list(array("I", r.ids)), r.doc_tokens))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    ids = [r[0] for r in rows]
    for doc_id, parts in by_doc.items():
        if ids.count(doc_id) == 1:
            parts.sort()
            assert [p[0] for p in parts] == [sum(len(q[1]) for q in parts[:i]) for i in range(len(parts))]
            assert {p[2] for p in parts} == {sum(len(p[1]) for p in parts)}
            assert sum((p[1] for p in parts), []) in tokens
    assert sum(r.length for r in got) == sum(map(len, tokens))
    return got


def test_hard_rows(spark, prose):
    c = ("clash", 1, 1)
    rows = [(i, prose(i, i % 40), *c) for i in range(200)]
    rows += [(300, None, *c), (301, "", *c), (302, prose(9, 30_000), *c), (None, "no key", *c), (303, "twice", *c), (303, "twice", *c), (304, "x" * 700 + " é" * 300 + " " + "ü!" * 400, *c)]
    check(spark, rows, 64)
    check(spark, rows, 2048)


def test_padding_is_little(spark, prose):
    rows = [(i, prose(i, 5 + (i * 37) % 300), "", 1, 1) for i in range(1500)]
    got = check(spark, rows, 512)
    sequences = len({r.sequence_id for r in got})
    assert sum(r.length for r in got) > 0.97 * 512 * (sequences - 1)


def test_histogram_places_every_piece_once():
    r = random.Random(2)
    histogram = {r.randint(1, 100): r.randint(1, 1000) for _ in range(60)}
    places = packing.pack_histogram(histogram, 100)
    filled = {}
    for length, n in histogram.items():
        ranks = sorted((low, low + k) for x, low, k, _, _ in places if x == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == n and all(a[1] == b[0] for a, b in zip(ranks, ranks[1:], strict=False))
    for length, _, k, first, offset in places:
        for s in range(first, first + k):
            filled.setdefault(s, []).append((offset, length))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(x for _, x in parts[:i]) for i in range(len(parts))]
        assert sum(x for _, x in parts) <= 100


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []
