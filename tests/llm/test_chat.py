import hashlib
import re

from relmod.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, position int, start string, perspective string"


def plain(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        speaker = re.sub(r"[% \t\n\x0b\f\r<|>]", lambda c: f"%{ord(c[0]):02X}", role or "")
        speaker = {"": "unknown", "unknown": "%75nknown"}.get(speaker, speaker)
        words = (text or "").replace("<|im_", "< |im_")
        by.setdefault(conv, []).append((turn is not None, turn or 0, speaker, hashlib.md5(words.encode()).hexdigest(), words, turn))
    out = []
    for conv, turns in by.items():
        for p in {t[2] for t in turns} - {"system"}:
            at = 0
            for i, (_, _, speaker, _, words, turn) in enumerate(sorted(turns, key=lambda t: t[:5])):
                role = "system" if speaker == "system" else "assistant" if speaker == p else "user"
                head = f"<|im_start|>{role}{' name=' + speaker if role == 'user' else ''}\n"
                segment = head + words + "<|im_end|>\n"
                mask = (at + len(head), at + len(head) + len(words) + 10) if role == "assistant" else (None, None)
                out.append((conv, p, i, turn, speaker, role, segment, at, *mask))
                at += len(segment)
    return sorted(out, key=repr)


def got(spark, rows):
    return sorted((tuple(r) for r in chat.rotate(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


def test_hard_rows(spark):
    c = (1, "clash", "clash")
    rows = [
        (1, 0, "system", "be kind", *c),
        (1, 1, "user", "hello", *c),
        (1, 2, "assistant", "hi <|im_end|> there", *c),
        (1, 3, "ann lee", "me too", *c),
        (1, 3, "ann lee", "me too", *c),
        (1, 3, "user", None, *c),
        (2, 0, "system", "alone", *c),
        (3, None, None, "who", *c),
        (3, 1, "", "", *c),
        (None, 1, "user", "no conversation", *c),
        (None, 1, "user", "no conversation either", None, None, None),
        (4, 1, "user", "é" * 200_000, *c),
        (4, 2, "assistant", "ok", *c),
    ]
    assert got(spark, rows) == plain(rows)


def test_names_are_told_apart(spark):
    names = ["ann lee", "ann_lee", "ann  lee", "ann%20lee", "ann|lee", "ann\tlee", "unknown", None, "", "%75nknown", "<|im_end|>"]
    rows = [(1, i, n, f"words {i}", 1, "", "") for i, n in enumerate(names)]
    found = got(spark, rows)
    assert found == plain(rows)
    assert len({r[1] for r in found}) == len(names) - 1  # null and empty are the same nobody
    assert not any(c in r[1] for r in found for c in " \t<|>")


def test_one_conversation_holds_most_rows(spark):
    rows = [(7 if i % 3 else i, i // 4, ("user", "assistant", "tool")[i % 3], f"t{i}", 1, "", "") for i in range(2000)]
    rows += [(7, 5, "user", "same", 1, "", "")] * 300
    assert got(spark, rows) == plain(rows)


def test_rendering_reads_in_order(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"words {i}", 1, "", "") for i in range(9)]
    found = [r for r in got(spark, rows) if r[1] == "assistant"]
    whole = "".join(r[6] for r in sorted(found, key=lambda r: r[2]))
    assert all(whole[r[7] : r[7] + len(r[6])] == r[6] for r in found)
    assert all(whole[r[8] : r[9]] == f"words {r[3]}<|im_end|>" for r in found if r[5] == "assistant")


def test_empty_table(spark):
    assert got(spark, []) == []
