"""Packing documents into sequences, shortest pack first, over the length histogram.

Documents are encoded and cut into pieces no longer than a sequence. Only the
histogram of the pieces' lengths (at most as many rows as a sequence has
tokens) comes to the driver, which places lengths, longest first, into the
shortest pack, for all packs of the same filling at once. The packing patterns
are then joined back: the r-th piece of a length takes the r-th place that the
patterns have for that length.
"""

from __future__ import annotations

import heapq
import os
import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.llm.common import give_back, kept_in_worker, stored
from relmod.llm.words import LONGEST_WORD, ByteHashes, WordTable, gather
from relmod.session import broadcast_if_small

SEQUENCE = 2048
#: Counts per length and block of up to so many bytes are broadcast.
BROADCAST_BYTES = 32 << 20
END_ID = 1

NUMBERS = ("start", "length", "ids_crc32", "doc_tokens", "block", "place")
DOCS_AT_ONCE = 250
BYTES_AT_ONCE = 4 << 20


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Places (length, first rank, count, first sequence, offset) for ``histogram``'s pieces.

    Lengths go longest first, each into the pack with the most room, or into
    new packs. Packs of equal filling are one group with consecutive sequence
    numbers, so the work depends on the number of lengths, not of pieces.
    """
    places: list[tuple[int, int, int, int, int]] = []
    groups: list[tuple[int, int, int]] = []  # (-room, first sequence, count)
    sequences = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if groups and -groups[0][0] >= length:
                room, first, count = heapq.heappop(groups)
                room, n = -room, min(left, count)
                if n < count:
                    heapq.heappush(groups, (-room, first + n, count - n))
            else:
                room, first, n = size, sequences, left
                sequences += n
            places.append((length, rank, n, first, size - room))
            if room > length:
                heapq.heappush(groups, (length - room, first, n))
            rank, left = rank + n, left - n
    return places


#: Words that go to the tokenizer as one text.
WORDS_AT_ONCE = 100
#: Words whose ids a Python worker keeps, for all its tasks of one call; about 40 bytes each.
KNOWN_WORDS = 1_500_000


def portions(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts of about ``size`` bytes, cut at spaces after a visible ASCII character, where words start."""
    low = 0
    while low < len(text):
        high = low + size
        while (high := text.find(b" ", high)) >= 0 and not 0x20 < text[high - 1] < 0x7F:
            high += 1
        high = len(text) if high < 0 else high
        yield text[low:high]
        low = high


class Encoder:
    """Texts to ids with the tokenizer of a file.

    Byte-level BPE starts anew at a space that follows a character other than
    white space, where a run of letters ends, and after a line feed that stands
    alone, so a text is its words, cut there, each with the space before it,
    and distinct words are encoded once. Words are told by 64-bit hashes of their
    bytes, computed for a whole batch at once from running sums. Texts with odd
    spaces (between white space, or after one at the end) and long words go to
    the tokenizer as they are; texts with an added token are cut at spaces only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.hashes = ByteHashes()
        white = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20]
        # last and first bytes of white space, in UTF-8; other characters may share them
        self.before, self.after = np.zeros(256, bool), np.zeros(256, bool)
        self.before[[*white, *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
        self.after[[*white, 0xC2, 0xE1, 0xE2, 0xE3]] = True
        code = np.arange(256)
        self.letter = (code >= 0x41) & (code <= 0x5A) | (code >= 0x61) & (code <= 0x7A)
        self.visible = (code > 0x20) & (code < 0x7F)
        self.other = (code < 0x80) & (code != 0x20) & ~self.letter
        # first bytes of U+00C0 to U+023F, letters but for the signs of multiplication and division
        self.latin = (code >= 0xC3) & (code <= 0xC8)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = [t.encode() for t in added.values()]
        # a token of the vocabulary has one character for each of its bytes
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        sizes = {**{i: len(t) for t, i in vocabulary.items()}, **{i: len(t.encode()) for i, t in added.items()}}
        self.bytes_of = np.zeros(max(sizes) + 1, np.int64)
        self.bytes_of[list(sizes)] = list(sizes.values())

    def _forget(self) -> None:
        self.table = WordTable()
        self.start, self.count, self.pool = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts and ids of texts, encoded one by one."""
        counts, ids = [], []
        for i in range(0, len(texts), 10_000):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + 10_000], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        return np.concatenate([np.empty(0, np.int64), *counts]), np.concatenate([np.empty(0, np.uint32), *ids])

    def _word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words; those that start with a space are encoded many at once and told apart by their tokens' bytes."""
        spaced = np.fromiter((w[:1] == b" " and len(w) > 1 and not self.after[w[1]] for w in words), bool, len(words))
        first, rest = np.flatnonzero(spaced), np.flatnonzero(~spaced)
        joined = [words[i] for i in first.tolist()]
        _, ids = self._ids([b"".join(joined[i : i + WORDS_AT_ONCE]).decode() for i in range(0, len(joined), WORDS_AT_ONCE)])
        ends, upto = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined))), np.cumsum(self.bytes_of[ids])
        at = np.searchsorted(upto, ends)
        if len(ends) and (len(upto) == 0 or upto[-1] != ends[-1] or (upto[at] != ends).any()):  # not told apart
            return self._ids([w.decode() for w in words])
        rest_counts, rest_ids = self._ids([words[i].decode() for i in rest.tolist()])
        counts = np.empty(len(words), np.int64)
        counts[first], counts[rest] = np.diff(at, prepend=-1), rest_counts
        starts = np.empty(len(words), np.int64)
        for some, before in ((first, 0), (rest, len(ids))):
            starts[some] = before + np.cumsum(counts[some]) - counts[some]
        return counts, gather(np.concatenate([ids, rest_ids]), starts, counts)

    def _cuts(self, raw: bytes, data: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Where words start without a space, in texts that are not taken whole and hold no added token."""
        letter = self.letter[data]
        before = letter.copy()
        before[1:] |= self.latin[data[:-1]]
        cuts = np.flatnonzero(before[:-1] & self.other[data[1:]]) + 1
        sign = (data[cuts - 2] == 0xC3) & ((data[cuts - 1] == 0x97) | (data[cuts - 1] == 0xB7))
        feeds = np.flatnonzero(data[1:-1] == 0x0A) + 1
        feeds = feeds[self.visible[data[feeds - 1]] & letter[feeds + 1]] + 1
        cuts = np.concatenate([cuts[~sign], feeds])
        apart = whole.copy()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                apart[np.searchsorted(ends, at, "right")] = True
                at = raw.find(token, at + 1)
        return cuts[~apart[np.searchsorted(ends, cuts, "right")]] if apart.any() else cuts

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of UTF-8 texts as little-endian uint32; a few megabytes of text at a time."""
        out: list[bytes] = []
        some, size = [], 0
        for t in texts:
            if some and size + len(t) > BYTES_AT_ONCE:
                out += self._encode(some)
                some, size = [], 0
            if len(t) > BYTES_AT_ONCE:
                out.append(b"".join(self._encode([part])[0] for part in portions(t, BYTES_AT_ONCE)))
            else:
                some.append(t)
                size += len(t)
        return out + self._encode(some)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        begins = ends - sizes
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        spaces = np.flatnonzero(data == 0x20)
        text_of = np.searchsorted(ends, spaces, "right")
        inside = spaces > begins[text_of]
        last = spaces + 1 == ends[text_of]
        odd = inside & self.before[data[spaces - 1]] & (last | self.after[data[np.minimum(spaces + 1, len(data) - 1)]])
        whole = np.zeros(len(texts), bool)
        whole[text_of[odd]] = True
        starts = np.sort(np.concatenate([begins[sizes > 0], spaces[inside & ~whole[text_of]], self._cuts(raw, data, ends, whole)]))
        starts = starts[np.append(True, starts[1:] != starts[:-1])] if len(starts) else starts
        lengths = np.diff(np.append(starts, len(data)))
        keys = self.hashes.of(data, starts, lengths)
        rows = self.table.find(keys)
        long = lengths > LONGEST_WORD
        new, at = np.unique(keys[(rows < 0) & ~long], return_index=True)
        if len(new):
            if len(self.count) > KNOWN_WORDS:
                self._forget()
                new, at = np.unique(keys[~long], return_index=True)
                where = np.flatnonzero(~long)[at]
            else:
                where = np.flatnonzero((rows < 0) & ~long)[at]
            words = [raw[i : i + n] for i, n in zip(starts[where].tolist(), lengths[where].tolist(), strict=True)]
            counts, ids = self._word_ids(words)
            self.table.add(new, np.arange(len(self.count), len(self.count) + len(new), dtype=np.int32))
            self.count, self.pool = np.concatenate([self.count, counts]), np.concatenate([self.pool, ids])
            self.start = np.cumsum(self.count) - self.count
            rows = self.table.find(keys)
        rows[long] = -1
        counts = np.where(rows < 0, 0, self.count[rows] if len(self.count) else 0)
        pool, places = self.pool, np.where(rows < 0, 0, self.start[rows] if len(self.count) else 0)
        if long.any():
            some = [raw[i : i + n].decode() for i, n in zip(starts[long].tolist(), lengths[long].tolist(), strict=True)]
            long_counts, long_ids = self._ids(some)
            counts[long] = long_counts
            places[long] = len(pool) + np.cumsum(long_counts) - long_counts
            pool = np.concatenate([pool, long_ids])
        ids = memoryview(gather(pool, places, counts).astype("<u4").tobytes())
        upto = np.concatenate([[0], np.cumsum(counts)])
        cuts = (4 * upto[np.searchsorted(starts, np.append(begins, len(data)))]).tolist()
        return [bytes(ids[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def cut_documents(df: DataFrame, tokenizer: str, key: str, text: str, size: int, end_id: int, with_ids: bool) -> DataFrame:
    """The pieces of every document, in the order of the partition that holds it.

    ``block`` is that partition and ``place`` the piece's place among those of
    its length in the block.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("doc_id", kind)] + [T.StructField(n, T.LongType()) for n in NUMBERS])
    if with_ids:
        schema = schema.add("ids", T.BinaryType())
    end, call = array("I", [end_id]).tobytes(), uuid.uuid4().hex

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block, seen = kept_in_worker(call, lambda: Encoder(tokenizer)), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(low, DOCS_AT_ONCE)
                which: list[int] = []
                rows: list[tuple] = []
                parts: list[bytes] = []
                for i, ids in enumerate(encode([t or b"" for t in some.column(1).cast(pa.binary()).to_pylist()])):
                    ids += end
                    for start in range(0, len(ids), 4 * size):
                        part = ids[start : start + 4 * size]
                        n = len(part) // 4
                        which.append(i)
                        rows.append((start // 4, n, zlib.crc32(part), len(ids) // 4, block, seen[n]))
                        seen[n] += 1
                        if with_ids:
                            parts.append(part)
                columns = [some.column(0).take(pa.array(which, pa.int64()))]
                columns += [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                give_back()

    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def pack(
    df: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document's tokens are its text's ids and ``end_id``; it is cut only where
    it is longer than a sequence, into full pieces and a rest. ``start`` counts
    the document's tokens before the piece, ``offset`` the sequence's. ``ids``
    are little-endian uint32. Null and empty texts are the end id alone.
    Repeated rows are packed once each; null keys pass through. An empty table
    gives an empty result; other columns are not read.

    Ranks come from counts per length and block (with ids, broadcast up to
    ``BROADCAST_BYTES``, so that only counts are moved), so the pieces of a frequent
    length are never gathered; a sequence's pieces may be in several tasks.
    """
    spark = df.sparkSession
    pieces = stored(cut_documents(df, tokenizer, key, text, size, end_id, with_ids), "pieces")
    counts = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.select("length", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}  # at most ``size`` rows
    places = spark.createDataFrame(
        pack_histogram(histogram, size), "_length long, _low long, _count long, _sequence long, offset long"
    )
    if with_ids:  # the ids stay where they are while the counts fit the bound
        blocks = broadcast_if_small(stored(blocks, "blocks"), BROADCAST_BYTES)
    rank = F.col("place") + F.col("_before")
    placed = pieces.join(blocks, ["length", "block"]).withColumn("_rank", rank)
    # the patterns: as many rows as lengths have places, whatever the number of documents
    return placed.join(
        F.broadcast(places),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_low") + F.col("_count")),
    ).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("_sequence") + F.col("_rank") - F.col("_low")).alias("sequence_id"),
        "offset",
        *(["ids"] if with_ids else []),
    )
