"""N-best SentencePiece encoding, and decoding.

The piece lattice of a text has an edge for every piece that it holds; a
character without a piece is an edge to its bytes. Forward Viterbi scores are
the best scores from the start to every place, so they are exact heuristics for
a search from the end backwards: A* meets segmentations best first and expands
nothing that is not on a path of its result's score.

No piece reaches over the place before a word mark that follows another
character, so a text's lattice is a chain of words' lattices. A word's forward
and backward scores give its best segmentation and the gap to its second one;
they are computed for all new words of a batch at once. Of a text's N best
segmentations, only the N - 1 words of the smallest gaps differ from their
best ones, and only these words' lattices are searched.
"""

from __future__ import annotations

import heapq
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.llm.common import give_back, kept_in_worker
from relmod.llm.words import LONGEST_WORD, ByteHashes, WordTable, gather

MARK = "▁"
_MARK = MARK.encode()
#: What an unknown character's score is below the lowest piece's.
UNKNOWN_PENALTY = 10.0
#: Words that a Python worker keeps for all its tasks of one call.
KEPT_WORDS = 1_000_000
#: Longer words are not batched by length.
BATCHED_LENGTH = 48
DOCS_AT_ONCE = 250
_BASE = np.uint64(0x100000001B3)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20


class Lattice:
    """The pieces of a model, and segmentations of words."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = model
        self.score_of = np.array([model.get_score(i) for i in range(model.get_piece_size())])
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.unknown = model.unk_id()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i):
                self.bytes_of.append(b"")
            elif model.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.bytes_of.append(piece.replace(MARK, " ").encode())
                if not model.is_unused(i):
                    self.ids[piece] = i
        self.longest = max(map(len, self.ids))
        self.unknown_score = float(min(self.score_of[i] for i in self.ids.values() if self.score_of[i] > -1e8)) - UNKNOWN_PENALTY
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        sizes = np.array([len(b) for b in self.bytes_of])
        self._sizes, self._starts = sizes, np.cumsum(sizes) - sizes
        self._all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._fill_slots()
        self.hashes = ByteHashes()
        self._forget()

    # -- pieces by the hash of their characters

    def _fill_slots(self) -> None:
        size = 1 << _SLOTS
        self._keys, self._ids, self._reach = np.zeros(size + 64, np.uint64), np.full(size + 64, -1, np.int32), 0
        for piece, i in self.ids.items():
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in piece:
                    h = (h + np.uint64(ord(c) + 1)) * _BASE
                at = int(h * _ODD >> np.uint64(64 - _SLOTS))
            start = at
            while self._ids[at] >= 0:
                if self._keys[at] == h:
                    raise ValueError(f"two pieces share a hash: {piece}")
                at += 1
            self._keys[at], self._ids[at] = h, i
            self._reach = max(self._reach, at - start)

    def _find(self, h: np.ndarray) -> np.ndarray:
        at = (h * _ODD >> np.uint64(64 - _SLOTS)).astype(np.int64)
        out = np.where(self._keys[at] == h, self._ids[at], -1)
        for d in range(1, self._reach + 1):
            more = self._keys[at + d] == h
            out = np.where(more & (out < 0), self._ids[at + d], out)
        return out

    # -- words, many at once

    def _forget(self) -> None:
        #: Known words' rows in the arrays; a row's ids are ``count`` ones of the pool from ``start`` on.
        self.table = WordTable()
        self._others: dict[tuple[str, int], list[tuple[float, bytes]]] = {}
        self._order: list[str] = []
        self._parts: dict[str, list[np.ndarray]] = {"count": [], "gap": [], "score": [], "pool": []}
        self.count, self.start = np.empty(0, np.int64), np.empty(0, np.int64)
        self.gap, self.score, self.pool = np.empty(0), np.empty(0), np.empty(0, np.uint32)

    def _add(self, words: list[str], **parts: np.ndarray) -> None:
        self._order += words
        for name, part in parts.items():
            self._parts[name].append(part)

    def learn(self, words: list[str]) -> list[str]:
        """Best segmentation, score and gap of words, in new rows; returns the words in the order of these."""
        if not words:
            return []
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, some in by_length.items():
            if length > BATCHED_LENGTH:
                for w in some:
                    self._learn_long(w)
                continue
            for i in range(0, len(some), 20_000):
                self._learn_batch(some[i : i + 20_000], length)
        for name, parts in self._parts.items():
            setattr(self, name, np.concatenate([getattr(self, name), *parts]))
            parts.clear()
        self.start = np.cumsum(self.count) - self.count
        order, self._order = self._order, []
        return order

    def _learn_batch(self, words: list[str], length: int) -> None:
        w, rows = len(words), np.arange(len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(w, length).astype(np.uint64) + np.uint64(1)
        most = min(length, self.longest)
        edges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        h = np.zeros((w, length), np.uint64)
        for size in range(1, most + 1):
            n = length - size + 1
            h = (h[:, :n] + chars[:, size - 1 :]) * _BASE
            ids = self._find(h)
            scores = np.where(ids >= 0, self.score_of[ids], -np.inf)
            if size == 1:
                scores = np.where(ids >= 0, scores, self.unknown_score)
                ids = np.where(ids >= 0, ids, self.unknown)
            for i in range(n):
                edges[i, i + size] = ids[:, i], scores[:, i]
        forward = np.full((length + 1, w), -np.inf)
        forward[0] = 0
        last, last_id = np.zeros((length + 1, w), np.int32), np.zeros((length + 1, w), np.int32)
        for j in range(1, length + 1):
            for i in range(max(0, j - most), j):
                ids, scores = edges[i, j]
                total = forward[i] + scores
                better = (total > forward[j]) | ((total == forward[j]) & (ids < last_id[j]) & (total > -np.inf))
                forward[j] = np.where(better, total, forward[j])
                last[j] = np.where(better, i, last[j])
                last_id[j] = np.where(better, ids, last_id[j])
        backward = np.full((length + 1, w), -np.inf)
        backward[length] = 0
        for i in range(length - 1, -1, -1):
            for j in range(i + 1, min(length, i + most) + 1):
                backward[i] = np.maximum(backward[i], edges[i, j][1] + backward[j])
        # the best path, from its end; on_path[i, j] holds its edges
        at, path = np.full(w, length), np.full((w, length), -1, np.int64)
        places, step = np.zeros((w, length), np.int64), 0
        on_path = np.zeros((w, length + 1), np.int32)  # by end: one more than the start
        while (at > 0).any():
            live = at > 0
            path[live, step] = last_id[at[live], rows[live]]
            start = last[at[live], rows[live]]
            on_path[rows[live], at[live]] = start + 1
            places[live, step] = start
            at[live] = start
            step += 1
        best = forward[length]
        gap = np.full(w, np.inf)
        for (i, j), (_, scores) in edges.items():
            through = best - (forward[i] + scores + backward[j])
            gap = np.minimum(gap, np.where(on_path[:, j] == i + 1, np.inf, through))
        count = (path >= 0).sum(axis=1)
        plain = ~(path == self.unknown).any(axis=1)
        forward_path = path[plain, ::-1]
        self._add(
            [words[k] for k in np.flatnonzero(plain)],
            count=count[plain],
            gap=gap[plain],
            score=best[plain],
            pool=forward_path[forward_path >= 0].astype(np.uint32),
        )
        for k in np.flatnonzero(~plain):
            edges_of = zip(path[k, : count[k]][::-1].tolist(), places[k, : count[k]][::-1].tolist(), strict=True)
            self._add_one(words[k], self._spelled(words[k], list(edges_of)), gap[k], best[k])

    def _add_one(self, word: str, ids: bytes, gap: float, score: float) -> None:
        pool = np.frombuffer(ids, np.uint32)
        self._add([word], count=np.array([len(pool)]), gap=np.array([gap]), score=np.array([score]), pool=pool)

    def _spelled(self, word: str, edges: list[tuple[int, int]]) -> bytes:
        """The ids of edges (id, start), unknown characters as their bytes."""
        out = array("I")
        for i, start in edges:
            if i == self.unknown and self.byte_ids:
                out.extend(self.byte_ids[b] for b in word[start].encode())
            else:
                out.append(i)
        return out.tobytes()

    def _learn_long(self, word: str) -> None:
        found = self.search(word, 2)
        self._add_one(word, found[0][1], found[0][0] - found[1][0] if len(found) > 1 else np.inf, found[0][0])

    # -- one word's lattice

    def edges_to(self, word: str) -> list[list[tuple[int, int, float]]]:
        """For each place, the edges (start, id, score) that end there."""
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(word) + 1)]
        for j in range(1, len(word) + 1):
            for i in range(max(0, j - self.longest), j):
                found = self.ids.get(word[i:j])
                if found is not None:
                    out[j].append((i, found, float(self.score_of[found])))
                elif j - i == 1:
                    out[j].append((i, self.unknown, self.unknown_score))
        return out

    def search(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best segmentations (score, ids): forward Viterbi, then A* from the end.

        Equal scores stand in order of their ids read from the end.
        """
        edges = self.edges_to(word)
        forward = [0.0] + [float("-inf")] * len(word)
        for j in range(1, len(word) + 1):
            forward[j] = max(forward[i] + s for i, _, s in edges[j])
        # (-score of the best way through, ids from the end, place, starts, score from here to the end)
        agenda: list[tuple] = [(-forward[-1], (), len(word), None, 0.0)]
        out: list[tuple[float, bytes]] = []
        while agenda and len(out) < n:
            total, ids, place, starts, behind = heapq.heappop(agenda)
            if place == 0:
                spelled = []
                for i in reversed(ids):
                    start, starts = starts
                    spelled.append((i, start))
                out.append((-total, self._spelled(word, spelled)))
                continue
            for i, piece, s in edges[place]:
                heapq.heappush(agenda, (-(forward[i] + s + behind), (*ids, piece), i, (i, starts), s + behind))
        return out

    def others(self, word: str, n: int) -> list[tuple[float, bytes]]:
        if (found := self._others.get((word, n))) is None:
            found = self._others[word, n] = self.search(word, n)
        return found

    # -- texts

    def words_of(self, text: str) -> list[str]:
        """The normalised text cut where no piece reaches over."""
        data, begins, starts = self._cut([text])
        ends = np.append(starts, len(data))[1:]
        raw = data.tobytes()
        return [raw[i:j].decode() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All normalised texts' bytes, where the texts start, and where the words do."""
        normal = [self.model.normalize(t).encode() for t in texts]
        sizes = np.fromiter(map(len, normal), np.int64, len(normal))
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(normal), np.uint8)
        starts = begins[sizes > 0]
        if self.cuts and len(data) > 2:
            marks = np.flatnonzero((data[:-2] == _MARK[0]) & (data[1:-1] == _MARK[1]) & (data[2:] == _MARK[2]))
            after_mark = np.zeros(len(marks), bool)
            after_mark[1:] = np.diff(marks) == len(_MARK)
            first = np.zeros(len(data) + 1, bool)
            first[marks[~after_mark]] = True
            first[starts] = True
            starts = np.flatnonzero(first)
        return data, begins, starts

    def encode(self, texts: list[str], n: int) -> Iterator[list[tuple[float, bytes]]]:
        """Each text's ``n`` best segmentations (score, ids), best first.

        Segmentations of equal score are ordered by their words, the last one
        first, each by its own order. A text without characters has the empty
        segmentation alone.
        """
        data, begins, starts_of = self._cut(texts)
        lengths = np.diff(np.append(starts_of, len(data)))
        raw_text = data.tobytes()

        def word(k: int) -> str:
            return raw_text[starts_of[k] : starts_of[k] + lengths[k]].decode()

        if len(self.count) > KEPT_WORDS:
            self._forget()
        keys = self.hashes.of(data, starts_of, lengths)
        rows = self.table.find(keys)
        long = lengths > LONGEST_WORD
        new, at = np.unique(keys[(rows < 0) & ~long], return_index=True)
        if len(new):
            where = np.flatnonzero((rows < 0) & ~long)[at].tolist()
            words = [word(k) for k in where]
            key_of = dict(zip(words, new.tolist(), strict=True))
            low = len(self.count)
            order = self.learn(words)
            self.table.add(np.array([key_of[w] for w in order], np.uint64), np.arange(low, low + len(order), dtype=np.int32))
            rows = self.table.find(keys)
        if long.any():  # rows of this call alone
            low = len(self.count)
            order = self.learn(list(dict.fromkeys(word(k) for k in np.flatnonzero(long))))
            row_of = {w: low + i for i, w in enumerate(order)}
            rows[long] = [row_of[word(k)] for k in np.flatnonzero(long)]
        counts = self.count[rows]
        ends = np.cumsum(counts)
        starts = ends - counts
        raw = memoryview(gather(self.pool, self.start[rows], counts).astype("<u4").tobytes())
        gaps, scores = self.gap[rows], self.score[rows]
        bounds = np.append(np.searchsorted(starts_of, begins), len(starts_of)).tolist()
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if low == high:
                yield [(0.0, b"")]
                continue
            total = float(scores[low:high].sum())
            out = [(total, bytes(raw[4 * starts[low] : 4 * ends[high - 1]]))]
            for lost, changes in self._next(lambda i, low=low: word(low + i), gaps[low:high], n) if n > 1 else ():
                parts, at = [], starts[low]
                for i, ids in changes:
                    parts += [raw[4 * at : 4 * starts[low + i]], ids]
                    at = ends[low + i]
                out.append((total - lost, b"".join([*parts, raw[4 * at : 4 * ends[high - 1]]])))
            yield out

    def _next(self, word: Callable[[int], str], gaps: np.ndarray, n: int) -> list[tuple[float, list[tuple[int, bytes]]]]:
        """The second to ``n``-th segmentations: what each loses, and its words (place, ids) that differ from the best."""
        few = np.flatnonzero(gaps <= np.partition(gaps, n - 2)[n - 2]) if len(gaps) > n - 1 else np.arange(len(gaps))
        few = few[np.argsort(gaps[few], kind="stable")][: n - 1]
        few = np.sort(few[np.isfinite(gaps[few])])[::-1].tolist()  # the last word first
        ways = [self.others(word(i), n) for i in few]
        agenda, met, out = [(0.0, (0,) * len(few))], set(), []
        while agenda and len(out) < n:
            lost, ranks = heapq.heappop(agenda)
            if ranks in met:
                continue
            met.add(ranks)
            out.append((lost, [(i, way[r][1]) for i, way, r in zip(few, ways, ranks, strict=True) if r][::-1]))
            for k in range(len(few)):
                if ranks[k] + 1 < len(ways[k]):
                    more = (*ranks[:k], ranks[k] + 1, *ranks[k + 1 :])
                    heapq.heappush(agenda, (sum(ways[m][0][0] - ways[m][r][0] for m, r in enumerate(more)), more))
        return out[1:]

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 bytes of ids; bytes of unknown characters may be any."""
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(at):
            return b""
        sizes = self._sizes[at]
        ends = np.cumsum(sizes)
        where = np.repeat(self._starts[at] - ends + sizes, sizes) + np.arange(ends[-1])
        out = self._all_bytes[where].tobytes()
        return out[1:] if out.startswith(b" ") else out  # the mark that normalising puts before a text


# ---------------------------------------------------------------- tables


def _id_schema(df: DataFrame, key: str, fields: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField("doc_id", df.schema[key].dataType), *fields])


def encode_nbest(
    df: DataFrame, model: str, n: int = 4, key: str = "doc_id", text: str = "text", with_ids: bool = True, check: bool = False
) -> DataFrame:
    """One row per row of ``df`` and segmentation: doc_id, rank (from 1), n_pieces, score, ids_crc32.

    ``ids`` (little-endian uint32) follow unless left out; with ``check``, the
    crc32 of the decoded ids (``text_crc32``) and whether they give back the
    text (``exact``). The ``n`` best segmentations by the sum of their pieces'
    scores come best first, fewer if a text has fewer. Null and empty texts
    have one, the empty one. Repeated rows are encoded alike; null keys pass
    through. An empty table gives an empty result; other columns are not read.
    ``model`` is the path of a model file that every executor has.
    """
    fields = [
        T.StructField("rank", T.IntegerType()),
        T.StructField("n_pieces", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if check:
        fields += [T.StructField("text_crc32", T.LongType()), T.StructField("exact", T.BooleanType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = _id_schema(df, key, fields)
    arrow = [pa.int32(), pa.int64(), pa.float64(), pa.int64()] + [pa.int64(), pa.bool_()] * check + [pa.binary()] * with_ids
    call = uuid.uuid4().hex

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = kept_in_worker(call, lambda: Lattice(model))
        for batch in batches:
            for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(low, DOCS_AT_ONCE)
                texts = [t or "" for t in some.column(1).to_pylist()]
                which, rows = [], []
                for i, found in enumerate(lattice.encode(texts, n)):
                    for rank, (score, ids) in enumerate(found, 1):
                        row = [rank, len(ids) // 4, score, zlib.crc32(ids)]
                        if check:
                            decoded = lattice.decode(ids)
                            row += [zlib.crc32(decoded), decoded == texts[i].encode()]
                        if with_ids:
                            row.append(ids)
                        which.append(i)
                        rows.append(row)
                columns = [some.column(0).take(pa.array(which, pa.int64()))]
                columns += [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                give_back()

    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, schema)


def decode(df: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and the text of ``ids`` (little-endian uint32) for every row; null ids are the empty text.

    Bytes that are no UTF-8 become replacement characters.
    """
    schema = _id_schema(df, key, [T.StructField("text", T.StringType())])
    call = uuid.uuid4().hex

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = kept_in_worker(call, lambda: Lattice(model))
        for batch in batches:
            texts = [lattice.decode(x or b"").decode(errors="replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.names)

    return df.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(back, schema)
