"""Token counts of a SentencePiece BPE model, by words that are known to be one token.

No piece of the model reaches over the place before a word mark that follows
another character, so merges never do, and a text's tokens are its words'
tokens one after another. Before any text is read, every piece that begins with
a mark is encoded alone: those that come back as that one piece are proven
whole tokens. A text's words that are among them count one each; the model
merges only the rest, each new word once for all that a worker meets.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.llm.common import give_back, kept_in_worker

MARK = "▁"
#: Merged words that a Python worker keeps, and the longest of them; others are merged anew.
KEPT_WORDS = 1_000_000
LONGEST_KEPT = 64
DOCS_AT_ONCE = 500


def load(path: str):
    """The model, if it cuts texts as this module needs it; else ValueError."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for text in ("a", "a  b ", " "):
        if model.normalize(text) != MARK + text.replace(" ", MARK):
            raise ValueError("the model does not mark every space and the start of a text")
    crossing = re.compile(f"[^{MARK}]{MARK}")
    for i in range(model.get_piece_size()):
        if model.is_unused(i) or crossing.search(model.id_to_piece(i)):
            raise ValueError(f"piece {i} reaches over a word's start or is unused")
    return model


def whole_tokens(model) -> dict[str, int]:
    """Pieces, without their first mark, that the model gives back as one token when they are encoded alone."""
    out = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if piece.startswith(MARK) and len(piece) > 1 and model.encode(piece[1:]) == [i]:
            out[piece[1:]] = 1
    return out


class WordCounts(dict):
    """Tokens by word (without its first mark): proven whole tokens, and the words merged so far."""

    def __init__(self, path: str):
        self.model = load(path)
        super().__init__(whole_tokens(self.model))
        self.most = len(self) + KEPT_WORDS
        self._words = re.compile(f"{MARK}({MARK}*[^{MARK}]*)").findall

    def __missing__(self, word: str) -> int:
        # a mark at a text's end is a word, too; alone it would be an empty text
        n = len(self.model.encode(word)) if word else len(self.model.encode("a ")) - len(self.model.encode("a"))
        if len(self) < self.most and len(word) <= LONGEST_KEPT:
            self[word] = n
        return n

    def of(self, text: str) -> int:
        """The tokens of a text."""
        if not text:
            return 0
        normal = self.model.normalize(text)
        words = normal.split(MARK)[1:]
        if "" in words:  # runs of marks belong to the word after them
            words = self._words(normal)
        return sum(map(self.__getitem__, words))


def count_tokens(df: DataFrame, model: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Counts are those of the model's own encoding of the whole text, without
    begin, end or other added tokens; control pieces' names in a text are
    ordinary text. Null and empty texts have none. Repeated rows count alike;
    null keys pass through. An empty table gives an empty result; other columns
    are not read. ``model`` is the path of a SentencePiece BPE file that every
    executor has; one whose pieces reach over words' starts raises ValueError.
    Nothing is shuffled: a worker holds the vocabulary, at most ``KEPT_WORDS``
    merged words and one slice of texts.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", df.schema[key].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    call = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = kept_in_worker(call, lambda: WordCounts(model))
        for batch in batches:
            for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(low, DOCS_AT_ONCE)
                n = pa.array([counts.of(t) for t in some.column(1).to_pylist()], pa.int64())
                sizes = pc.fill_null(pc.cast(pc.binary_length(some.column(1)), pa.int64()), 0)
                yield pa.RecordBatch.from_arrays([some.column(0), sizes, n, pc.greater(n, limit)], schema.names)
            give_back()

    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(count, schema)
