"""Line deduplication through a sharded minimal perfect hash.

Lines become 128-bit hashes. The distinct hashes of lines that enough
documents hold are dealt into shards; each shard builds a minimal perfect hash
over its own and stores, by its numbering, compact arrays: a fingerprint, the
number of documents, and the document that keeps the line. Documents then
probe the arrays with their hashes; no line is joined with another, and no
line's text leaves its document.

The perfect hash has levels of bit arrays: a key whose bit no other key of the
level hits is settled there, the others go on to the next level. A key's
number is the rank of its bit over all levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.llm.common import fresh, give_back, stored, tasks_for

#: What is stripped off a line's ends: the white space of the contract, without the line feed that ends it.
STRIP = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
PROBES_PER_TASK = 250_000
#: Stands for a null document id: smaller than any other.
NO_ID = -(1 << 63)


# ---------------------------------------------------------------- the perfect hash


def _place(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = hi.view(np.uint64) + lo.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 0xD1B54A32D192ED03 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (((z ^ (z >> np.uint64(31))) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def build_levels(hi: np.ndarray, lo: np.ndarray) -> list[bytes]:
    """Bit arrays of a minimal perfect hash over distinct (hi, lo)."""
    levels: list[bytes] = []
    while len(hi):
        size = 8 * ((2 * len(hi) + 7) // 8)
        at = _place(hi, lo, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(np.packbits(alone).tobytes())
        rest = ~alone[at]
        hi, lo = hi[rest], lo[rest]
    return levels


def numbers(levels: list[bytes], hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Each key's number; -1 for keys that no level settles. Foreign keys may get any number."""
    out = np.full(len(hi), -1, np.int64)
    left, base = np.arange(len(hi)), 0
    for k, level in enumerate(levels):
        bits = np.unpackbits(np.frombuffer(level, np.uint8))
        rank = np.cumsum(bits, dtype=np.int64)
        at = _place(hi[left], lo[left], k, len(bits))
        hit = bits[at] == 1
        out[left[hit]] = base + rank[at[hit]] - 1
        left, base = left[~hit], base + int(rank[-1])
        if not len(left):
            break
    return out


# ---------------------------------------------------------------- lines


def line_digest(line: str, min_chars: int) -> bytes | None:
    """128 bits of the line's key, or None if the key is too short to count."""
    key = line.strip(STRIP)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def _digests(text: str | None, min_chars: int) -> set[bytes]:
    if not text or len(text) < min_chars:
        return set()
    return {d for line in text.split("\n") if len(line) >= min_chars and (d := line_digest(line, min_chars))}


def _id(key: str):
    return F.coalesce(F.col(key).cast("long"), F.lit(NO_ID))


HASHES = "hi long, lo long, id long, own long"


def line_hashes(df: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(hi, lo, id, own): each document's distinct line hashes; ``own`` tells documents of one id apart, by their text."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, owns, flat = [], [], []
            for i, own, t in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                found = _digests(t, min_chars)
                ids.extend([i] * len(found))
                owns.extend([own] * len(found))
                flat.extend(found)
            pair = np.frombuffer(b"".join(flat), "<i8").reshape(-1, 2)
            columns = [pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1]))]
            columns += [pa.array(ids, pa.int64()), pa.array(owns, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["hi", "lo", "id", "own"])
            give_back()

    rows = df.select(_id(key).alias("id"), F.xxhash64(text).alias("own"), F.col(text).alias("text"))
    return rows.mapInArrow(hashes, HASHES)


# ---------------------------------------------------------------- the index


def _index_shard(rows: pd.DataFrame) -> pd.DataFrame:
    hi, lo = rows["hi"].to_numpy(), rows["lo"].to_numpy()
    levels = build_levels(hi, lo)
    at = numbers(levels, hi, lo)
    prints, docs, keep = (np.empty(len(hi), np.int64) for _ in range(3))
    prints[at], docs[at], keep[at] = lo, rows["docs"].to_numpy(), rows["keep"].to_numpy()
    return pd.DataFrame(
        {
            "shard": [int(rows["shard"].iloc[0])],
            "levels": [levels],
            "prints": [prints.tobytes()],
            "docs": [docs.tobytes()],
            "keep": [keep.tobytes()],
            "load": [int(docs.sum())],
        }
    )


INDEX = "shard int, levels array<binary>, prints binary, docs binary, keep binary, load long"


def build_index(hashes: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """One row per shard: the perfect hash and its arrays over hashes that ``min_docs`` documents hold."""
    lines = (
        hashes.groupBy("hi", "lo")
        .agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keep"))
        .filter(F.col("docs") >= min_docs)
        .withColumn("shard", _shard(shards))
    )
    return lines.groupBy("shard").applyInPandas(_index_shard, INDEX)


def _shard(shards: int):
    return F.pmod(F.col("hi"), F.lit(shards)).cast("int")


DROPS = "id long, own long, digest binary"


def _probe(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if not len(index) or not len(probes):
        return pd.DataFrame({"id": np.empty(0, np.int64), "own": np.empty(0, np.int64), "digest": np.empty(0, object)})
    shard = index.iloc[0]
    hi, lo, ids, owns = (probes[c].to_numpy() for c in ("hi", "lo", "id", "own"))
    at = numbers(list(shard["levels"]), hi, lo)
    prints, keep = np.frombuffer(shard["prints"], np.int64), np.frombuffer(shard["keep"], np.int64)
    drop = (at >= 0) & (prints[at] == lo) & (keep[at] != ids)
    pair = np.stack([hi[drop], lo[drop]], axis=1).astype("<i8")
    return pd.DataFrame({"id": ids[drop], "own": owns[drop], "digest": [row.tobytes() for row in pair]})


def lines_to_drop(df: DataFrame, key: str, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(id, own, digest) of the lines that each document loses."""
    spark = df.sparkSession
    hashes = stored(line_hashes(df, key, text, min_chars), "lines")
    n = hashes.count()
    shards = tasks_for(n, PROBES_PER_TASK, spark)
    index = stored(build_index(hashes, shards, min_docs), "index")
    # A shard with a hot line gets as many probes as documents hold the line: its probes are split
    # into parts of an ordinary shard's size, each of which gets the shard's arrays.
    usual = max(1, -(-n // shards))
    parts = (F.floor(F.col("load") / F.lit(2 * usual)) + 1).cast("int")
    split = index.filter(parts > 1).select("shard", parts.alias("parts"))  # fewer rows than shards
    probes = (
        hashes.withColumns({"shard": _shard(shards), "_n": F.monotonically_increasing_id()})
        .join(F.broadcast(split), "shard", "left")
        .withColumn("part", F.pmod(F.xxhash64("_n"), F.coalesce("parts", F.lit(1))).cast("int"))
        .select("shard", "part", "hi", "lo", "id", "own")
    )
    arrays = index.select("shard", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "levels", "prints", "keep")
    return (
        probes.groupBy("shard", "part").cogroup(arrays.groupBy("shard", "part")).applyInPandas(_probe, DROPS)
    )


def lists_to_drop(df: DataFrame, key: str, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(id, own, gone): the distinct digests that documents of one id and text lose, so no more than one document's lines.

    Whether a line goes depends on the line and the id alone, so texts whose
    hashes clash would share a list without harm.
    """
    return lines_to_drop(df, key, text, min_docs, min_chars).groupBy("id", "own").agg(F.collect_set("digest").alias("gone"))


# ---------------------------------------------------------------- documents


def drop_repeated_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``df`` with lines removed from ``text``, and with ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without white space at its ends and with A-Z
    lower-cased. Keys of at least ``min_chars`` code points that at least
    ``min_docs`` rows hold are removed from every document but the one with the
    largest integer ``key`` (null keys are smaller than any other); the other
    lines stay, joined by line feeds. Null and empty texts are one empty line
    and stay as they are. Rows that repeat the largest key all keep the line.
    All other columns pass through; columns of the two new names are replaced.
    An empty table gives an empty result.
    """
    kept = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    number, own, lost_lines = fresh(df, "_id", "_own", "_gone")
    lists = lists_to_drop(df, key, text, min_docs, min_chars).toDF(number, own, lost_lines)
    columns_kept = [F.col(f"`{c}`") for c in kept]
    both = df.select(*columns_kept, _id(key).alias(number), F.xxhash64(text).alias(own))
    both = both.join(lists, [number, own], "left").select(*columns_kept, lost_lines)
    where = kept.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for t, lost in zip(batch.column(where).to_pylist(), batch.column(len(kept)).to_pylist(), strict=True):
                if not lost:
                    lines.append((t or "").count("\n") + 1)
                    dropped.append(0)
                else:
                    lost, old = set(lost), t.split("\n")
                    new = [x for x in old if len(x) < min_chars or line_digest(x, min_chars) not in lost]
                    lines.append(len(old))
                    dropped.append(len(old) - len(new))
                    t = "\n".join(new)
                texts.append(t)
            columns = [batch.column(i) for i in range(len(kept))]
            columns[where] = pa.array(texts, pa.string())
            columns += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])
            give_back()

    return both.mapInArrow(cut, schema)
