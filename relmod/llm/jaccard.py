"""Set-similarity self-join on word n-grams with set-relation skipping.

Documents become sets of hashed shingles. Two sets of Jaccard similarity t or
more share a shingle among their first ones in any one order of all shingles,
so those shingles' lists hold every pair. Inside a list, entries form blocks of
equal set size, sorted by the shingle's position: a block is left at the first
position from which the rest of the sets cannot overlap enough, and once the
probing set's own rest is too short, all larger blocks are. Within a list one
set's distances to all others are computed; a similar set's answers are derived
from them (its distances differ by no more than the two sets do), and only what
the bounds leave open is computed. Distances here are those of parity bitmaps,
which never exceed the sets' own, so nothing is lost; the pairs found are then
compared in full. Bitmaps are as long as their sets are large; lists carry them
folded to a fixed size, and a pair's whole ones are compared before its sets.

Links are wanted as classes. In a first round a list reports only pairs that
join what is still apart; in a second, with the components of the first, every
remaining pair between different components. Both are linear for groups of
copies of any size, and the second leaves no pair unchecked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relmod.llm.common import fresh, give_back, group_bounds, in_blocks, keys_of, nullable, stored, tasks_for, whole_groups
from relmod.llm.components import components

#: Shingles that count as frequent, at most; they come last in the order of shingles.
#: The order affects the lists' lengths alone, never the result.
FREQUENT = 1_000_000
#: A task hands on the shingles that at least so many of its documents (of each batch of shingles) hold.
LOCALLY_FREQUENT = 2
GATHERED = 2_000_000
#: Longer lists are compared block against block in separate groups.
BLOCK = 1500
#: A bitmap has the power of two of bits that is not below the set's size, and at least so many.
LEAST_BITS = 1024
#: Entries of lists carry bitmaps folded to so many words of 64 bits: lists are long, and long documents are in many.
SKETCH_WORDS = 8
ENTRIES_PER_TASK = 500_000
#: Up to so many rows of two longs (3.2 MB), pairs and the marks of texts to compare are broadcast; beyond, the join shuffles.
BROADCAST_MARKS = 200_000
DOCS_AT_ONCE = 250
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- sets


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles of ``words`` words.

    A-Z are lower-cased and words are runs of other characters than white
    space (space, tab to carriage return). Fewer words are one shingle; none
    are the empty set.
    """
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    k = min(words, len(found))
    m = len(found) - k + 1
    acc = np.full(m, k, np.uint64)
    for i in range(k):
        acc = (acc ^ h[i : i + m]) * _ODD
        acc ^= acc >> np.uint64(29)
    acc *= _ODD2
    acc ^= acc >> np.uint64(32)
    return np.unique(acc)


def parity_bitmap(s: np.ndarray) -> np.ndarray:
    """For each bit, whether an odd number of the set's shingles falls on it."""
    bits = max(LEAST_BITS, 1 << (len(s) - 1).bit_length() if len(s) else 0)
    at = (s * _ODD >> np.uint64(20)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of the same set with fewer bits."""
    while len(bitmap) > words:
        bitmap = bitmap[: len(bitmap) // 2] ^ bitmap[len(bitmap) // 2 :]
    return bitmap


def needed(total: int | np.ndarray, num: int, den: int):
    """Smallest overlap of two linked sets whose sizes sum up to ``total``."""
    return -(-num * total // (num + den))


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def frequent_shingles(df: DataFrame, text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and about how many documents hold each.

    Counted over all documents; a task leaves out what is rare among its own.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                gathered.append(shingle_set(t, words))
                size += len(gathered[-1])
                if size > GATHERED:
                    yield often(gathered)
                    gathered, size = [], 0
                    give_back()
        if gathered:
            yield often(gathered)

    def often(gathered: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(gathered), return_counts=True)
        many = n >= LOCALLY_FREQUENT
        return pa.RecordBatch.from_arrays([_signed(token[many]), pa.array(n[many].astype(np.int64))], ["token", "n"])

    totals = stored(
        df.select(F.col(text).alias("text")).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")),
        "frequent",
    )
    step = F.floor(F.log2("n") * 16).cast("int")
    held, least = 0, 1 << 30
    for r in sorted(totals.groupBy(step.alias("step")).count().collect(), reverse=True):  # a few hundred rows
        if held + r[1] > FREQUENT:
            break
        held, least = held + r[1], r[0]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.asarray(c.to_numpy(zero_copy_only=False), np.int64).tobytes() for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], ["tokens", "counts"])

    # at most FREQUENT, as packed numbers of 16 bytes: 16 MB
    blobs = totals.filter(step >= least).select("token", "n").mapInArrow(pack, "tokens binary, counts binary").collect()
    token = np.frombuffer(b"".join(bytes(b[0]) for b in blobs), np.uint64)
    n = np.frombuffer(b"".join(bytes(b[1]) for b in blobs), np.int64)
    order = np.argsort(token)
    return token[order], n[order]


def document_sets(rows: DataFrame, words: int, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Of (id, uid, marks, text): the set's size ``n``, a 128-bit signature, its first shingles, how many of those aren't frequent, its bitmap, and that folded to a sketch."""
    schema = nullable(
        rows.selectExpr(
            "id", "uid", "mark_a", "mark_b", "0L AS n", "X'' AS sig", "array(0L) AS prefix", "0 AS rare", "X'' AS bitmap", "X'' AS sketch"
        ).schema
    )
    shared = rows.sparkSession.sparkContext.broadcast(frequent)  # bounded by FREQUENT

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = shared.value
        for whole in batches:
            for low in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(low, DOCS_AT_ONCE)
                sizes, sigs, firsts, rare, maps, sketches = [], [], [], [], [], []
                for t in batch.column(4).to_pylist():
                    s = shingle_set(t, words)
                    sizes.append(len(s))
                    sigs.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    p = prefix_length(len(s), num, den) if len(s) else 0
                    if len(common) and p:
                        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                        is_common = common[at] == s
                        first = s[~is_common][:p]
                        rare.append(len(first))
                        if len(first) < p:
                            last, n = s[is_common], counts[at[is_common]]
                            first = np.concatenate([first, last[np.lexsort((last, n))][: p - len(first)]])
                    else:
                        first = s[:p]
                        rare.append(p)
                    firsts.append(first.view(np.int64))
                    bitmap = parity_bitmap(s)
                    maps.append(bitmap.tobytes())
                    sketches.append(folded(bitmap, SKETCH_WORDS).tobytes())
                ends = np.cumsum([0, *map(len, firsts)])
                prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*firsts, np.empty(0, np.int64)])))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:4],
                        pa.array(sizes, pa.int64()),
                        pa.array(sigs, pa.binary()),
                        prefix,
                        pa.array(rare, pa.int32()),
                        pa.array(maps, pa.binary()),
                        pa.array(sketches, pa.binary()),
                    ],
                    schema.names,
                )
            give_back()

    return rows.select("id", "uid", "mark_a", "mark_b", "text").mapInArrow(describe, schema)


# ---------------------------------------------------------------- lists


def shared_entries(sets: DataFrame) -> DataFrame:
    """(token, uid, n, pos) of first shingles that are in several sets.

    Entries of frequent shingles are taken as they are; a long list is thus
    never moved to one task. The others are sorted by shingle, and neighbours
    show which are alone.
    """
    entries = sets.select("uid", "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    frequent = entries.filter(F.col("pos") >= F.col("rare")).select("token", "uid", "n", "pos")
    rare = entries.filter(F.col("pos") < F.col("rare")).select("token", "uid", "n", "pos")

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, alone = None, None  # the token before, and its row while it is alone
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column(0).to_numpy()
            before = np.empty(len(token), bool)
            before[1:] = token[1:] == token[:-1]
            before[0] = last is not None and token[0] == last
            if alone is not None and before[0]:
                yield alone
            keep = before.copy()
            keep[:-1] |= before[1:]
            last = token[-1]
            alone = None if keep[-1] else batch.slice(batch.num_rows - 1)
            yield batch.filter(pa.array(keep))

    n = sets.agg(F.sum(F.size("prefix"))).first()[0] or 0
    found = rare.repartition(tasks_for(n, ENTRIES_PER_TASK, sets.sparkSession), "token").sortWithinPartitions("token").mapInArrow(several, rare.schema)
    return found.unionByName(frequent)


PAIRS = "a long, b long"


def candidate_pairs(lists: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """Distinct pairs (a, b) of entries of a list that may be linked and whose labels differ.

    ``lists`` has token, uid, n, pos, label, sketch and the list's ``length`` if that is over ``BLOCK``.
    With ``forest``, a list reports no pair that its other pairs connect.
    """
    entries = in_blocks(lists, F.col("length"), "uid", BLOCK).select(
        "token", "left", "right", "block", "uid", "n", "pos", "label", "sketch"
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 3):
            yield _pairs_of(rows, num, den, forest)

    key = ["token", "left", "right"]
    return entries.repartition(*key).sortWithinPartitions(*key, "n", "pos", "uid").mapInArrow(found, PAIRS).distinct()


def _pairs_of(rows: pa.Table, num: int, den: int, forest: bool) -> pa.RecordBatch:
    group = keys_of(rows, 3)
    block, uid, n, pos, label = (rows.column(i).to_numpy().astype(np.int64) for i in range(3, 8))
    maps = np.frombuffer(b"".join(rows.column(8).to_pylist()), np.uint64).reshape(len(uid), SKETCH_WORDS)
    starts = group_bounds(group)
    cross = group[:, 1] != group[:, 2]
    lengths = np.diff(starts)
    # lists of two are most lists, and all are compared at once
    i = starts[:-1][lengths == 2]
    j = i + 1
    alpha = needed(n[i] + n[j], num, den)
    ok = (label[i] != label[j]) & (den * n[i] >= num * n[j]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= alpha)
    ok &= ~cross[i] | (block[i] != block[j])
    i, j, most = i[ok], j[ok], (n[i] + n[j] - 2 * alpha)[ok]
    near = _apart(maps[i], maps[j]) <= most
    out = [(uid[i[near]], uid[j[near]])]
    for k in np.flatnonzero(lengths > 2):
        s = slice(starts[k], starts[k + 1])
        if (label[s] == label[s.start]).all():
            continue
        apart = block[s] if cross[s.start] else None
        a, b = _compare(n[s], pos[s], maps[s], label[s], apart, num, den, forest)
        out.append((uid[s][a], uid[s][b]))
    a, b = (np.concatenate(x) for x in zip(*out, strict=True))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.empty((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, c])) for c in (0, 1)], ["a", "b"])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def _compare(n, pos, maps, label, apart, num: int, den: int, forest: bool) -> tuple[list[int], list[int]]:
    """Pairs of entries of one list, sorted by (n, pos), that the bounds leave."""
    sizes, at = np.unique(n, return_index=True)
    ends = np.append(at[1:], len(n))
    root = np.unique(label, return_inverse=True)[1]
    ref, known = 0, _apart(maps, maps[0])  # a set and its distances to all others
    left, right = [], []
    for i in range(1, len(n)):
        picked = []
        for b in range(int(np.searchsorted(sizes, -(-num * n[i] // den))), len(sizes)):  # a block: the sets of one size, by position
            alpha = needed(int(sizes[b] + n[i]), num, den)
            if at[b] >= i or n[i] - pos[i] < alpha:
                break  # this and all larger blocks: too little of the probing set is left
            end = min(ends[b], i)
            stop = at[b] + int(np.searchsorted(pos[at[b] : end], sizes[b] - alpha, "right"))
            if stop > at[b]:
                picked.append(np.arange(at[b], stop))
        if not picked:
            continue
        j = np.concatenate(picked)
        j = j[root[j] != root[i]]
        if apart is not None:
            j = j[apart[j] != apart[i]]
        total = n[j] + n[i]
        most = total - 2 * needed(total, num, den)
        if not len(j):
            continue
        # another set's distances to the reference differ from this one's by what the two sets are apart at most
        if known[i] > most.max() // 2 and i - ref > 16:
            ref, known = i, _apart(maps, maps[i])
        ok = known[i] + known[j] <= most
        unsure = ~ok & (np.abs(known[i] - known[j]) <= most)
        if unsure.any():
            ok[unsure] = _apart(maps[j[unsure]], maps[i]) <= most[unsure]
        j = j[ok]
        if forest:
            for r, first in zip(*np.unique(root[j], return_index=True), strict=True):
                left.append(i)
                right.append(int(j[first]))
                root[root == r] = root[i]
        else:
            left.extend([i] * len(j))
            right.extend(j.tolist())
    return left, right


# ---------------------------------------------------------------- the join


def full_sets(df: DataFrame, words: int) -> DataFrame:
    """(mark_a, mark_b, tokens) of (mark_a, mark_b, text): whole sets, for the pairs that are compared in full."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for low in range(0, rows.num_rows, DOCS_AT_ONCE):
                batch = rows.slice(low, DOCS_AT_ONCE)
                sets = [shingle_set(t, words) for t in batch.column(2).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)])
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(np.concatenate([*sets, np.empty(0, np.uint64)])))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], ["mark_a", "mark_b", "tokens"])
            give_back()

    return df.mapInArrow(whole, "mark_a long, mark_b long, tokens array<long>")


def close_pairs(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole bitmaps leave them a link."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(m, np.uint64) for m in batch.column(c).to_pylist()] for c in (2, 3))
            total = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            most = total - 2 * needed(total, num, den)
            both = [(folded(a, min(len(a), len(b))), folded(b, min(len(a), len(b)))) for a, b in zip(x, y, strict=True)]
            near = [int(_apart(a, b)) <= m for (a, b), m in zip(both, most.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    maps = sets.select("uid", "n", "bitmap")
    both = pairs.join(maps.withColumnsRenamed({"uid": "a", "n": "n_a", "bitmap": "map_a"}), "a").join(
        maps.withColumnsRenamed({"uid": "b", "n": "n_b", "bitmap": "map_b"}), "b"
    )
    return both.select("a", "b", "map_a", "map_b", "n_a", "n_b").mapInArrow(close, PAIRS)


def linked(pairs: DataFrame, sets: DataFrame, source: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked. ``sets``: uid and marks; ``source``: id, text."""
    both_ends = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    wanted = stored(both_ends.join(sets.select("uid", "mark_a", "mark_b"), "uid"), "wanted")
    named = wanted.select(F.col("mark_a").alias("_a"), F.col("mark_b").alias("_b")).distinct()
    if wanted.count() <= BROADCAST_MARKS:
        named = F.broadcast(named)
    texts = source.select(*marks("id", "text"), "text").join(
        named, (F.col("mark_a") == F.col("_a")) & (F.col("mark_b") == F.col("_b")), "left_semi"
    )
    whole = stored(full_sets(texts, words).join(wanted, ["mark_a", "mark_b"]).select("uid", "tokens"), "sets")
    few = F.broadcast(pairs) if pairs.count() <= BROADCAST_MARKS else pairs
    both = few.join(whole.withColumnsRenamed({"uid": "a", "tokens": "s"}), "a").join(
        whole.withColumnsRenamed({"uid": "b", "tokens": "t"}), "b"
    )
    common = F.size(F.array_intersect("s", "t"))
    return both.withColumn("_c", common).filter(
        F.col("_c") * den >= (F.size("s") + F.size("t") - F.col("_c")) * num
    ).select("a", "b")


def marks(key: str, text: str) -> list[Column]:
    """128 bits that tell a row by its key and text."""
    return [F.xxhash64(key, text).alias("mark_a"), F.xxhash64(text, key, F.lit(1)).alias("mark_b")]


def similar_documents(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 8, den: int = 10
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles (set size), component_id, kept, mark_a, mark_b.

    Two documents link when the Jaccard similarity of their shingle sets is at
    least ``num / den``; component_id is the smallest key that links reach,
    the row's own included, and kept marks one row of each component, of that
    key. Null and empty texts, and texts without words, have the empty set and
    link with nothing. Equal sets are one class and link. Rows that repeat a
    key are documents of their own; null keys are no component's smallest
    unless all of its keys are null. The marks tell rows by key and text. An
    empty table gives an empty result; other columns are not read.
    """
    source = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    frequent = frequent_shingles(source, "text", words)
    numbered = source.select("id", F.monotonically_increasing_id().alias("uid"), *marks("id", "text"), "text")
    sets = stored(document_sets(numbered, words, num, den, frequent), "sets")

    first_of = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("uid").alias("uid"))
    classes = stored(
        sets.filter("n > 0").groupBy("sig").agg(F.min("uid").alias("uid"), F.min(first_of).alias("first"), F.count(F.lit(1)).alias("members")),
        "classes",
    )
    followers = sets.join(
        classes.filter("members > 1").select(F.col("sig").alias("_sig"), F.col("uid").alias("_first")),
        (F.col("sig") == F.col("_sig")) & (F.col("uid") != F.col("_first")),
        "left_semi",
    ).select("uid")
    entries = stored(shared_entries(sets).join(followers, "uid", "left_anti"), "entries")
    long = stored(entries.groupBy("token").agg(F.count(F.lit(1)).alias("length")).filter(F.col("length") > BLOCK), "long")
    if long.count() <= BROADCAST_MARKS:
        long = F.broadcast(long)
    lists = entries.join(long, "token", "left").withColumn("length", F.coalesce("length", F.lit(1)))
    sketched = lists.join(sets.select("uid", "sketch"), "uid")

    def links(labelled: DataFrame, forest: bool) -> DataFrame:
        met = stored(candidate_pairs(labelled, num, den, forest), "met")
        pairs = stored(close_pairs(met, sets, num, den), "pairs")
        return stored(linked(pairs, sets, source, words, num, den), "links")

    once = links(sketched.withColumn("label", F.col("uid")), True)
    roots = components(once)
    labelled = sketched.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("root", "uid")).drop("root")
    again = links(labelled, False)
    if not again.isEmpty():
        roots = components(once.unionByName(again))

    placed = classes.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("_least"), F.sum("members").alias("_all")).filter("_all > 1")
    known = stored(placed.join(smallest, "root").select(F.col("sig").alias("_sig"), "_least"), "known")
    return sets.join(known, F.col("sig") == F.col("_sig"), "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("_least").isNull(), F.col("id")).otherwise(F.col("_least.id")).alias("component_id"),
        F.coalesce(F.col("_least.uid") == F.col("uid"), F.lit(True)).alias("kept"),
        "mark_a",
        "mark_b",
    )


def one_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 8, den: int = 10
) -> DataFrame:
    """``df`` with one row of each component of ``similar_documents``; rows of equal key and text become one row."""
    keep = similar_documents(df, key, text, words, num, den).filter("kept").select("mark_a", "mark_b")
    a, b = fresh(df, "_mark_a", "_mark_b")
    mark_a, mark_b = marks(key, text)
    known = df.select("*", mark_a.alias(a), mark_b.alias(b))
    kept = known.join(keep.withColumnsRenamed({"mark_a": a, "mark_b": b}), [a, b], "left_semi")
    return kept.dropDuplicates([a, b]).select(*[F.col(f"`{c}`") for c in df.columns])
