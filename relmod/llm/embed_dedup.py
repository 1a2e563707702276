"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector is in the filter's cap if its cosine with it
reaches a threshold. The directions are a product code: the rotated space is
split into blocks, each block has a few random directions, and a filter is a
choice of one for each block. So far more filters are had than vectors are
scored against, and the filters that a vector exceeds are list-decoded: blocks
are combined one after another, and a choice is left as soon as the best rest
cannot lift it over the threshold. Vectors that share a filter are compared.

The number of filters grows with the number of vectors, and the threshold with
it, so that a vector is in ``FILTERS`` filters and a filter holds ``BUCKET``
vectors on average whatever the input's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.llm.common import group_bounds, in_blocks, keys_of, nullable, stored, whole_groups
from relmod.llm.components import components

COSINE = 0.95
#: Filters per vector and vectors per filter, on average.
FILTERS, BUCKET = 28, 100
#: A vector is in so many filters at least, if need be in ones below the threshold, by so much at a time.
LEAST_FILTERS, STEP = 16, 0.02
#: Larger buckets are compared block against block in separate groups.
BLOCK = 1500
SEED = 20
#: Up to so many rows of two longs (1.6 MB), the list of larger buckets is broadcast; beyond, the join shuffles.
BROADCAST_FILTERS = 100_000


# ---------------------------------------------------------------- filters


def cap_threshold(dim: int, share: float) -> float:
    """The cosine that a ``share`` of the unit sphere's directions exceeds."""
    if share >= 1 or dim < 2:
        return -2.0
    u = np.linspace(-1, 1, 200_001)[1:-1]
    density = (1 - u * u) ** ((dim - 3) / 2)
    above = np.cumsum(density[::-1])[::-1]
    return float(u[np.searchsorted(-above / above[0], -share)])


def product_code(dim: int, vectors: int) -> tuple[np.ndarray, list[np.ndarray], float]:
    """Rotation, each block's directions, and the threshold for ``vectors`` vectors."""
    filters = max(1, math.ceil(vectors * FILTERS / BUCKET))
    blocks = min(dim, max(2, math.ceil(math.log(filters, 1024)))) if dim > 1 else 1
    each = max(1, math.ceil(filters ** (1 / blocks) - 1e-9))
    rng = np.random.default_rng(SEED)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    codes = []
    for part in np.array_split(np.arange(dim), blocks):
        c = rng.standard_normal((each, len(part)))
        codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(blocks))
    return rotation, codes, cap_threshold(dim, FILTERS / each**blocks)


def list_decode(unit: np.ndarray, rotation: np.ndarray, codes: list[np.ndarray], threshold: float) -> list[np.ndarray]:
    """For each row of ``unit``, the sorted filters that it exceeds.

    Where these are too few, its threshold is lowered step by step.
    """
    parts = np.array_split(unit @ rotation, np.cumsum([c.shape[1] for c in codes])[:-1], axis=1)
    scores = [p @ c.T for p, c in zip(parts, codes, strict=True)]
    best = np.stack([s.max(axis=1) for s in scores])
    rest = np.concatenate([np.cumsum(best[::-1], axis=0)[::-1][1:], np.zeros((1, len(unit)))])
    wanted = min(LEAST_FILTERS, math.prod(len(c) for c in codes))
    out = []
    for i in range(len(unit)):
        least = threshold
        at = np.empty(0, np.int64)
        while len(at) < wanted:
            at, total = np.zeros(1, np.int64), np.zeros(1)
            for b, s in enumerate(scores):
                row = s[i]
                use = np.flatnonzero(row + total.max(initial=-9) + rest[b, i] >= least)
                both = total[:, None] + row[use]
                x, y = np.nonzero(both + rest[b, i] >= least)
                at, total = at[x] * len(row) + use[y], both[x, y]
            least -= STEP
        out.append(np.sort(at))
    return out


# ---------------------------------------------------------------- comparing


LINKS = "a long, b long, n long"


def codes_by_size(counts: dict[int, int], step: int) -> dict[int, tuple[int, tuple]]:
    """For each vector size in bytes, the number of its first filter and its product code; ``counts`` has the vectors.

    Vectors of different lengths have filters of their own, so they never meet.
    """
    out, first = {}, 0
    for size, n in sorted(counts.items()):
        code = product_code(size // step, n)
        out[size] = first, code
        first += math.prod(len(c) for c in code[1])
    return out


def _links_of(rows: pa.Table, kind: str, cosine: float, codes: dict[int, tuple[int, tuple]]) -> pa.RecordBatch:
    """Of whole groups (filter, left, right, block, uid, weight, vec): link counts (a, null, n) and joining links (a, b, 0)."""
    group = keys_of(rows, 3)
    block, uid, weight = (rows.column(i).to_numpy().astype(np.int64) for i in range(3, 6))
    raw = rows.column(6).to_pylist()
    a, b, n = [], [], []
    bounds = group_bounds(group)
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - start < 2:
            continue
        x = np.frombuffer(b"".join(raw[start:end]), kind).reshape(end - start, -1).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= cosine
        if group[start, 1] != group[start, 2]:
            near &= block[start:end, None] != block[None, start:end]
        np.fill_diagonal(near, False)
        some = np.flatnonzero(near.any(axis=1))
        if not len(some):
            continue
        near, ids = near[np.ix_(some, some)], uid[start:end][some]
        # a pair is counted in the smallest filter that both are in
        offset, code = codes[len(raw[start])]
        this = group[start, 0] - offset
        columns: dict[int, list[int]] = {}
        for k, filters in enumerate(list_decode(x[some], *code)):
            for f in filters[: np.searchsorted(filters, this)].tolist():
                columns.setdefault(f, []).append(k)
        shared = [c for c in columns.values() if len(c) > 1]
        first = near
        if shared:
            inside = np.zeros((len(some), len(shared)), np.float32)
            for c, members in enumerate(shared):
                inside[members, c] = 1
            first = near & (inside @ inside.T < 0.5)
        counts = first @ weight[start:end][some]
        has = counts > 0
        a.extend(ids[has].tolist())
        b.extend([None] * int(has.sum()))
        n.extend(counts[has].tolist())
        root = np.arange(len(some))
        while True:
            least = np.minimum(root, np.where(near, root[None, :], len(some)).min(axis=1))
            least = least[least]
            if (least == root).all():
                break
            root = least
        child = np.flatnonzero(root != np.arange(len(some)))
        a.extend(ids[child].tolist())
        b.extend(ids[root[child]].tolist())
        n.extend([0] * len(child))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, n)], ["a", "b", "n"])


# ---------------------------------------------------------------- the operator


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    Two vectors link when their cosine, in double precision, is at least
    ``cosine``; every link found is a real one, and filters find nearly all
    (the tests measure the share). Vectors that are null, zero, or hold null or
    non-finite components link with nothing; vectors of different lengths do not
    link with one another. There is a product code for every length that occurs.
    n_links counts the other rows linked directly, component_id is the smallest
    key that links reach, and kept marks the rows whose key it is. Equal
    vectors are compared once and all link. Rows that repeat a key are rows of
    their own. An empty table gives an empty result; other columns are not
    read.
    """
    spark = df.sparkSession
    wide = isinstance(df.schema[vector].dataType.elementType, T.DoubleType)
    kind, step = ("<f8", 8) if wide else ("<f4", 4)

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(2).to_pylist():
                if not v or None in v:
                    out.append(None)
                    continue
                x = np.asarray(v, kind) + np.zeros(1, kind)  # one zero only
                ok = np.isfinite(x).all() and x.any()
                out.append(x.tobytes() if ok and np.isfinite(np.linalg.norm(x.astype(np.float64))) and np.linalg.norm(x.astype(np.float64)) > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "uid", "vec"])

    source = df.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("uid"), F.col(vector).cast("array<double>" if wide else "array<float>").alias("vec"))
    rows = stored(source.mapInArrow(checked, nullable(source.selectExpr("id", "uid", "X'' AS vec").schema)), "vectors")
    classes = stored(
        rows.filter("vec is not null").groupBy("vec").agg(F.min("uid").alias("uid"), F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")),
        "classes",
    )
    codes = codes_by_size(dict(classes.groupBy(F.length("vec")).count().collect()), step)  # a row per length

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            found: list[list[int]] = [[] for _ in raw]
            by_size: dict[int, list[int]] = {}
            for at, b in enumerate(raw):
                by_size.setdefault(len(b), []).append(at)
            for size, some in by_size.items():
                offset, code = codes[size]
                x = np.frombuffer(b"".join(raw[at] for at in some), kind).reshape(len(some), -1).astype(np.float64)
                for at, f in zip(some, list_decode(x / np.linalg.norm(x, axis=1, keepdims=True), *code), strict=True):
                    found[at] = (f + offset).tolist()
            filters = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, filters], ["uid", "weight", "vec", "filters"])

    placed = stored(
        classes.select("uid", "weight", "vec").repartition("uid").mapInArrow(decode, "uid long, weight long, vec binary, filters array<long>"), "filters"
    )
    sizes = placed.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count(F.lit(1)).alias("length"))
    large = stored(sizes.filter(F.col("length") > BLOCK), "large")
    if large.count() <= BROADCAST_FILTERS:
        large = F.broadcast(large)
    members = placed.select("uid", "weight", "vec", F.explode("filters").alias("filter")).join(large, "filter", "left")
    buckets = in_blocks(members, F.coalesce("length", F.lit(1)), "uid", BLOCK)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, 3):
            yield _links_of(groups, kind, cosine, codes)

    keys = ["filter", "left", "right"]
    links = stored(
        buckets.select(*keys, "block", "uid", "weight", "vec").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, LINKS),
        "links",
    )
    roots = components(links.filter("b is not null")).withColumnRenamed("node", "uid")
    counts = links.filter("b is null").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("n"))
    linked = (
        classes.select("vec", "uid", "id", "weight")
        .join(counts, "uid", "left")
        .join(roots, "uid", "left")
        .select("vec", "id", F.coalesce("root", "uid").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    smallest = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    known = stored(
        linked.join(smallest, "root").filter("n_links > 0").select(F.col("vec").alias("_vec"), "n_links", "component_id"), "linked"
    )
    return rows.join(known, F.col("vec") == F.col("_vec"), "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.coalesce("component_id", "id").eqNullSafe(F.col("id"))).alias("kept"),
    )
