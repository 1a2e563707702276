"""A Merkle manifest of a table, kept as postorder append logs.

Rows become leaf digests, ordered by key within their group; every eight
consecutive nodes become one node of the next level, the last ones of a level
fewer, until one is left: the group's subroot. The subroots, in the order of
the groups, form one more tree of the same kind, whose last node is the root.

A tree's leaves are cut into aligned blocks of ``8 ** BLOCK_LEVELS``. A block's
builder appends nodes to its log as they are completed: leaf after leaf, and a
parent as soon as its last child stands. So a log is in postorder, and where a
node stands follows from subtree sizes alone: after all nodes that are
completed before its first leaf, and after its own subtree. A proof's siblings
are read at such positions; nothing is searched. The blocks' last nodes are the
leaves of the next tier's blocks.

Digests are SHA-256; a node's is that of its children's lowercase hex digests,
one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.llm.common import stored
from relmod.operators.ordering import dense_index
from relmod.session import broadcast_if_small

FAN_BITS = 3
FAN = 1 << FAN_BITS
#: Levels that one builder closes above its leaves.
BLOCK_LEVELS = 4
BLOCK_BITS = FAN_BITS * BLOCK_LEVELS
BLOCK = 1 << BLOCK_BITS
#: Sides up to so many bytes are broadcast.
BROADCAST_BYTES = 32 << 20
DIGEST = 64

_TOP = -1  # the tree of the subroots


# ---------------------------------------------------------------- closed forms


def nodes_at(level: int, leaves: int) -> int:
    """Nodes that ``leaves`` leaves have at a level."""
    return -(-leaves >> FAN_BITS * level)


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    level = 0
    while nodes_at(level, leaves) > 1:
        level += 1
    return level


def subtree_size(level: int, leaves: int) -> int:
    """Nodes of a subtree of ``level`` levels above its ``leaves`` leaves."""
    return sum(nodes_at(k, leaves) for k in range(level + 1))


def position(level: int, index: int, leaves: int) -> int:
    """Where the postorder log of a tree of ``leaves`` leaves holds node ``index`` of a level."""
    start = index << FAN_BITS * level
    own = min(1 << FAN_BITS * level, leaves - start)
    before, at = 0, start  # nodes completed before the subtree's first leaf: complete runs of every level
    while at:
        before += at
        at >>= FAN_BITS
    return before + subtree_size(level, own) - 1


def run_of(level: int, index: int, leaves: int) -> range:
    """The nodes that share a parent with node ``index`` of a level, itself included."""
    first = index >> FAN_BITS << FAN_BITS
    return range(first, min(first + FAN, nodes_at(level, leaves)))


# ---------------------------------------------------------------- one block


def digest_of(children: bytes) -> bytes:
    return hashlib.sha256(children).hexdigest().encode()


def append_log(leaves: list[bytes], levels: int) -> bytes:
    """The leaves' and their ancestors' hex digests in the order of completion, ``levels`` levels up."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def add(level: int, digest: bytes) -> None:
        log.append(digest)
        if level < levels:
            waiting[level].append(digest)
            if len(waiting[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        children, waiting[level] = waiting[level], []
        add(level + 1, digest_of(b"".join(children)))

    for leaf in leaves:
        add(0, leaf)
    for level in range(levels):
        if waiting[level]:
            close(level)
    return b"".join(log)


def siblings(log: bytes, at: int, leaves: int, levels: int) -> bytes:
    """The hex digests beside leaf ``at``'s path in a block's log, level by level, left to right."""
    out = []
    for level in range(levels):
        for i in run_of(level, at, leaves):
            if i != at:
                place = DIGEST * position(level, i, leaves)
                out.append(log[place : place + DIGEST])
        at >>= FAN_BITS
    return b"".join(out)


def fold(digest: bytes, proof: bytes, trees: list[tuple[int, int]]) -> bytes:
    """The root that a leaf and its proof give; ``trees`` are (index, leaves) of the leaf's tree and those above it."""
    at = 0
    for index, leaves in trees:
        for level in range(height(leaves)):
            run = run_of(level, index, leaves)
            middle, end = at + DIGEST * (index - run.start), at + DIGEST * (len(run) - 1)
            digest = digest_of(proof[at:middle] + digest + proof[middle:end])
            at, index = end, index >> FAN_BITS
    return digest


# ---------------------------------------------------------------- tables


class Manifest(NamedTuple):
    """What ``build`` writes; every table is stored in the session's shared folder.

    leaves: tree, index, key, leaf, altered (hex as binary; null where nothing is altered), leaves (of its tree)
    trees:  tree (rank of the group), group, leaves, subroot, root, trees (how many there are)
    log:    tree (-1: that of the subroots), tier, block, leaves (of the tier's tree), log (hex digests, 64 bytes each)
    tiers:  how many tiers the largest tree of each kind (groups, subroots) has
    """

    leaves: DataFrame
    trees: DataFrame
    log: DataFrame
    tiers: tuple[int, int]


def field(c: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null as ``-``."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def _leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in values]), 256)


def _tiers(leaves: int) -> int:
    n = 1
    while leaves > BLOCK:
        leaves, n = nodes_at(BLOCK_LEVELS, leaves), n + 1
    return n


def _block(index: str) -> Column:
    return F.shiftright(index, BLOCK_BITS).alias("block")


_LOG_SCHEMA = "tree long, block long, leaves long, log binary"


def _append(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("index")
    leaves = rows.column("leaves")[0].as_py()
    log = append_log(rows.column("digest").to_pylist(), min(BLOCK_LEVELS, height(leaves)))
    return pa.table(
        [[key[0].as_py()], [key[1].as_py()], [leaves], [log]],
        schema=pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("leaves", pa.int64()), ("log", pa.binary())]),
    )


def _build_tiers(rows: DataFrame, tiers: int, name: str) -> DataFrame:
    """Logs of all tiers of (tree, index, digest, leaves)."""
    out = None
    for tier in range(tiers):
        logs = stored(rows.groupBy("tree", _block("index")).applyInArrow(_append, _LOG_SCHEMA), f"{name}_{tier}")
        out = logs.withColumn("tier", F.lit(tier)) if out is None else out.unionByName(logs.withColumn("tier", F.lit(tier)))
        rows = logs.filter(F.col("leaves") > BLOCK).select(
            "tree", F.col("block").alias("index"), _last().alias("digest"), _up("leaves").alias("leaves")
        )
    return out


def _last() -> Column:
    """A log's last digest."""
    return F.substring("log", -DIGEST, DIGEST)


def _up(leaves: str) -> Column:
    """Blocks of a tree, which are the leaves of its next tier."""
    return F.shiftright(F.col(leaves) + (BLOCK - 1), BLOCK_BITS)


def build(
    df: DataFrame, columns: list[str], key: str = "doc_id", group: str = "lang", altered: dict[str, Column] | None = None
) -> Manifest:
    """Leaf digests of ``columns``' values, the trees of all groups and the tree over them.

    Leaves are ordered by ``key``, then by their digests: repeated keys are
    leaves of their own, equal rows equal leaves. Nulls are values; a null key
    or group comes first. Groups are ordered by their UTF-8 bytes, one of a
    single row has that leaf as its subroot. An empty table has no tree. Other
    columns are not read. ``altered`` gives other values of some columns, whose
    digests stand beside the leaves for checks; the trees hold the true ones.

    Texts are read once and leave only digests. The order is one range
    partitioning over all rows, so a group may hold any share of them.
    """
    values = [F.col(c) for c in columns]
    changed = F.lit(None).cast("string")
    if altered:
        others = [altered.get(c, F.col(c)) for c in columns]
        same = F.lit(True)
        for c, new in altered.items():
            same = same & F.col(c).eqNullSafe(new)
        changed = F.when(~same, _leaf(others))
    digests = stored(
        df.select(
            F.col(key).alias("key"),
            F.col(group).alias("group"),
            _leaf(values).cast("binary").alias("leaf"),
            changed.cast("binary").alias("altered"),
        ),
        "leaves",
    )
    placed = dense_index(digests, [F.asc("group"), F.asc("key"), F.asc("leaf")], "place")
    spans = placed.groupBy("group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("leaves"))
    trees = stored(dense_index(spans, [F.asc("first")], "tree"), "trees")
    first = broadcast_if_small(trees.withColumnRenamed("group", "_group"), BROADCAST_BYTES)
    leaves = stored(
        placed.join(first, F.col("group").eqNullSafe(F.col("_group"))).select(
            "tree", (F.col("place") - F.col("first")).alias("index"), "key", "leaf", "altered", "leaves"
        ),
        "placed",
    )
    count, most = trees.agg(F.count(F.lit(1)), F.max("leaves")).first()
    tiers = _tiers(most or 0), _tiers(count)
    log = _build_tiers(leaves.select("tree", "index", F.col("leaf").alias("digest"), "leaves"), tiers[0], "log")
    subroots = log.filter(F.col("leaves") <= BLOCK).select("tree", _last().alias("subroot"))
    tops = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("index"), F.col("subroot").alias("digest"), F.lit(count).cast("long").alias("leaves")
    )
    over = _build_tiers(tops, tiers[1], "top")
    root = over.filter(F.col("leaves") <= BLOCK).select(_last().alias("root"))  # one row
    known = stored(
        trees.drop("first")
        .join(subroots.withColumn("subroot", F.col("subroot").cast("string")), "tree")
        .join(F.broadcast(root.select(F.col("root").cast("string"))))
        .withColumn("trees", F.lit(count).cast("long")),
        "roots",
    )
    return Manifest(leaves, known, log.unionByName(over), tiers)


_PATH_SCHEMA = "tree long, index long, path binary"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (tree, block, leaves, log, path): every leaf's path, the block's own one at its end."""
    for batch in batches:
        for tree, block, leaves, log, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            low = block << BLOCK_BITS
            own = min(BLOCK, leaves - low)
            levels = min(BLOCK_LEVELS, height(leaves))
            found = [siblings(log, at, own, levels) + path for at in range(own)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * own, pa.int64()), pa.array(range(low, low + own), pa.int64()), pa.array(found, pa.binary())],
                ["tree", "index", "path"],
            )


def _with_paths(log: DataFrame, tier: int, above: DataFrame, roots: DataFrame) -> DataFrame:
    """A tier's logs with the path of each block's last node: in the next tier, or from its tree's root on."""
    logs = log.filter(F.col("tier") == tier)
    up = above.select("tree", F.col("index").alias("block"), F.col("path").alias("_up"))
    on = roots.select("tree", F.col("path").alias("_on"))
    joined = logs.join(up, ["tree", "block"], "left").join(broadcast_if_small(on, BROADCAST_BYTES), "tree", "left")
    path = F.when(F.col("leaves") > BLOCK, F.col("_up")).otherwise(F.col("_on"))
    return joined.select("tree", "block", "leaves", "log", F.coalesce(path, F.lit(b"")).alias("path"))


def _upper_paths(log: DataFrame, tiers: int, down_to: int, roots: DataFrame) -> DataFrame:
    """(tree, index, path) of the leaves of tier ``down_to``, from the highest tier down."""
    above = log.sparkSession.createDataFrame([], _PATH_SCHEMA)
    for tier in range(tiers - 1, down_to - 1, -1):
        above = stored(_with_paths(log, tier, above, roots).mapInArrow(_paths, _PATH_SCHEMA), f"paths_{tier}")
    return above


def proofs(manifest: Manifest, with_proof: bool = True) -> DataFrame:
    """One row per leaf: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    A proof is the hex digests of the siblings on the way to the root, level by
    level, left to right, first in the group's tree, then in that of the
    subroots; ``proof`` has it whole unless left out. ``folded_root`` is
    recomputed from it and the altered leaf, or the true one where nothing is
    altered; ``verified`` tells whether that is the root. Leaves meet their
    block's log once; a task holds one block of leaves at a time.
    """
    none = manifest.log.sparkSession.createDataFrame([], "tree long, path binary")
    groups, tops = manifest.log.filter(F.col("tree") != _TOP), manifest.log.filter(F.col("tree") == _TOP)
    roots = _upper_paths(tops, manifest.tiers[1], 0, none).select(F.col("index").alias("tree"), "path")
    above = _upper_paths(groups, manifest.tiers[0], 1, roots)
    known = manifest.trees.select("tree", "subroot", "root", "trees")
    logs = _with_paths(groups, 0, above, roots).join(broadcast_if_small(known, BROADCAST_BYTES), "tree")
    key = manifest.leaves.schema["key"].dataType
    text = T.StringType()
    fields = [("key", key), ("leaf", text), ("subroot", text), ("root", text), ("proof_sha256", text), ("folded_root", text), ("verified", T.BooleanType())]
    if with_proof:
        fields.append(("proof", text))
    schema = T.StructType([T.StructField(*f) for f in fields])

    def prove(rows: pa.Table, log: pa.Table) -> pa.Table:
        tree, block, leaves, trees = (log.column(c)[0].as_py() for c in ("tree", "block", "leaves", "trees"))
        nodes, path, subroot, root = (log.column(c)[0].as_py() for c in ("log", "path", "subroot", "root"))
        low = block << BLOCK_BITS
        own, levels = min(BLOCK, leaves - low), min(BLOCK_LEVELS, height(leaves))
        found, folded = [], []
        for index, leaf, other in zip(*(rows.column(c).to_pylist() for c in ("index", "leaf", "altered")), strict=True):
            proof = siblings(nodes, index - low, own, levels) + path
            found.append(proof)
            folded.append(fold(leaf if other is None else other, proof, [(index, leaves), (tree, trees)]).decode())
        n = rows.num_rows
        columns = [
            rows.column("key"),
            rows.column("leaf").cast(pa.string()),
            pa.array([subroot] * n, pa.string()),
            pa.array([root] * n, pa.string()),
            pa.array([hashlib.sha256(p).hexdigest() for p in found], pa.string()),
            pa.array(folded, pa.string()),
            pa.array([f == root for f in folded], pa.bool_()),
        ]
        if with_proof:
            columns.append(pa.array([p.decode() for p in found], pa.string()))
        return pa.table(columns, names=schema.names)

    leaves = manifest.leaves.drop("leaves").groupBy("tree", _block("index"))
    return leaves.cogroup(logs.groupBy("tree", "block")).applyInArrow(prove, schema)


def log_entries(manifest: Manifest) -> DataFrame:
    """The append logs node by node: tree (-1: that of the subroots), position, level, index, digest.

    Positions are those of the whole tree's postorder log, whatever block or
    tier wrote the node.
    """
    schema = "tree long, position long, level int, index long, digest string"

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, tier, block, tier_leaves, total, log in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low = block << BLOCK_BITS
                own, levels = min(BLOCK, tier_leaves - low), min(BLOCK_LEVELS, height(tier_leaves))
                rows = []
                for level in range(1 if tier else 0, levels + 1):  # a tier's leaves are the tier before's last nodes
                    for i in range(nodes_at(level, own)):
                        at, index = DIGEST * position(level, i, own), (low >> FAN_BITS * level) + i
                        over = tier * BLOCK_LEVELS + level
                        rows.append((tree, position(over, index, total), over, index, log[at : at + DIGEST].decode()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True)]
                    if rows
                    else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())],
                    ["tree", "position", "level", "index", "digest"],
                )

    totals = manifest.log.filter("tier = 0").groupBy("tree").agg(F.max("leaves").alias("total"))
    rows = manifest.log.join(broadcast_if_small(totals, BROADCAST_BYTES), "tree")
    return rows.select("tree", "tier", "block", "leaves", "total", "log").mapInArrow(entries, schema)


# ---------------------------------------------------------------- SQL


def proofs_sql(rows: str, levels: int = 9, top_levels: int = 4) -> str:
    """SQL of ``proofs`` over ``rows`` (doc_id, grp, leaf, altered), for trees of at most 8 ** levels leaves."""
    parts = [
        f"r AS ({rows})",
        "z AS (SELECT *, dense_rank() OVER (ORDER BY grp NULLS FIRST) AS g,"
        " row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM r)",
    ]

    def climb(t: str, f: str, start: str, begin: str, n: int) -> None:
        parts.append(f"{t}0 AS ({start})")
        parts.append(f"{f}0 AS ({begin})")
        for k in range(n):
            run = "PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
            parts.append(
                f"{t}s{k} AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS c,"
                f" coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
                f" coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {t}{k})"
            )
            parts.append(
                f"{t}{k + 1} AS (SELECT g, i // 8 AS i, CASE WHEN any_value(c) > 1 THEN sha256(string_agg(h, '' ORDER BY i))"
                f" ELSE any_value(h) END AS h FROM {t}s{k} GROUP BY g, i // 8)"
            )
            parts.append(
                f"{f}{k + 1} AS (SELECT f.* REPLACE (f.i // 8 AS i, proof || l || r AS proof,"
                f" CASE WHEN c > 1 THEN sha256(l || cur || r) ELSE cur END AS cur) FROM {f}{k} f JOIN {t}s{k} s ON f.g = s.g AND f.i = s.i)"
            )

    climb("t", "f", "SELECT g, i, leaf AS h FROM z", "SELECT doc_id, leaf, g, i, '' AS proof, coalesce(altered, leaf) AS cur FROM z", levels)
    climb(
        "u",
        "v",
        f"SELECT 0 AS g, g - 1 AS i, h FROM t{levels}",
        f"SELECT f.* REPLACE (0 AS g, f.g - 1 AS i), h AS subroot FROM f{levels} f JOIN t{levels} t ON f.g = t.g",
        top_levels,
    )
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256,"
        f" cur AS folded_root, cur = h AS verified FROM v{top_levels} CROSS JOIN (SELECT h FROM u{top_levels})"
    )
