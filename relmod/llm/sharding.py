"""Sharding by jump consistent hashing [native].

Every row's integer key seeds a linear congruential generator; its draws make
the row jump forward over shard numbers, and the last jump below the shard
count is its shard. There is no ring table: a row's shard depends on its key
and the shard count alone, and one more shard takes 1/(n+1) of the rows of
every old shard and moves no other row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relmod.llm.common import stored
from relmod.operators.ordering import dense_index

#: Fixed value: the multiplier of the generator in the published algorithm, as two 32-bit halves.
MULTIPLIER = 2862933555777941757
_M_HIGH, _M_LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW32 = 0xFFFFFFFF
#: A key jumps about ln(shards) times; it needs as many steps as shards at worst.
#: Beyond so many shards, the steps end here (the chance that a key needs more is below 1e-200).
MOST_STEPS = 320


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_LOW32))


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2^64 in 32-bit halves, as 64-bit products would overflow."""
    low16, high16 = _M_LOW & 0xFFFF, _M_LOW >> 16
    p0 = lo * low16
    p1 = lo * high16
    low = _low(p0) + F.shiftleft(p1.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    high = (
        F.shiftright(p0, 32)
        + F.shiftright(p1, 16)
        + F.shiftright(low, 32)
        + _low(lo * _M_HIGH)
        + _low(hi * low16)
        + F.shiftleft((hi * high16).bitwiseAND(F.lit(0xFFFF)), 16)
    )
    return _low(high), _low(low)


def jump(key: Column, shards: int) -> Column:
    """struct(shard, grown_shard): the shard among ``shards`` and among ``shards + 1``.

    ``key`` is a bigint; null counts as 0.
    """
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    long = F.lit(0).cast("long")
    start = F.struct(
        _low(F.shiftrightunsigned(key, 32)).alias("hi"),
        _low(key).alias("lo"),
        long.alias("at"),
        long.alias("shard"),
        long.alias("grown"),
    )

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next(s["hi"], s["lo"])
        to = F.floor((s["at"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double")))
        here = F.struct(
            hi.alias("hi"),
            lo.alias("lo"),
            to.cast("long").alias("at"),
            F.when(s["at"] < shards, s["at"]).otherwise(s["shard"]).alias("shard"),
            s["at"].alias("grown"),
        )
        return F.when(s["at"] <= shards, here).otherwise(s)

    steps = F.sequence(F.lit(1), F.lit(min(shards + 1, MOST_STEPS)))
    return F.aggregate(
        steps,
        start,
        step,
        lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown_shard")),
    )


def shard_rows(df: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """All columns of ``df`` with ``shard`` and ``grown_shard`` (replaced if ``df`` has such columns)."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("shard", "grown_shard")]
    j = jump(F.col(key), shards)
    return df.select(*kept, j.alias("_jump")).select(
        *kept, F.col("_jump.shard").alias("shard"), F.col("_jump.grown_shard").alias("grown_shard")
    )


def write_shards(df: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """One folder per shard. Rows reach several tasks per shard, as no task is given a whole one."""
    shard_rows(df, shards, key).write.partitionBy("shard").parquet(path)


def manifest(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: where it goes and in which slot of its shard.

    Columns: doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law
    ('key'), shard, slot (gapless from 0 in each shard, in order of the key),
    grown_shard. Null text is empty, a null key counts as 0 for its shard and
    stays null in the result. Repeated keys share a shard and have slots of
    their own; an empty table gives an empty result. Other columns are not
    read.

    The slots come from one range-partitioned order over (shard, key): a shard
    may spread over many tasks, so neither a large shard nor a hot key gathers
    in one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump(F.col(key), shards).alias("_jump"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = stored(
        rows.select("doc_id", "size", "text_crc32", "_jump.shard", "_jump.grown_shard", "_row"), "shards"
    )
    numbered = dense_index(
        rows, [F.asc("shard"), F.asc("doc_id"), F.asc("size"), F.asc("text_crc32"), F.asc("_row")], "_at"
    )
    first = numbered.groupBy("shard").agg(F.min("_at").alias("_first"))  # as many rows as shards
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_at") - F.col("_first")).alias("slot"),
        "grown_shard",
    )
