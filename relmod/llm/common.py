"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import math
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relmod.session import scratch_dir

#: The white space of the text contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of the session and continue from the files.

    Cuts the lineage; a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def tasks_for(rows: int, rows_per_task: int, spark: SparkSession) -> int:
    """Partitions that hold about ``rows_per_task`` rows each, and at least one for each shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_per_task))


def squeezed(text: Column) -> Column:
    """The text without any white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", "")


def keys_of(rows, keys: int) -> np.ndarray:
    """The first ``keys`` columns, integers, as a matrix."""
    return np.stack([rows.column(i).to_numpy().astype(np.int64) for i in range(keys)], axis=1)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Batches sorted by their first ``keys`` columns, cut anew so that no group is in two of them."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        group = keys_of(batch, keys)
        cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
        if not len(cuts) and (group[0] == keys_of(rest[0].slice(0, 1), keys)[0]).all():
            continue
        whole = pa.Table.from_batches(rest)
        end = whole.num_rows - batch.num_rows + (int(cuts[-1]) if len(cuts) else 0)
        yield whole.slice(0, end)
        rest = whole.slice(end).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def group_bounds(group: np.ndarray) -> np.ndarray:
    """Where the groups of sorted keys start, and the end."""
    return np.concatenate([[0], np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1, [len(group)]])


def in_blocks(rows: DataFrame, length: Column, uid: str, most: int) -> DataFrame:
    """``rows`` with the columns block, left and right: a group of more than ``most`` rows becomes pairs of blocks.

    Every pair of a group's rows is in exactly one of the groups (left, right):
    rows of one block where left equals right, of both blocks elsewhere.
    """
    blocks = F.greatest(F.ceil(length / F.lit(most)), F.lit(1)).cast("int")
    return (
        rows.withColumn("block", F.pmod(F.xxhash64(uid), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("left", F.least("block", "_other"))
        .withColumn("right", F.greatest("block", "_other"))
        .drop("_other")
    )


def kept_in_worker(call: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a Python worker for all its tasks of one ``call``.

    Functions reach a worker by value with every task, so it is held by a
    module of the worker's own; another call's thing takes its place.
    """
    held = sys.modules.setdefault("_relmod_kept", types.ModuleType("_relmod_kept")).__dict__
    if held.get("call") != call:
        held["thing"] = None
        held.update(call=call, thing=make())
    return held["thing"]


def give_back() -> None:
    """Returns freed memory to the system, so that a worker does not hold on to the peak of its largest batch."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
