"""Session helpers: local session for tests/bench, shared scratch folders, checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "relmod") -> SparkSession:
    """A local session configured the way the library expects (tests, bench)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # tables partitioned by qid are then joined on (qid, term) without another exchange
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxPlanStringLength", "65536")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("RELMOD_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local session may leave it unset; it gets a fresh folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh sub-folder of the shared checkpoint folder (for written tables/files)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def bytes_of(df: DataFrame) -> int:
    """Bytes of the values of ``df``: strings and binaries by length, arrays by eight bytes an element, others eight."""

    def width(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if isinstance(f.dataType, T.ArrayType):
            return F.greatest(F.size(c), F.lit(0)) * 8 + 16
        return F.lit(8)

    row = sum((width(f) for f in df.schema.fields), F.lit(16))
    return int(df.agg(F.sum(row.cast("long"))).first()[0] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast ``df`` only when its measured values take at most ``max_bytes``.

    Beyond the bound the frame is returned unchanged and Spark chooses the
    join. Measuring runs a job on the frame; callers pass sides that are cheap
    to compute (queries, query terms, stored tables).
    """
    return F.broadcast(df) if bytes_of(df) <= max_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition before CPU-heavy text work when the input has
    fewer partitions than the cluster has task slots (e.g. a single Parquet
    row group); inputs that are already split are left alone."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


#: Rows of text that one task takes.
ROWS_PER_TASK = 4096


def spread_by(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Partitioned by ``key`` into parts of about ``rows_per_task`` rows, one per task slot at least.

    CPU-heavy text work then takes a bounded time in every task, however the
    input's files are cut, and groupings by the key add no exchange.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(slots, -(-df.count() // rows_per_task)), key)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Cuts the lineage (later plans start from a small scan instead of the
    whole derivation, and a lost executor re-reads the files rather than
    recomputing), while keeping the output partitioning, so tables
    partitioned by qid stay co-located.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
