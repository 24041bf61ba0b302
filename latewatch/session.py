"""Session set-up, durable lineage cuts, caching and timing helpers."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIMINGS: dict[str, float] = {}


def build_session(
    app_name: str = "latewatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: object,
) -> SparkSession:
    """Create (or fetch) a session.

    ``master`` and ``shuffle_partitions`` are left to the cluster unless given. Partition
    coalescing and skew-join splitting stay on so that partition sizes follow the data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Longer generated methods are not compiled by the JVM; let Spark split them instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Recording the calling line of every expression costs more than building it.
        "spark.sql.dataFrameQueryContext.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = shuffle_partitions
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session, preferring the one the cluster names.

    A folder of our own is made only for local masters; a cluster must name a shared one,
    because files on one machine are gone when that machine is.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if named:
        context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="latewatch-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def modest_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """From now on Arrow batches of the session hold so many rows at most.

    A batch of whole texts is held by the JVM and by a Python worker at a time; with Spark's 10,000 rows that is tens of
    MB each, which neither gives back. A smaller setting stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table under the shared checkpoint folder: what reads it later reads only its columns."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4()}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def cached(*frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[tuple[DataFrame, ...]]:
    """Persist frames for the length of a block (spilling to disk) and release them after."""
    held = tuple(frame.persist(level) for frame in frames)
    try:
        yield held
    finally:
        for frame in held:
            frame.unpersist()


@contextmanager
def timed(label: str, into: dict[str, float] | None = None) -> Iterator[None]:
    """Record the wall-clock seconds of a block; put an action inside it."""
    target = TIMINGS if into is None else into
    start = time.perf_counter()
    try:
        yield
    finally:
        target[label] = time.perf_counter() - start


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per partition, which shows both the partition count and any skew."""
    return (
        df.groupBy(F.spark_partition_id().alias("partition_id"))
        .agg(F.count("*").alias("rows"))
        .orderBy("partition_id")
    )


def spread(df: DataFrame, partitions: int | None = None, *keys: str) -> DataFrame:
    """Repartition evenly, or by key.

    Written as the REBALANCE hint: rows with equal keys sit together as far as possible, but
    adaptive execution splits a partition that one hot key makes too large and merges small ones.
    """
    arguments: list[object] = [] if partitions is None else [partitions]
    return df.hint("rebalance", *arguments, *keys)
