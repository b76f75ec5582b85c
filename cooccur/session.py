"""Session helpers: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cooccur", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else a folder in the warehouse.

    Both are on file systems that the driver and all executors reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    created = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    spark.sparkContext.setCheckpointDir(created)
    return created


def session_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/cooccur-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, below the application's folder."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def allow_group_limit(spark: SparkSession, bound: int) -> None:
    """Let windows that keep ``bound`` rows of a group drop the others before the shuffle."""
    if int(spark.conf.get(GROUP_LIMIT)) < bound:
        spark.conf.set(GROUP_LIMIT, str(bound))


@contextmanager
def group_limit(spark: SparkSession, bound: int) -> Iterator[None]:
    """Like :func:`allow_group_limit`, for what is run inside the block only."""
    before = spark.conf.get(GROUP_LIMIT)
    allow_group_limit(spark, bound)
    try:
        yield
    finally:
        spark.conf.set(GROUP_LIMIT, before)


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Send rows to Python tasks in Arrow batches of about ``most`` bytes, for what is run inside the block only.

    A batch is held several times on its way: as vectors and as a growing buffer outside the heap, and in the
    worker. A longer row is a batch of its own.
    """
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


#: Share of the driver's largest heap from which on :func:`collect_garbage` collects.
GARBAGE_SHARE = 0.25


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver let go of what finished queries left in its heap, unless that is little.

    Each query leaves plans, generated code and broadcast tables behind. The JVM rather grows its heap
    to the limit than collect them early, and only then gives back memory and the broadcasts' copies
    on executors. Used between the steps of a job of many queries.
    """
    runtime = spark.sparkContext._jvm.Runtime.getRuntime()
    if runtime.totalMemory() - runtime.freeMemory() > GARBAGE_SHARE * runtime.maxMemory():
        spark.sparkContext._jvm.System.gc()


#: Lets a query that is through remove its own shuffle files, which otherwise stay until the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables written inside each open :func:`scratch` block, innermost last.
_SCRATCH: list[list[str]] = []


@contextmanager
def _own_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _written(df: DataFrame, label: str = "table") -> str:
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return path


def freeze(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Used where a result feeds several branches of a plan: it is computed once, the
    branches keep column pruning and file statistics, and a lost executor costs a
    re-read, not a recomputation. The shuffle files of the query that writes it go when
    it is through. Inside a :func:`scratch` block the table lasts as long as the block;
    a table to ``keep`` lasts as long as the block around that one. :func:`release`
    removes all tables.
    """
    return freeze_all(df, keep=keep)[0]


def freeze_all(*frames: DataFrame, keep: bool = False) -> list[DataFrame]:
    """Freeze independent frames at the same time, so one job's stragglers do not idle the cluster."""
    spark = frames[0].sparkSession
    with _own_shuffles_removed(spark):
        if len(frames) == 1:
            paths = [_written(frames[0])]
        else:
            with ThreadPoolExecutor(len(frames)) as pool:
                paths = list(pool.map(inheritable_thread_target(spark)(_written), frames))
    blocks = _SCRATCH[:-1] if keep else _SCRATCH
    if blocks:
        blocks[-1].extend(paths)
    tables = [spark.read.schema(df.schema).parquet(path) for df, path in zip(frames, paths)]
    for table, path in zip(tables, paths):
        table.frozen_at = path
    return tables


def discard(*tables: DataFrame) -> None:
    """Remove frozen tables that nothing will read any more."""
    for table in tables:
        remove(table.sparkSession, table.frozen_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables frozen inside the block at its end, but those to keep.

    What leaves the block must rest on kept tables and on the block's inputs only.
    """
    made: list[str] = []
    _SCRATCH.append(made)
    try:
        yield
    finally:
        _SCRATCH.remove(made)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system with all in it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def release(spark: SparkSession) -> None:
    """Remove the application's intermediate tables; frames built on them become unreadable."""
    remove(spark, session_dir(spark))
