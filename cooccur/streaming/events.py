"""Structured Streaming forms of deduplication, popularity and publishing."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cooccur.session import freeze, remove
from cooccur.sources.store import publish_model, read_model


def on_event_time(stream: DataFrame, column: str = "event_time") -> DataFrame:
    """Event time as TIMESTAMP: a watermark cannot be put on a zone-free column."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def stream_dedup(events: DataFrame, watermark: str) -> DataFrame:
    """One row per event id; ids older than the watermark leave the state."""
    return (
        on_event_time(events)
        .withWatermark("event_time", watermark)
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def stream_popular(events: DataFrame, width: str, watermark: str | None) -> DataFrame:
    """(window, item, rank): events per item and tumbling window.

    ``watermark`` is None where the stream already carries one.
    """
    if watermark is not None:
        events = on_event_time(events).withWatermark("event_time", watermark)
    return (
        events.where(F.col("target_entity_id") != "")
        .groupBy(F.window("event_time", width), F.col("target_entity_id").alias("item"))
        .agg(F.count("*").cast("double").alias("rank"))
    )


def _stream_id(batch: DataFrame, checkpoint: str) -> str:
    """The id that the running stream keeps in its checkpoint."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found or hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


def fold_updates(spark: SparkSession, path: str, keys: Sequence[str], due: Sequence[str] = ()) -> list[str]:
    """Write the last row per key of all batches below ``path`` as one folder more, then remove the folders ``due``.

    Returns the folders that the new one stands for; they are due at the next call, which reads
    them once more. So a reader that opened them has until then to finish, and a batch that was being
    written during this call is in the next one whole. Rows keep the ``at`` they were written with:
    being in two folders changes nothing, and later batches go on correcting them.
    """
    rows = spark.read.parquet(path)
    read = sorted({file.rsplit("/", 1)[0] for file in rows.inputFiles()})
    rest = [c for c in rows.columns if c not in (*keys, "run", "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("at", "batch")).alias("_last"))
    last.select(*keys, "_last.*").write.parquet(f"{path}/run=folded/batch={time.time_ns()}")
    for folder in due:
        remove(spark, folder)
    return [folder for folder in read if folder not in due]


def append_updates(
    updates: DataFrame, path: str, checkpoint: str, *, keys: Sequence[str] = ("window", "item"), fold_after: int | None = 100,
) -> StreamingQuery:
    """Write changed aggregates of each batch below ``path`` until the source is drained.

    A batch overwrites its own folder, so a replayed batch leaves one copy. The folder
    carries the stream's id, which lives in its checkpoint: another checkpoint, whose
    batches start at 0 again, adds to what is there. ``at`` orders the batches of all.
    After every ``fold_after`` batches all folders are folded into one by their ``keys``, so what a
    reader folds does not grow with the number of batches: at most the last 2 * ``fold_after`` of
    a stream and the last two folded ones. One of the streams to a path may fold, the others take None.
    """
    due: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        run = _stream_id(batch, checkpoint)
        stamped = batch.withColumn("at", F.lit(time.time_ns()))
        stamped.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")
        if fold_after and (batch_id + 1) % fold_after == 0:
            due[:] = fold_updates(batch.sparkSession, path, keys, due)

    return (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def latest_updates(spark: SparkSession, path: str, keys: list[str], value: str) -> DataFrame:
    """The last value per key over all batches written by :func:`append_updates`."""
    return (
        spark.read.parquet(path)
        .groupBy(*keys)
        .agg(F.max_by(value, F.struct("at", "batch")).alias(value))
    )


def stream_publish(ranks: DataFrame, root: str, name: str, checkpoint: str) -> StreamingQuery:
    """Publish a new version of a (window, item, rank) model after every batch that brings rows.

    Rows of the batch replace rows of the current version with the same window and item.
    Every row carries the stream (the id in its checkpoint) and the batch that wrote it last. A
    batch that the current version already holds - one replayed after a failure - is
    found by that and changes nothing; a new checkpoint, or a model that a batch job has
    published, is gone on from. Versions always grow. Rows of windows that the batch does
    not touch are copied as they are, without a shuffle.
    """
    shown = ["window_start", "item", "rank", "_run", "_batch"]

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, _stream_id(batch, checkpoint)
        fresh = freeze(batch.select(
            F.col("window.start").alias("window_start"), "item", "rank",
            F.lit(run).alias("_run"), F.lit(batch_id).cast("long").alias("_batch"),
        ))  # also where nothing follows: the batch's state has to be committed with it
        old = read_model(spark, root, name)
        if old is not None:
            old = old.select(*[F.col(c) if c in old.columns else F.lit(None).alias(c) for c in shown])
            if not old.where((F.col("_run") == run) & (F.col("_batch") >= batch_id)).isEmpty():
                return
        if fresh.isEmpty():
            return
        if old is None:
            publish_model(fresh, root, name)
            return
        touched = fresh.select("window_start").distinct()
        rest = old.join(touched, "window_start", "left_anti").select(*shown)
        again = old.join(touched, "window_start", "left_semi").select(*shown).withColumn("_new", F.lit(False))
        merged = again.unionByName(fresh.withColumn("_new", F.lit(True))).groupBy("window_start", "item").agg(
            F.max_by(F.struct("rank", "_run", "_batch"), "_new").alias("_last")
        ).select("window_start", "item", "_last.*")
        publish_model(rest.unionByName(merged), root, name)

    return (
        ranks.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
    )
