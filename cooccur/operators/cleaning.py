"""Event-log cleaning: retention window, duplicates, property compression, removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cooccur.config import EventWindow, parse_duration, parse_instant
from cooccur.operators.properties import SET, UNSET, latest_values, property_changes
from cooccur.sources.events import EVENT_COLUMNS, as_time_of
from cooccur.sources.store import publish_model, read_model

#: Rows that a task sorts to collapse copies before they are shuffled, about.
ROWS_PER_TASK = 250_000
BUSINESS_KEY = [c for c in EVENT_COLUMNS if c not in ("event_id", "creation_time")]


def clean_event_window(events: DataFrame, duration, as_of) -> DataFrame:
    """Keep events newer than ``as_of - duration``; property events always stay."""
    oldest = parse_instant(as_of) - parse_duration(duration)
    recent = F.col("event_time") > as_time_of(events, "event_time", oldest)
    return events.where(recent | F.col("event").isin(SET, UNSET))


def _dealt(events: DataFrame, most: int) -> DataFrame:
    """``events`` in tasks of about ``most`` rows, whatever they hold; a small log stays as it is.

    A text in the result of an aggregation makes Spark sort each map task's rows. Files are split by bytes on disk
    and by cores, so without this these rows would grow with the log.
    """
    if events.isStreaming:
        return events
    tasks = -(-events.count() // most)
    if tasks <= events.sparkSession.sparkContext.defaultParallelism:
        return events
    return events.repartition(tasks, F.monotonically_increasing_id())


def dedup_events(events: DataFrame) -> DataFrame:
    """Events alike in all but id and creation time become the earliest of them.

    An aggregation rather than a window: copies collapse inside each map task, so
    one event repeated a billion times is no heavier than any other. The log is counted
    first, and a large one is dealt out in tasks of a bounded number of rows.
    """
    earliest = F.min(F.struct("creation_time", "event_id"))
    return (
        _dealt(events.select(*EVENT_COLUMNS), ROWS_PER_TASK).groupBy(*BUSINESS_KEY)
        .agg(earliest.alias("_first"))
        .select(
            *BUSINESS_KEY,
            F.col("_first.event_id").alias("event_id"),
            F.col("_first.creation_time").alias("creation_time"),
        )
        .select(*EVENT_COLUMNS)
    )


def compress_properties(events: DataFrame) -> DataFrame:
    """Each entity's property chain becomes one ``$set`` with the final values.

    It carries the id and times of the chain's last event. Other events are untouched.
    """
    is_property = F.col("event").isin(SET, UNSET)
    entity = ["entity_type", "entity_id"]
    last = (
        events.where(is_property)
        .groupBy(*entity)
        .agg(
            F.max_by(
                F.struct("event_id", "event_time", "creation_time"),
                F.struct("event_time", "event_id"),
            ).alias("_last")
        )
    )
    values = latest_values(property_changes(events, entity_type=None), entity)
    final = values.groupBy(*entity).agg(
        F.to_json(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))
        ).alias("properties")
    )
    compressed = last.join(final, entity, "left").select(
        F.col("_last.event_id").alias("event_id"),
        F.lit(SET).alias("event"),
        *entity,
        F.lit(None).cast("string").alias("target_entity_type"),
        F.lit(None).cast("string").alias("target_entity_id"),
        F.col("_last.event_time").alias("event_time"),
        F.coalesce("properties", F.lit("{}")).alias("properties"),
        F.col("_last.creation_time").alias("creation_time"),
    )
    return events.where(~is_property).select(*EVENT_COLUMNS).unionByName(compressed)


def remove_events(events: DataFrame, ids: DataFrame) -> DataFrame:
    """Drop the events whose id is listed."""
    return events.join(ids.select("event_id"), "event_id", "left_anti").select(*events.columns)


def clean_events(events: DataFrame, window: EventWindow, as_of) -> tuple[DataFrame, DataFrame]:
    """(kept events, removed ids): window, then duplicates, then compression.

    Nothing is changed in place; :func:`publish_cleaned` makes the kept events a version.
    """
    kept = events.select(*EVENT_COLUMNS)
    if window.duration is not None:
        kept = clean_event_window(kept, window.duration, as_of)
    if window.remove_duplicates:
        kept = dedup_events(kept)
    if window.compress_properties:
        kept = compress_properties(kept)
    removed = events.select("event_id").join(kept.select("event_id"), "event_id", "left_anti")
    return kept, removed


def publish_cleaned(
    events: DataFrame, window: EventWindow, as_of, root: str, name: str = "events"
) -> tuple[DataFrame, DataFrame]:
    """(published events, removed ids): clean and publish the kept events as a new version of ``name``.

    Both frames are read from the version just written.
    """
    kept, _ = clean_events(events, window, as_of)
    publish_model(kept, root, name)
    published = read_model(events.sparkSession, root, name)
    return published, events.select("event_id").join(published.select("event_id"), "event_id", "left_anti")
