"""Event-log scans (EVENTS) and their split into actions (ACTIONS).

EVENTS   event_id, event, entity_type, entity_id, target_entity_type,
         target_entity_id, event_time, properties, creation_time
ACTIONS  event, user, item, ts

Everything is a filter plus a projection, so names, times and columns reach the
file scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.config import parse_instant

EVENT_COLUMNS = [
    "event_id", "event", "entity_type", "entity_id", "target_entity_type",
    "target_entity_id", "event_time", "properties", "creation_time",
]


def as_time_of(df: DataFrame, column: str, value) -> Column:
    """``value`` as a literal of the column's own time type, so the filter pushes down."""
    instant = parse_instant(value)
    if instant is None:
        raise ValueError(f"not an instant: {value!r}")
    return F.lit(instant.isoformat(sep=" ")).cast(df.schema[column].dataType)


def scan_events(
    df: DataFrame,
    app: str | None = None,
    entity_type: str | None = "user",
    target_type: str | None = "item",
    names: Iterable[str] | None = None,
    start=None,
    until=None,
) -> DataFrame:
    """Events of an app and entity types, ``start <= event_time < until``."""
    if app is not None:
        if "app" not in df.columns:
            raise ValueError("the event log has no column 'app' to select an app by")
        df = df.where(F.col("app") == app)
    if entity_type is not None:
        df = df.where(F.col("entity_type") == entity_type)
    if target_type is not None:
        df = df.where(F.col("target_entity_type") == target_type)
    if names is not None:
        df = df.where(F.col("event").isin(list(names)))
    return _between(df, "event_time", start, until)


def app_events(df: DataFrame, app: str) -> DataFrame:
    """The events of one app. A log without a column ``app`` is that of a single app."""
    return scan_events(df, app, None, None) if "app" in df.columns else df


def _between(df: DataFrame, column: str, start, until) -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= as_time_of(df, column, start))
    if until is not None:
        df = df.where(F.col(column) < as_time_of(df, column, until))
    return df


def split_actions(events: DataFrame, names: Iterable[str]) -> DataFrame:
    """One (event, user, item, ts) row per event that names a user and an item."""
    return (
        events.where(F.col("event").isin(list(names)))
        .where((F.col("entity_id") != "") & (F.col("target_entity_id") != ""))
        .select(
            "event",
            F.col("entity_id").alias("user"),
            F.col("target_entity_id").alias("item"),
            F.col("event_time").alias("ts"),
        )
    )


def events_in_interval(
    actions: DataFrame, start, end, names: Iterable[str] | None = None, ts: str = "ts"
) -> DataFrame:
    """Rows with ``start <= ts < end``; no names means every event type."""
    names = list(names or [])
    if names:
        actions = actions.where(F.col("event").isin(names))
    return _between(actions, ts, start, end)


def recent_events_by_entity(
    events: DataFrame, users: DataFrame, names: Iterable[str], limit: int
) -> DataFrame:
    """The ``limit`` latest events per (user, event type), newest first.

    The bound is checked before and after the shuffle, so a user holding a large
    part of the log sends at most ``limit`` rows per map task.
    """
    newest = W.partitionBy("entity_id", "event").orderBy(F.desc("event_time"), F.desc("event_id"))
    wanted = users.select(F.col("user").alias("entity_id")).distinct()
    return (
        events.where(F.col("entity_type") == "user")
        .where(F.col("event").isin(list(names)))
        .join(wanted, "entity_id", "left_semi")
        .withColumn("recency", F.row_number().over(newest))
        .where(F.col("recency") <= limit)
    )
