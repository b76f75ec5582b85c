"""Item properties: folding ``$set``/``$unset`` chains and combining sources.

PROPS is long - (item, key, value) with raw text values - so every combination rule
is an aggregation with a map-side step, not a fold over one entity's events.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cooccur.functions.typed import typed_value

SET, UNSET = "$set", "$unset"


def property_changes(events: DataFrame, entity_type: str | None = "item") -> DataFrame:
    """One row per touched key: (entity_type, entity_id, key, value, op, ts, event_id)."""
    if entity_type is not None:
        events = events.where(F.col("entity_type") == entity_type)
    touched = F.explode(F.from_json("properties", "map<string,string>")).alias("key", "value")
    return events.where(F.col("event").isin(SET, UNSET)).select(
        "entity_type", "entity_id", touched, F.col("event").alias("op"),
        F.col("event_time").alias("ts"), "event_id",
    )


def latest_values(changes: DataFrame, by: Sequence[str] = ("item",)) -> DataFrame:
    """Last writer per key wins; a key whose last change is ``$unset`` is gone.

    ``changes`` has the ``by`` columns and key, value, op, ts, event_id.
    """
    last = F.max_by(F.struct("op", "value"), F.struct("ts", "event_id"))
    return (
        changes.groupBy(*by, "key")
        .agg(last.alias("last"))
        .where(F.col("last.op") == SET)
        .select(*by, "key", F.col("last.value").alias("value"))
        .where("value is not null")
    )


def aggregate_properties(events: DataFrame, entity_type: str = "item") -> DataFrame:
    """PROPS of one entity type."""
    changes = property_changes(events, entity_type).withColumnRenamed("entity_id", "item")
    return latest_values(changes)


def props_to_map(props: DataFrame) -> DataFrame:
    """(item, props MAP). A map holds one entry per key of the item, no more."""
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    return props.groupBy("item").agg(F.map_from_entries(entries).alias("props"))


def map_to_props(maps: DataFrame) -> DataFrame:
    return maps.select("item", F.explode("props").alias("key", "value"))


def combine_maps_by_key(dfs: Sequence[DataFrame]) -> DataFrame:
    """Merge PROPS frames; where two define a key, the later frame in the list wins."""
    tagged = [
        df.select("item", "key", "value").withColumn("_prio", F.lit(i)) for i, df in enumerate(dfs)
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("item", "key")
        .agg(F.max_by("value", "_prio").alias("value"))
    )


def combine_collections_by_key(df: DataFrame, key: str, collection: str) -> DataFrame:
    """Concatenate the arrays of equal keys, in sorted order.

    The elements are counted first, so repeated ones - however many - reach the
    group as one counted entry and are written out again at the end.
    """
    counted = (
        df.select(key, F.explode(collection).alias("_element"))
        .groupBy(key, "_element")
        .agg(F.count("*").cast("int").alias("_times"))
    )
    entries = F.array_sort(F.collect_list(F.struct("_element", "_times")))
    repeated = F.flatten(F.transform(entries, lambda e: F.array_repeat(e["_element"], e["_times"])))
    filled = counted.groupBy(key).agg(repeated.alias(collection))
    empty = (
        df.groupBy(key).agg(F.max(F.coalesce(F.size(collection), F.lit(0))).alias("_longest"))
        .where("_longest <= 0")
        .select(key, F.array().cast(df.schema[collection].dataType).alias(collection))
    )
    return filled.unionByName(empty)


def union_all(
    dfs: Iterable[DataFrame], spark: SparkSession | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """Bag union by column name; no frames gives an empty one with ``schema``."""
    dfs = list(dfs)
    if not dfs:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def merge_fields_ranks(fields: DataFrame, ranks: DataFrame) -> DataFrame:
    """Full outer by item; a rank column replaces a field of the same name."""
    shared = [c for c in ranks.columns if c != "item" and c in fields.columns]
    renamed = fields.select(
        *[F.col(c).alias(f"_field_{c}") if c in shared else F.col(c) for c in fields.columns]
    )
    merged = renamed.join(ranks, "item", "full_outer")
    for c in shared:
        merged = merged.withColumn(
            c, F.coalesce(F.col(c), F.col(f"_field_{c}").try_cast(ranks.schema[c].dataType))
        ).drop(f"_field_{c}")
    return merged


def declared_types(keys: Iterable[str], date_names: Iterable[str], rank_names: Iterable[str]) -> dict:
    """Type per key: dates by name, ranks by name, everything else text."""
    dates, ranks = set(date_names), set(rank_names)
    return {
        k: "timestamp_ntz" if k in dates else "double" if k in ranks else "string" for k in keys
    }


def extract_typed(
    maps: DataFrame,
    date_names: Iterable[str],
    rank_names: Iterable[str],
    schema: dict[str, str],
) -> DataFrame:
    """(item, props MAP) to one typed column per key of ``schema``.

    Date and rank names override the declared type, element-wise inside arrays.
    """
    dates, ranks = set(date_names), set(rank_names)

    def column(key: str, declared: str) -> Column:
        scalar = "timestamp_ntz" if key in dates else "double" if key in ranks else None
        if scalar:
            declared = f"array<{scalar}>" if declared.startswith("array<") else scalar
        return typed_value(F.col("props")[key], declared).alias(key)

    return maps.select("item", *[column(k, t) for k, t in schema.items()])
