"""Interaction preparation: binarize, restrict, number, count, down-sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.functions.scores import hash_order
from cooccur.operators.selection import smallest
from cooccur.session import allow_group_limit

INTERACTION = ["event", "user", "item"]


def binarize(actions: DataFrame) -> DataFrame:
    """One row per distinct (event, user, item)."""
    return actions.select(*INTERACTION).distinct()


def restrict_to_primary_users(actions: DataFrame, primary: str) -> DataFrame:
    """Keep, in every event type, only users who did the primary event."""
    buyers = actions.where(F.col("event") == primary).select("user").distinct()
    return actions.join(buyers, "user", "left_semi").select(*actions.columns)


def min_events_per_user(actions: DataFrame, n: int) -> DataFrame:
    """Drop users with fewer than ``n`` rows."""
    if n <= 1:
        return actions
    active = actions.groupBy("user").count().where(F.col("count") >= n).select("user")
    return actions.join(active, "user", "left_semi").select(*actions.columns)


def per_event(default, by_event: dict[str, object] | None) -> Column:
    """A literal chosen by the ``event`` column."""
    chosen = F.lit(default)
    for event, value in (by_event or {}).items():
        chosen = F.when(F.col("event") == event, F.lit(value)).otherwise(chosen)
    return chosen


def downsample(
    actions: DataFrame,
    max_per_user: int | None | dict[str, int | None],
    seed: int,
    max_per_item: int | None = None,
) -> DataFrame:
    """Cap the items of a user per event type, and optionally the users of an item.

    A reproducible random choice: rows are ordered by a digest of seed, user and
    item. ``max_per_user`` may differ by event type; where it is None all rows stay. The
    constant bound lets Spark discard surplus rows of a heavy user inside each map task,
    before the shuffle. The rows of an item that many users share are not sorted together: counts of
    leading digits of the digest tell which can be among the chosen ones.
    """
    if isinstance(max_per_user, dict):
        caps = {event: cap for event, cap in max_per_user.items() if cap is not None}
        capped = F.col("event").isin(list(caps)) if len(caps) < len(max_per_user) else F.lit(True)
    else:
        caps, capped = {None: max_per_user} if max_per_user is not None else {}, F.lit(True)
    kept = actions
    if caps:
        widest = max(caps.values())
        allow_group_limit(actions.sparkSession, widest)
        order = [hash_order(F.lit(str(seed)), "user", "item"), F.col("item")]
        by_user = W.partitionBy("event", "user").orderBy(*order)
        kept = actions.where(capped).withColumn("_nth", F.row_number().over(by_user)).where(F.col("_nth") <= widest)
        if len(set(caps.values())) > 1:
            kept = kept.where(F.col("_nth") <= per_event(widest, caps))
        kept = kept.drop("_nth")
        if isinstance(max_per_user, dict) and len(caps) < len(max_per_user):
            kept = kept.unionByName(actions.where(~capped))
    if max_per_item is not None:
        kept = smallest(kept, ["event", "item"], hash_order(F.lit(str(seed)), "user", "item"), ["user"], max_per_item)
    return kept


def interaction_counts(actions: DataFrame) -> DataFrame:
    """(event, item, n_users) of binarized actions."""
    return actions.groupBy("event", "item").agg(F.count("*").alias("n_users"))


def primary_user_count(actions: DataFrame, primary: str) -> DataFrame:
    """One row, one column: how many users did the primary event."""
    return actions.where(F.col("event") == primary).agg(F.countDistinct("user").alias("n"))


# --- dictionaries -----------------------------------------------------------


def id_dictionary(
    df: DataFrame, column: str, existing: DataFrame | None = None, bucket_digits: int = 3
) -> DataFrame:
    """(id, idx): a dense number from 0 for every distinct id.

    Ids in ``existing`` keep their number and new ids follow the highest one. New
    ids are numbered by the order of their md5 digest. Its leading hex digits cut
    the ids into even buckets whatever the ids look like, so no task ever sorts
    more than one bucket; the bucket offsets come from a 16^digits-row table.
    """
    ids = df.select(F.col(column).cast("string").alias("id")).where("id is not null").distinct()
    start: Column = F.lit(0).cast("bigint")
    if existing is not None:
        ids = ids.join(existing.select("id"), "id", "left_anti")
        start = existing.agg(F.coalesce(F.max("idx") + 1, F.lit(0)).cast("bigint")).scalar()
    hashed = ids.withColumn("_digest", F.md5("id")).withColumn(
        "_bucket", F.substring("_digest", 1, bucket_digits)
    )
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    within = W.partitionBy("_bucket").orderBy("_digest", "id")
    fresh = (
        hashed.withColumn("_nth", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), "_bucket")  # at most 16^bucket_digits rows
        .select("id", (F.col("_offset") + F.col("_nth") + start).cast("bigint").alias("idx"))
    )
    if existing is None:
        return fresh
    return existing.select("id", F.col("idx").cast("bigint").alias("idx")).unionByName(fresh)


def encode(df: DataFrame, column: str, dictionary: DataFrame, to: str, default=None) -> DataFrame:
    """Replace an id column by its number; ids without one get ``default``."""
    lookup = dictionary.select(F.col("id").alias(column), F.col("idx").alias(to))
    found = df.join(lookup, column, "left").drop(column)
    if default is None:
        return found
    return found.withColumn(to, F.coalesce(to, F.lit(default).cast("bigint")))


def decode(df: DataFrame, column: str, dictionary: DataFrame, to: str, default=None) -> DataFrame:
    """Replace a number column by its id; unknown numbers get ``default``."""
    lookup = dictionary.select(F.col("idx").alias(column), F.col("id").alias(to))
    found = df.join(lookup, column, "left").drop(column)
    return found if default is None else found.withColumn(to, F.coalesce(to, F.lit(default)))


def take(dictionary: DataFrame, n: int) -> DataFrame:
    """The first ``n`` entries by number."""
    return dictionary.where(F.col("idx") < n)
