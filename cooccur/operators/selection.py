"""The smallest rows of large groups, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.session import freeze

#: Rows beyond the wanted ones that a group may keep for its sort.
SPARE = 1 << 16
#: Hexadecimal digits looked at in a round, and those of a digest.
STEP, DIGITS = 2, 32


def digit_bounds(rows: DataFrame, groups: Sequence[str], digest: str, wanted: int, spare: int = SPARE) -> DataFrame:
    """(groups, prefix) of the groups with more than ``wanted`` + ``spare`` rows.

    The ``wanted`` smallest digests of a group start with its prefix or with less, and at most
    ``spare`` more do, unless equal digests are more than that. Each round counts the rows of
    the groups still too large by the next digits of those that start with the prefix so far - at
    most 256 counts a group, added up where the rows are - and finds the digits at which the wanted
    row lies. A group of a billion rows takes two rounds.
    """
    far = W.partitionBy(*groups).orderBy("prefix")
    open_ = freeze(rows.groupBy(*groups).agg(F.count("*").alias("n")).where(F.col("n") > wanted + spare).select(
        *groups, F.lit("").alias("prefix"), F.lit(wanted).cast("long").alias("missing"), "n"))
    bounds = None
    for digits in range(STEP, DIGITS + 1, STEP):
        if open_.isEmpty():
            break
        inside = rows.select(*groups, digest).join(open_.drop("n"), list(groups)).where(F.col(digest).startswith(F.col("prefix")))
        counts = inside.groupBy(*groups, F.substring(digest, 1, digits).alias("prefix")).agg(
            F.first("missing").alias("missing"), F.count("*").alias("n"))
        reached = counts.withColumn("before", F.sum("n").over(far) - F.col("n"))
        found = freeze(reached.where((F.col("before") < F.col("missing")) & (F.col("before") + F.col("n") >= F.col("missing"))).select(
            *groups, "prefix", (F.col("missing") - F.col("before")).alias("missing"), "n"))
        done = (F.col("n") <= spare) | F.lit(digits == DIGITS)
        settled = found.where(done).select(*groups, "prefix")
        bounds = settled if bounds is None else bounds.unionByName(settled)
        open_ = found.where(~done)
    return open_.select(*groups, "prefix") if bounds is None else bounds


def smallest(
    rows: DataFrame, groups: Sequence[str], order: Column, then: Sequence[str], wanted: int, spare: int = SPARE,
) -> DataFrame:
    """The ``wanted`` rows of each group that come first by ``order``, a digest in hexadecimal, and the columns ``then``.

    Rows beyond their group's :func:`digit_bounds` go where they are read; what is left of
    a group, at most ``wanted`` + ``spare`` rows, is sorted. Groups with a null key are sorted whole.
    """
    keyed = freeze(rows.withColumn("_digest", order))
    bounds = digit_bounds(keyed, groups, "_digest", wanted, spare)
    near = keyed.join(bounds, list(groups), "left").where(
        F.col("prefix").isNull() | (F.expr("left(_digest, length(prefix))") <= F.col("prefix"))).drop("prefix")
    place = W.partitionBy(*groups).orderBy("_digest", *then)
    return near.withColumn("_nth", F.row_number().over(place)).where(F.col("_nth") <= wanted).select(*rows.columns)
