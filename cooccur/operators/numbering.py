"""Dense positions for ordered rows without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.session import freeze

BLOCK = 4096


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the given total order.

    A range-partitioned sort, then each partition's rows are shifted by the size of
    the partitions before it. The sorted rows are frozen so that sizes and rows come
    from the same range bounds, also after a lost executor.
    """
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = freeze(
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", in_partition)
    )
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")  # one row per sort partition
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_part", "_row", "_offset")
    )


def positions_within(rows: DataFrame, group: str, position: str, name: str, block: int = BLOCK) -> DataFrame:
    """Renumber rows per group, densely from 0, in the order of a global position.

    Blocks of positions bound every window: at most ``block`` rows inside a block
    and (positions / block) rows of block sizes per group.
    """
    blocked = rows.withColumn("_blk", F.floor(F.col(position) / block))
    earlier = W.partitionBy(group).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(group, "_blk")
        .agg(F.count("*").alias("_size"))
        .select(group, "_blk", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = W.partitionBy(group, "_blk").orderBy(position)
    return (
        blocked.withColumn("_nth", F.row_number().over(within) - 1)
        .join(offsets, [group, "_blk"])
        .withColumn(name, F.col("_offset") + F.col("_nth"))
        .drop("_blk", "_nth", "_offset")
    )


def free_positions(needs: DataFrame, taken: DataFrame, block: int = BLOCK) -> DataFrame:
    """(query_id, spos): the first ``need`` positions from 0 that a query has not taken.

    ``needs`` is (query_id, need > 0), ``taken`` distinct (query_id, spos). Let v be
    the number of free positions before a taken one; the k-th free position (from 0)
    is k plus the count of taken positions with v <= k. Only taken positions with
    v < need count, and blocks reached after ``need`` free positions are dropped
    early, so a query that took millions of positions costs block sizes, not a sort.
    """
    marked = taken.join(needs, "query_id").withColumn("_blk", F.floor(F.col("spos") / block))
    earlier = W.partitionBy("query_id").orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        marked.groupBy("query_id", "_blk")
        .agg(F.count("*").alias("_size"), F.max("need").alias("_need"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .where(F.col("_blk") * block - F.col("_before") < F.col("_need"))
        .select("query_id", "_blk", "_before")
    )
    within = W.partitionBy("query_id", "_blk").orderBy("spos")
    free_before = F.col("spos") - F.col("_before") - (F.col("_nth") - 1)
    steps = (
        marked.join(blocks, ["query_id", "_blk"])
        .withColumn("_nth", F.row_number().over(within))
        .withColumn("_v", free_before)
        .where(F.col("_v") < F.col("need"))
        .groupBy("query_id", "_v")
        .agg(F.count("*").alias("_n"))
        .groupBy("query_id")
        .agg(F.collect_list(F.struct("_v", "_n")).alias("_steps"))  # at most `need` entries
    )
    skipped = F.expr(
        "aggregate(filter(_steps, s -> s._v <= _k), 0L, (total, s) -> total + s._n)"
    )
    return (
        needs.join(steps, "query_id", "left")
        .select("query_id", "_steps", F.explode(F.expr("sequence(0L, need - 1L)")).alias("_k"))
        .select("query_id", (F.col("_k") + F.coalesce(skipped, F.lit(0))).alias("spos"))
    )
