from pyspark.sql import functions as F

from cooccur.operators import cleaning


def test_large_logs_are_dealt_out_in_small_tasks(spark, micro, rows, monkeypatch):
    """Also when all rows are one event; the earliest of its copies is found all the same."""
    log = micro.where("event_id = 'e0'").crossJoin(spark.range(400).withColumnRenamed("id", "n")).select(
        F.concat("event_id", F.lit("-"), F.col("n").cast("string")).alias("event_id"),
        *[c for c in micro.columns if c not in ("event_id", "creation_time")],
        (F.col("creation_time") + F.expr("make_interval(0, 0, 0, 0, 0, 0, (n + 7) % 400)")).alias("creation_time")).coalesce(1)
    dealt = cleaning._dealt(log, 20)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 60 and len(sizes) > 8
    assert cleaning._dealt(log, 400).rdd.getNumPartitions() == 1
    monkeypatch.setattr(cleaning, "ROWS_PER_TASK", 20)
    first = cleaning.dedup_events(log).collect()
    assert [r["event_id"] for r in first] == ["e0-393"]
    plan = cleaning.dedup_events(log)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
