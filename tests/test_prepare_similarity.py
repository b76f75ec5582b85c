from collections import Counter
from itertools import product

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cooccur import Indicator
from cooccur.operators import prepare, selection, similarity
from cooccur.sources.events import recent_events_by_entity, scan_events, split_actions


@pytest.fixture(scope="module")
def crowd(spark):
    """Binarized actions; user 0 alone holds about a third of all rows."""
    base = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 23).alias("u"),
        (F.col("id") * 7919 % 61).alias("i"), (F.col("id") % 2).alias("e"),
    )
    return prepare.binarize(base.select(
        F.when(F.col("e") == 0, "buy").otherwise("view").alias("event"),
        F.col("u").cast("string").alias("user"), F.col("i").cast("string").alias("item"),
    )).cache()


def pairs_of(crowd, event):
    return [(r.user, r.item) for r in crowd.where(F.col("event") == event).collect()]


def brute(primary, secondary, same):
    counts = Counter()
    for (u, a), (v, b) in product(primary, secondary):
        if u == v and not (same and a == b):
            counts[a, b] += 1
    return sorted((a, b, n) for (a, b), n in counts.items())


def test_scan_and_split_are_null_safe(micro, rows):
    found = scan_events(micro, names=["buy", "view"], start="2024-01-02", until="2024-01-10")
    assert found.where("event_time >= '2024-01-10'").isEmpty()
    actions = split_actions(scan_events(micro), ["buy", "view"])
    assert actions.where("item is null or item = ''").isEmpty()
    assert actions.count() == 13
    assert prepare.binarize(actions).count() == 12


def test_recent_events_are_capped(micro, spark):
    users = spark.createDataFrame([("u2",)], "user string")
    got = recent_events_by_entity(micro, users, ["buy"], 2).orderBy("recency").collect()
    assert [r.target_entity_id for r in got] == ["c", "b"]


def test_restrict_and_minimum(micro, rows):
    pairs = prepare.binarize(split_actions(micro, ["buy", "view"]))
    kept = prepare.restrict_to_primary_users(pairs, "buy")
    assert {r.user for r in kept.collect()} == {"u1", "u2", "u3"}
    assert {r.user for r in prepare.min_events_per_user(pairs, 4).collect()} == {"u2"}


def test_downsample_caps_and_is_stable(crowd, rows):
    small = prepare.downsample(crowd, {"buy": 5, "view": 3}, 7)
    most = {r.event: r.m for r in small.groupBy("event", "user").count().groupBy("event").agg(F.max("count").alias("m")).collect()}
    assert most == {"buy": 5, "view": 3}
    assert rows(small) == rows(prepare.downsample(crowd.repartition(7), {"buy": 5, "view": 3}, 7))
    per_item = prepare.downsample(crowd, 50, 7, max_per_item=2).groupBy("event", "item").count()
    assert per_item.agg(F.max("count")).first()[0] == 2
    assert rows(prepare.downsample(crowd, 1000, 7)) == rows(crowd)


@pytest.mark.parametrize("wanted", [1, 40, 700])
def test_smallest_of_a_hot_group_equals_a_sort(spark, rows, wanted):
    """An item of a third of all rows, one of equal rows only, small ones and a null one."""
    hot = spark.range(6000).select(F.lit("hot").alias("item"), F.concat(F.lit("u"), "id").alias("user"))
    small = spark.range(8000).select(F.concat(F.lit("i"), F.col("id") % 400).alias("item"), F.concat(F.lit("u"), "id").alias("user"))
    alike = spark.range(2000).select(F.lit("alike").alias("item"), F.lit("u").alias("user"))
    nulls = spark.range(2000).select(F.lit(None).cast("string").alias("item"), F.concat(F.lit("u"), "id").alias("user"))
    log = hot.unionByName(small).unionByName(alike).unionByName(nulls)
    digest = F.md5(F.concat_ws("/", "user", "item").cast("binary"))
    place = Window.partitionBy("item").orderBy(digest, "user")
    want = log.withColumn("n", F.row_number().over(place)).where(F.col("n") <= wanted).drop("n")
    assert rows(selection.smallest(log, ["item"], digest, ["user"], wanted, spare=50)) == rows(want)
    keyed = log.withColumn("digest", digest)
    bounds = selection.digit_bounds(keyed, ["item"], "digest", wanted, spare=50)
    near = keyed.join(bounds, "item").where("left(digest, length(prefix)) <= prefix").groupBy("item").count()
    sizes = {r["item"]: r["count"] for r in near.collect()}
    assert wanted <= sizes["hot"] <= wanted + 50 and sizes["alike"] == 2000
    assert set(sizes) == {"hot", "alike"}


@pytest.mark.parametrize("tile", [3, 1024])
def test_pairs_equal_brute_force(crowd, rows, tile):
    buys, views = pairs_of(crowd, "buy"), pairs_of(crowd, "view")
    primary = crowd.where("event = 'buy'").select("user", "item")
    secondary = crowd.where("event = 'view'").select("user", "item")
    assert rows(similarity.cooccurrence(primary, tile=tile)) == sorted(brute(buys, buys, True), key=repr)
    crossed = similarity.cross_occurrence(primary, secondary, tile=tile)
    assert rows(crossed) == sorted(brute(buys, views, False), key=repr)


def test_tiles_bound_the_work_of_a_heavy_user(crowd):
    primary = crowd.where("event = 'buy'").select("user", "item")
    left, right = similarity.tile_users(primary, primary, tile=8)
    for side in (left, right):
        assert side.groupBy("user", "_l", "_r").count().agg(F.max("count")).first()[0] <= 24
    assert left.select("user", "_l", "_r").distinct().where("user = '0'").count() > 1


def test_indicators(crowd, rows, spark):
    specs = [Indicator("buy", 500, 3), Indicator("view", 500, 2, min_llr=1.0)]
    corr = similarity.indicators(crowd, specs, 1)
    got = rows(corr, "action", "item", "correlator", "llr", "rank")
    assert got == rows(similarity.indicators(crowd.repartition(7), specs, 1, tile=4),
                       "action", "item", "correlator", "llr", "rank")
    counts = Counter((a, i) for a, i, *_ in got)
    assert all(n <= {"buy": 3, "view": 2}[a] for (a, _), n in counts.items())
    assert all(score > 0 for *_, score, _ in got)
    assert all(score >= 1.0 for a, *_, score, _ in got if a == "view")
    assert not any(a == "buy" and i == c for a, i, c, *_ in got)


def test_missing_secondary_does_not_shift_the_others(crowd):
    specs = [Indicator("buy"), Indicator("absent"), Indicator("view", max_correlators_per_item=1)]
    corr = similarity.indicators(crowd, specs, 1)
    assert {r.action for r in corr.select("action").distinct().collect()} == {"buy", "view"}
    assert corr.where("action = 'view'").groupBy("item").count().agg(F.max("count")).first()[0] == 1


def test_lists_are_strongest_first(spark):
    corr = spark.createDataFrame(
        [("buy", "a", "z", 5.0), ("buy", "a", "y", 5.0), ("buy", "a", "x", 9.0), ("view", "b", "q", 1.0)],
        "action string, item string, correlator string, llr double",
    )
    top = similarity.top_correlators(corr, 2)
    lists = {r.item: r for r in similarity.correlator_lists(top, ["buy", "view"]).collect()}
    assert lists["a"].buy == ["x", "y"] and lists["a"].view is None
    assert lists["b"].buy is None and lists["b"].view == ["q"]


def test_min_llr(spark):
    corr = spark.createDataFrame([("a", 0.0), ("b", 1.0)], "item string, llr double")
    assert [r.item for r in similarity.min_llr(corr).collect()] == ["b"]
    assert similarity.min_llr(corr, 0.0).count() == 2


def test_dictionary(spark, rows):
    ids = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 1500).alias("id"))
    first = prepare.id_dictionary(ids, "id")
    assert sorted(r.idx for r in first.collect()) == list(range(1500))
    more = ids.unionByName(spark.createDataFrame([("new1",), ("new2",)], "id string"))
    second = prepare.id_dictionary(more, "id", first)
    assert second.join(first, ["id", "idx"]).count() == 1500
    assert {r.idx for r in second.where("id like 'new%'").collect()} == {1500, 1501}
    coded = prepare.encode(spark.createDataFrame([("new1",), ("k1",)], "id string"), "id", first, "n", default=-1)
    assert coded.where("n = -1").count() == 1
    assert prepare.decode(coded, "n", first, "id", default="?").where("id = '?'").count() == 1
    assert prepare.take(second, 10).count() == 10


def test_a_missing_app_column_is_an_error(micro):
    with pytest.raises(ValueError, match="app"):
        scan_events(micro, app="shop")
    two = micro.withColumn("app", F.when(F.col("entity_id") == "u1", "other").otherwise("shop"))
    assert scan_events(two, app="shop").where("entity_id = 'u1'").count() == 0
    assert scan_events(two, app="other").select("entity_id").distinct().count() == 1


def test_a_heavy_user_loses_no_pair_by_default(spark):
    rows = [("buy", "heavy", f"i{i:04d}") for i in range(300)] + [("view", "heavy", f"j{i:04d}") for i in range(20)]
    actions = spark.createDataFrame(rows, "event string, user string, item string")
    specs = [Indicator("buy", max_correlators_per_item=1), Indicator("view", max_correlators_per_item=1)]
    pairs, _ = similarity.scored_numbers(actions, specs, 1, tile=64)
    assert pairs.where("event = 0").count() == 300 * 299 // 2 and pairs.where("event = 1").count() == 300 * 20


def test_downsample_leaves_uncapped_events_alone(spark):
    actions = spark.createDataFrame([(e, "u", f"i{i}") for e in ("buy", "view") for i in range(9)], "event string, user string, item string")
    got = {r["event"]: r["count"] for r in prepare.downsample(actions, {"buy": 4, "view": None}, 1).groupBy("event").count().collect()}
    assert got == {"buy": 4, "view": 9}
    assert prepare.downsample(actions, None, 1).count() == 18


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_a_heavy_users_pairs_are_spread_over_tasks(spark, threshold):
    """A user with 3,000 items of 200 small ones: no task makes more than a quarter of the pairs."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        heavy = spark.range(3000).select(F.lit("heavy").alias("user"), F.concat(F.lit("i"), "id").alias("item"))
        small = spark.range(600).select(F.concat(F.lit("u"), F.col("id") % 200).alias("user"), F.concat(F.lit("i"), "id").alias("item"))
        side = heavy.unionByName(small)
        other = side.withColumnRenamed("item", "correlator")
        sizes = similarity.user_sizes(side, other)
        work = similarity.pair_work(sizes, similarity.TILE)
        assert work == (201, 200 * 9, 3000 * 3000)
        pairs = similarity.user_pairs(side, other, similarity.TILE, sizes, work)
        tasks = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(tasks) == 9_000_000 + 1800 and max(tasks) <= sum(tasks) / 4
        sample = pairs.where("item in ('i0', 'i2999')")
        assert sample.count() == sample.distinct().count() + 3  # i0 has three more pairs by a small user, all of them again
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
