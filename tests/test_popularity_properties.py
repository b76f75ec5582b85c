from datetime import datetime

import pytest

from cooccur import EventWindow, Ranking
from cooccur.operators import cleaning, popularity, properties
from cooccur.sources.events import split_actions

AS_OF = "2024-01-31"


@pytest.fixture(scope="module")
def actions(spark):
    data = [("x", 1)] * 1 + [("x", 12)] * 2 + [("x", 25)] * 5 + [("y", 2)] * 3 + [("y", 28)] + [("z", 29)] * 4
    frame = spark.createDataFrame([("buy", i, f"2024-01-{d:02d}") for i, d in data], "event string, item string, d string")
    return frame.selectExpr("event", "item", "cast(d as timestamp_ntz) ts")


def ranks(df):
    return {r["item"]: r["rank"] for r in df.collect()}


def test_interval():
    span = popularity.ranking_interval("30 days", "2024-01-31", "2023-01-01")
    assert span.start == datetime(2024, 1, 1)
    assert popularity.ranking_interval("30 days", "rubbish", "2024-01-31").end == datetime(2024, 1, 31)
    assert span.cut(3)[1:3] == [datetime(2024, 1, 11), datetime(2024, 1, 21)]


def test_rankings(actions):
    span = popularity.ranking_interval("30 days", AS_OF)
    assert ranks(popularity.popular(actions, ["buy"], span)) == {"x": 8.0, "y": 4.0, "z": 4.0}
    # halves meet on the 16th: newer minus older, only where both have events
    assert ranks(popularity.trending(actions, ["buy"], span)) == {"x": 2.0, "y": -2.0}
    # thirds 1, 2, 5: (5 - 2) - (2 - 1)
    assert ranks(popularity.hot(actions, ["buy"], span)) == {"x": 2.0}
    assert ranks(popularity.popular(actions, ["view"], span)) == {}


def test_combined_ranks_keep_what_exists(actions, spark):
    props = spark.createDataFrame([("x", "userRank", "3.5"), ("w", "userRank", "n/a"), ("v", "c", "1")],
                                  "item string, key string, value string")
    kinds = [Ranking(kind, duration="30 days")
             for kind in ("popular", "trending", "hot", "random", "userDefined")]
    got = {r["item"]: r for r in popularity.combine_rankings(actions, props, kinds, "buy", AS_OF).collect()}
    assert got["x"].popRank == 8.0 and got["x"].hotRank == 2.0 and got["x"].userRank == 3.5
    assert got["z"].popRank == 4.0 and got["z"].trendRank is None and got["z"].uniqueRank is not None
    assert set(got) == {"x", "y", "z", "w", "v"} and got["w"].userRank is None


def test_properties_fold_in_time_order(micro, rows):
    got = rows(properties.aggregate_properties(micro))
    assert got == [("a", "color", "blue"), ("a", "tags", '["x","y"]'), ("b", "color", "red"), ("b", "size", "7")]


def test_maps(micro, spark, rows):
    props = properties.aggregate_properties(micro)
    maps = properties.props_to_map(props)
    assert rows(properties.map_to_props(maps)) == rows(props)
    later = spark.createDataFrame([("a", "color", "green"), ("c", "new", "1")], "item string, key string, value string")
    merged = {(r.item, r.key): r.value for r in properties.combine_maps_by_key([props, later]).collect()}
    assert merged["a", "color"] == "green" and merged["b", "color"] == "red" and merged["c", "new"] == "1"


def test_collections_and_unions(spark, rows):
    df = spark.createDataFrame([("k", ["b", "a"]), ("k", ["a"]), ("m", [])], "k string, v array<string>")
    got = {r.k: r.v for r in properties.combine_collections_by_key(df, "k", "v").collect()}
    assert got == {"k": ["a", "a", "b"], "m": []}
    assert properties.union_all([], spark, "a string").columns == ["a"]
    assert properties.union_all([df, df]).count() == 6


def test_ranks_override_fields(spark):
    fields = spark.createDataFrame([("a", "1.0", "red"), ("b", "2.0", "blue")], "item string, popRank string, color string")
    ranks_ = spark.createDataFrame([("a", 9.0), ("c", 3.0)], "item string, popRank double")
    got = {r["item"]: (r["popRank"], r["color"]) for r in properties.merge_fields_ranks(fields, ranks_).collect()}
    assert got == {"a": (9.0, "red"), "b": (2.0, "blue"), "c": (3.0, None)}


def test_window_keeps_property_events(micro):
    kept = cleaning.clean_event_window(micro, "10 days", "2024-01-31")
    assert {r.event_id for r in kept.where("event not like '$%'").collect()} == {"e4", "e5", "e6", "e11"}
    assert kept.where("event like '$%'").count() == 4


def test_cleaning_is_idempotent(micro, rows):
    once = cleaning.dedup_events(micro)
    assert once.count() == micro.count() - 1
    assert rows(cleaning.dedup_events(once)) == rows(once)
    small = cleaning.compress_properties(once)
    assert rows(cleaning.compress_properties(small)) == rows(small)
    assert rows(properties.aggregate_properties(small)) == rows(properties.aggregate_properties(micro))
    assert small.where("event = '$set'").count() == 2


def test_clean_events_reports_what_is_gone(micro):
    kept, removed = cleaning.clean_events(micro, EventWindow("10 days"), "2024-01-31")
    assert kept.count() + removed.count() == micro.count()
    assert kept.join(removed, "event_id").isEmpty()
    assert cleaning.remove_events(micro, removed).count() == kept.count()


def test_null_targets_are_no_actions(micro):
    assert split_actions(micro, ["view"]).count() == 5
