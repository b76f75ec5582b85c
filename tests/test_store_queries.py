import pytest
from pyspark.sql import functions as F

from cooccur import EngineConfig
from cooccur.sources import store
from cooccur.sources.queries import read_queries, rejected_queries, resolve_queries

CFG = EngineConfig("a", "i", "t", event_names=("buy",))


def model(spark, tag):
    return spark.createDataFrame([("a", tag), ("b", tag)], "id string, tag string")


def test_publish_and_read(spark, tmp_path):
    root = str(tmp_path)
    assert store.read_model(spark, root, "m") is None
    first = store.publish_model(model(spark, "one"), root, "m")
    opened = store.read_model(spark, root, "m")
    second = store.publish_model(model(spark, "two"), root, "m")
    assert second > first
    assert {r.tag for r in opened.collect()} == {"one"}
    assert {r.tag for r in store.read_model(spark, root, "m").collect()} == {"two"}
    store.publish_model(model(spark, "three"), root, "m")
    left = sorted(p.name for p in (tmp_path / "m").glob("v=*"))
    assert f"v={first}" not in left and f"v={second}" in left and len(left) == 2


def test_failed_publish_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    version = store.publish_model(model(spark, "good"), root, "m")
    broken = model(spark, "bad").withColumn("tag", F.raise_error("no"))
    with pytest.raises(Exception, match="no"):
        store.publish_model(broken, root, "m")
    assert store.current_version(spark, root, "m") == version
    assert {r.tag for r in store.read_model(spark, root, "m").collect()} == {"good"}


def test_broken_pointer_is_an_error(spark, tmp_path):
    store.publish_model(model(spark, "x"), str(tmp_path), "m")
    for text in ("1 2", "999"):
        (tmp_path / "m" / "_current").write_text(text)
        (tmp_path / "m" / "._current.crc").unlink(missing_ok=True)
        with pytest.raises(RuntimeError):
            store.read_model(spark, str(tmp_path), "m")


def test_bundle_lookup_and_fields(spark, tmp_path, rows):
    frames = {n: model(spark, n) for n in store.BUNDLE}
    store.save_bundle(frames, str(tmp_path / "b"))
    loaded = store.load_bundle(spark, str(tmp_path / "b"))
    assert list(loaded) == list(store.BUNDLE) and rows(loaded["items"]) == rows(frames["items"])
    wanted = spark.createDataFrame([("b",), ("b",), ("z",)], "id string")
    assert rows(store.lookup_items(model(spark, "t"), wanted)) == [("b", "t")]
    maps = spark.createDataFrame([("a", {"k": '["x"]', "d": "2024-01-01", "popRank": "1"}), ("b", {"k": "y"})],
                                 "item string, props map<string,string>")
    assert store.field_types(store.model_fields(maps, ["d"], ["popRank"])) == {
        "d": "timestamp_ntz", "k": "array<string>", "popRank": "double"}


def test_queries_are_checked(spark):
    texts = [
        '{"queryId":"1","user":"u","num":3,"dateRange":{"name":"d","after":"2024-01-01T00:00:00Z"}}',
        '{"queryId":"2","dateRange":{"name":"d","before":"","after":""}}',
        "not json",
        '{"queryId":"4","fields":[{"name":"f","values":["v"],"bias":-1}],"returnSelf":true}',
        '{"queryId":"5","dateRange":{"before":"2024-01-01"}}',
    ]
    got = {r.query_id: r for r in read_queries(spark.createDataFrame([(t,) for t in texts], "value string")).collect()}
    assert got["1"].error is None and str(got["1"].date_range.after) == "2024-01-01 00:00:00"
    assert got["1"].date_range.before is None
    assert got["2"].error == "date range without a bound" and got["5"].error == "date range without a name"
    assert [r.error for k, r in got.items() if k not in "1245"] == ["not a query"]
    assert got["4"].fields[0].bias == -1.0


def test_queries_from_a_file_get_defaults(spark, tmp_path):
    path = tmp_path / "q.json"
    path.write_text('{"queryId":"1","user":"u"}\n{"queryId":"1","user":"u"}\n{"queryId":"2","num":4,"userBias":2}\nx\n')
    got = {r.query_id: r for r in resolve_queries(read_queries(str(path), spark), CFG, "2024-01-01").collect()}
    assert set(got) == {"1", "2"}
    assert got["1"].num == 10 and got["2"].num == 4 and got["2"].user_bias == 2.0
    assert got["1"].event_names == ["buy"] and not got["1"].return_self


def test_nothing_vanishes_from_a_batch(spark):
    texts = ['{"queryId":"1","user":"u"}', '{"queryId":"1","user":"v"}', '{"queryId":"2","user":"u"}',
             '{"queryId":"2","user":"u"}', '{"queryId":"2","dateRange":{"name":"d"}}', '{"queryId":"3","dateRange":{"name":"d"}}']
    queries = read_queries(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert {r.query_id for r in resolve_queries(queries, CFG, "2024-01-01").collect()} == {"2"}
    got = {(r.query_id, r.error, r.rows) for r in rejected_queries(queries).collect()}
    bad = "date range without a bound"
    assert got == {("1", "different queries with one id", 2), ("2", bad, 1), ("3", bad, 1)}
