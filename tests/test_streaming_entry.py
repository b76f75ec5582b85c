import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import database, differences
from cooccur.operators.popularity import popular, ranking_interval
from cooccur.session import fresh_path, release, session_dir
from cooccur.sources import store
from cooccur.sources.events import split_actions
from cooccur.streaming import events as st

SF = "/root/testdata/sf0.001"
# one or two of each family; check.py compares them all
SAMPLE = ["scan_events", "dedup_events", "clean_all", "combine_maps", "dictionary_merge", "downsample",
          "llr_scores", "indicators_all", "ranks_combined", "q_date_range", "q_exclusions", "stream_popular"]


@pytest.fixture
def landed(spark, micro, tmp_path):
    """The micro log as three files, one per stream batch."""
    whole = micro.where("entity_type = 'user' and target_entity_id is not null")
    for i, part in enumerate(whole.repartition(3, "event_id").randomSplit([1.0, 1.0, 1.0], 3)):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/batch{i}"))
    source = spark.readStream.schema(micro.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return whole, source.parquet(str(tmp_path / "in"))


def test_stream_dedup(spark, landed, tmp_path):
    whole, stream = landed
    twice = stream.union(stream)
    query = (st.stream_dedup(twice, "60 days").writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == whole.count() == got.select("event_id").distinct().count()


def test_stream_popular_equals_batch(spark, landed, tmp_path, rows):
    whole, stream = landed
    windows = st.stream_popular(stream, "3650 days", "60 days")
    st.append_updates(windows, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    latest = st.latest_updates(spark, str(tmp_path / "out"), ["window", "item"], "rank")
    batch = popular(split_actions(whole, ["buy", "view"]), [], ranking_interval("3650 days", "2024-06-01"))
    assert rows(latest.groupBy("item").agg(F.sum("rank").alias("rank"))) == rows(batch)


def test_stream_publish_is_idempotent(spark, landed, tmp_path, rows):
    whole, stream = landed
    root = str(tmp_path / "models")
    windows = st.stream_popular(stream, "3650 days", "60 days")
    st.stream_publish(windows, root, "ranks", str(tmp_path / "ck")).awaitTermination()
    version = store.current_version(spark, root, "ranks")
    first = rows(store.read_model(spark, root, "ranks"), "item", "rank")
    assert sum(r for _, r in first) == whole.count()
    # started again with nothing new, it publishes nothing
    st.stream_publish(windows, root, "ranks", str(tmp_path / "ck")).awaitTermination()
    assert store.current_version(spark, root, "ranks") == version
    # a new checkpoint reads all again and replaces its own windows
    st.stream_publish(windows, root, "ranks", str(tmp_path / "ck2")).awaitTermination()
    assert store.current_version(spark, root, "ranks") > version
    assert rows(store.read_model(spark, root, "ranks"), "item", "rank") == first


def test_stream_publish_goes_on_from_a_published_model(spark, landed, tmp_path, rows):
    whole, stream = landed
    root = str(tmp_path / "models")
    seed = spark.createDataFrame([("2000-01-01 00:00:00", "old", 5.0)], "s string, item string, rank double")
    store.publish_model(seed.selectExpr("cast(s as timestamp) window_start", "item", "rank"), root, "ranks")
    st.stream_publish(st.stream_popular(stream, "3650 days", "60 days"), root, "ranks", str(tmp_path / "ck")).awaitTermination()
    model = rows(store.read_model(spark, root, "ranks"), "item", "rank")
    assert ("old", 5.0) in model and sum(r for _, r in model) == whole.count() + 5


def test_append_updates_of_two_checkpoints(spark, landed, tmp_path):
    _, stream = landed
    out = str(tmp_path / "out")
    for part, condition in (("a", "target_entity_id = 'a'"), ("rest", "target_entity_id <> 'a'")):
        windows = st.stream_popular(stream.where(condition), "3650 days", "60 days")
        st.append_updates(windows, out, str(tmp_path / f"ck-{part}")).awaitTermination()
    assert {"a", "b", "d", "e"} <= {r["item"] for r in st.latest_updates(spark, out, ["window", "item"], "rank").collect()}


@pytest.mark.parametrize("fold_after", [1, 2])
def test_folded_updates_equal_batch_and_are_corrected(spark, landed, tmp_path, rows, fold_after):
    whole, stream = landed
    out = str(tmp_path / "out")
    windows = st.stream_popular(stream, "7 days", "60 days")
    st.append_updates(windows, out, str(tmp_path / "ck"), fold_after=fold_after).awaitTermination()
    batch = whole.groupBy(F.window("event_time", "7 days").getField("start").alias("at"), F.col("target_entity_id").alias("item")).agg(
        F.count("*").cast("double").alias("rank"))
    latest = st.latest_updates(spark, out, ["window", "item"], "rank").select(F.col("window.start").alias("at"), "item", "rank")
    assert rows(latest) == rows(batch)
    left = {f.rsplit("/", 2)[1] for f in spark.read.parquet(out).inputFiles()}
    assert any(len(f) > len("batch=") + 10 for f in left)  # a folded one
    assert "batch=0" not in left  # in two folded ones, and so removed
    # what is written after the folds wins, whichever folder the older row is in now
    spark.read.parquet(out).drop("run", "batch").limit(1).withColumns({"rank": F.lit(99.0), "at": F.col("at") * 2}).write.parquet(
        f"{out}/run=late/batch=0")
    again = [r["rank"] for r in st.latest_updates(spark, out, ["window", "item"], "rank").collect()]
    assert again.count(99.0) == 1 and len(again) == batch.count()


def test_folding_twice_reads_each_folder_twice(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    for at, rank in enumerate([3.0, 5.0]):
        spark.createDataFrame([("a", rank, at), ("b" if at else "c", 1.0, at)], "item string, rank double, at long").write.parquet(
            f"{out}/run=x/batch={at}")
    want = [("a", 5.0), ("b", 1.0), ("c", 1.0)]
    due = st.fold_updates(spark, out, ["item"])
    assert len(due) == 2
    for _ in range(2):
        due = st.fold_updates(spark, out, ["item"], due)
        assert len(due) == 1 and sorted(rows(st.latest_updates(spark, out, ["item"], "rank"), "item", "rank")) == want
    assert {f.rsplit("/", 3)[1] for f in spark.read.parquet(out).inputFiles()} == {"run=folded"}


def test_every_query_has_sql():
    from workloads.oracles import ORACLES
    from workloads.registry import QUERIES

    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"item", "correlator", "llr", "rank"}


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_equals_sql(spark, name):
    con: duckdb.DuckDBPyConnection = database(SF)
    got = entry.queries()[name](spark, SF).toPandas()
    assert differences(got, con.execute(entry.oracle_sql()[name]).df()) is None


def test_release(spark):
    path = fresh_path(spark, "probe")
    assert path.startswith(session_dir(spark))
    spark.range(3).write.parquet(path)
    release(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
