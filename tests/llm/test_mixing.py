import re

from pyspark.sql import functions as F

from cooccur.llm import mixing
from tests.llm.conftest import SCHEMA, words


def test_targets_are_water_filled(spark):
    sources = spark.createDataFrame([("a", 10, 5.0), ("b", 1000, 2.0), ("c", 500, 1.0), (None, 0, 5.0)], "source string, source_size long, weight double")
    found = {r["source"]: r["target"] for r in mixing.source_targets(sources, 3).collect()}
    # a stops at 30, the empty source at 0; b and c share the rest 2 : 1.
    assert found[None] == 0 and found["a"] == 30
    assert abs(found["b"] - 2 * 1480 / 3) < 1e-6 and abs(found["c"] - 1480 / 3) < 1e-6


def test_weights_follow_code_points_null_last(spark):
    sources = spark.createDataFrame([(None,), ("é",), ("B",), ("a",)], "source string")
    assert {r[0]: r[1] for r in mixing.cycled_weights(sources, (5, 2, 1)).collect()} == {"B": 5, "a": 2, "é": 1, None: 5}


def test_mix_reaches_targets_with_few_repetitions(spark):
    docs = spark.createDataFrame([(i, words(20 + i % 17, i), "en", f"s{min(i % 9, 4)}", 0) for i in range(600)], SCHEMA)
    rows = mixing.mix_sources(docs, (5, 2, 1)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_sources(docs.repartition(5), (5, 2, 1)).collect()))
    by = {}
    for r in rows:
        assert 0 <= r["times"] <= 3 and r["taken"] == r["times"] * r["size"]
        by.setdefault(r["source"], []).append(r)
    for own in by.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        assert sum(r["size"] for r in own) == own[0]["source_size"]


def test_odd_rows(odd, odd_rows, empty, clashing):
    found = mixing.mix_sources(odd, (5, 2, 1)).collect()
    want = sorted(((r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in odd_rows), key=repr)
    assert sorted(((r["doc_id"], r["size"]) for r in found), key=repr) == want
    assert all(r["taken"] == 0 for r in found if not r["size"])
    assert mixing.mix_sources(empty, (5, 2, 1)).count() == 0
    taken = mixing.apply_mix(clashing, (5, 2, 1))
    assert taken.columns == clashing.columns
    assert taken.where("doc_id is not null and text is not null").count() == sum(r["times"] for r in found if r["doc_id"] is not None)


def test_weights_by_table(spark):
    docs = spark.createDataFrame([(i, words(10, i), "en", "ab"[i % 2], 0) for i in range(40)], SCHEMA)
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    found = mixing.mix_sources(docs, weights).groupBy("source").agg(F.sum("taken").alias("t")).collect()
    assert {r["source"]: r["t"] for r in found} == {"a": 100, "b": 300}


def plain_targets(sizes, weights, most):
    """Water-filling by clamping one round after the other."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    wanted, clamped = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in sizes if s not in clamped)
        left = wanted - sum(most * sizes[s] for s in clamped)
        target = {s: most * sizes[s] if s in clamped else left * weight[s] / free for s in sizes}
        over = {s for s in sizes if s not in clamped and target[s] > most * sizes[s]}
        if not over:
            return target
        clamped |= over


def test_repeated_rows_do_not_overshoot(spark, tmp_path):
    """Sources of equal rows only, with equal and with null ids, come within a document of their targets."""
    rows = [(1, "one two", "en", "a", 0)] * 4000 + [(None, "x y z", "en", "b", 0)] * 3000 + [(None, "x y z", "en", None, 0)] * 10
    rows += [(i, words(5 + i % 30, i), "en", "c", 0) for i in range(2000)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = mixing.mix_sources(docs, (5, 2, 1)).groupBy("source").agg(
        F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"),
        F.max("times").alias("times")).collect()
    want = plain_targets({r["source"]: r["size"] for r in found}, (5, 2, 1), 3)
    for r in found:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * want[r["source"]]
        assert abs(r["taken"] - r["target"]) <= r["most"] and r["times"] <= 3
    counts = {r["source"]: r["n"] for r in mixing.apply_mix(docs, (5, 2, 1)).groupBy("source").agg(
        F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert counts == {r["source"]: r["taken"] for r in found}


def test_columns_of_any_name(odd):
    names = ("_plan", "_plan_src", "whole", "head", "last", "doc", "mix", "nth", "row", "times", "src")
    named = odd.withColumns({c: F.lit(7) for c in names})
    taken = mixing.apply_mix(named, (5, 2, 1))
    assert taken.columns == named.columns and taken.where("_plan = 7 and doc = 7").count() == taken.count() > 0
