"""Exact search against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cooccur.llm import queries, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, wanted, k=20, scale=64):
    ints = []
    for at, (vec_id, vector, _) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            ints.append((at, vec_id, [math.floor(scale * float(np.float32(x))) for x in vector]))
    found = []
    for at, vec_id, vector in ints:
        if vec_id is not None and wanted(vec_id):
            others = sorted(
                (-sum(a * b for a, b in zip(vector, other)), o is None, o or 0) for i, o, other in ints if i != at)
            found += [(vec_id, n + 1, None if none else o, -score) for n, (score, none, o) in enumerate(others[:k])]
    return sorted(found, key=repr)


def clustered(n, length, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, length)) * 3
    return [(i, (centres[i % 6] + rng.normal(size=length) * 0.2).tolist(), i % 6) for i in range(n)]


def collected(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture
def small(monkeypatch):
    """Many annuli, blocks and tasks even of few rows."""
    for name, value in (("SAMPLE", 60), ("PIVOTS", 7), ("CELL", 25), ("QUERIES", 9), ("VISITS", 3)):
        monkeypatch.setattr(topk, name, value)


@pytest.mark.parametrize("rows", [
    clustered(700, 8, 1),
    [(i, np.random.default_rng(i).normal(size=5).tolist(), 0) for i in range(400)],
], ids=["clusters", "noise"])
def test_equals_all_products(spark, small, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert collected(topk.top_matches(df, F.col("vec_id") % 20 == 0)) == plain(rows, lambda i: i % 20 == 0)
    assert collected(topk.top_matches(df, F.col("vec_id") % 50 == 7, k=3, scale=8)) == plain(rows, lambda i: i % 50 == 7, 3, 8)


def test_annuli_out_of_reach_are_not_visited(spark, small, monkeypatch):
    rows, visits, sizes = clustered(900, 8, 2), [], []
    plain_visited = topk._visited

    def counted(visit, blocks, annuli, *rest):
        visits.append(visit.count())
        sizes.append(blocks.count() * annuli.count())
        return plain_visited(visit, blocks, annuli, *rest)

    monkeypatch.setattr(topk, "_visited", counted)
    found = collected(topk.top_matches(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0))
    assert found == plain(rows, lambda i: i % 20 == 0)
    assert sum(visits) < 0.5 * sizes[0]


def test_odd_vectors_ties_and_repeated_rows(spark, small):
    rng = random.Random(5)
    rows = clustered(120, 4, 3)
    rows += [(200 + i, [1.0, 0.0, 0.0, 0.0], 0) for i in range(90)]  # many equal ones, some of them asked for
    rows += [(300, [0.0] * 4, 0), (320, [0.0] * 4, 0), (340, None, 0), (360, [1.0, None, 0.0, 0.0], 0), (380, [float("nan")] * 4, 0),
             (400, [float("inf"), 0.0, 0.0, 0.0], 0), (420, [], 0), (440, [2.0], 0), (None, [9.0] * 4, 0), (None, [9.0] * 4, 0), (None, None, 0)]
    rows += [rows[40], rows[40], (60, [-1.0, 2.0, 3.0, 0.5], 0), (460, [1e4, -1e4, 0.0, 0.0], 0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit(1) for c in ("id", "vec", "wanted", "pivot", "block")})
    assert collected(topk.top_matches(df, F.col("vec_id") % 20 == 0)) == plain(rows, lambda i: i % 20 == 0)


def test_large_components(spark, small):
    rows = [(i, [float(2 ** (15 + i % 8)), float(i), -3.5], 0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert collected(topk.top_matches(df, F.col("vec_id") % 20 == 0)) == plain(rows, lambda i: i % 20 == 0)


def test_few_and_no_rows(spark):
    two = [(0, [1.0], 0), (1, [2.0], 0)]
    assert collected(topk.top_matches(spark.createDataFrame(two, SCHEMA), F.col("vec_id") == 0)) == [(0, 1, 1, 64 * 128)]
    assert collected(topk.top_matches(spark.createDataFrame(two[:1], SCHEMA), F.col("vec_id") == 0)) == []
    assert collected(topk.top_matches(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0)) == []
    assert collected(topk.top_matches(spark.createDataFrame(two, SCHEMA), F.lit(False))) == []


def test_query(spark, tmp_path):
    rows = clustered(300, 16, 6)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert collected(queries.op12_top_matches(spark, str(tmp_path))) == plain(rows, lambda i: i % 20 == 0)
