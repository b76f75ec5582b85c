"""Exact search for the greatest inner products by a pivot-distance index.

1. Equal vectors become one, with its k + 1 smallest ids: more of them are in no answer.
2. Pivots are fitted to a bounded sample (``SAMPLE`` vectors, by hash). Every vector is keyed by its
   nearest pivot and its distance from it. Distances are those of vectors that one more component
   brings to the length of the longest vector of their pivot; of two of them, the one with the
   greater inner product with a query is the nearer one to it.
3. Sorted by pivot and distance, the vectors are cut into annuli of at most ``CELL`` vectors, the
   wanted vectors in the same order into blocks of at most ``QUERIES``.
4. Each block of queries visits the annuli that its own vectors lie in. The scores found bound
   from below what a better answer must reach, and so from above how far from a pivot's distance
   to the query it can lie (triangle inequality).
5. An annulus outside of these distances for all queries of a block isn't joined with it. The
   others are visited in tasks of at most ``VISITS`` annuli, from the best bound down, until
   none can hold a better answer.

Answers are exact: an annulus is left out only if its bound, widened by the rounding errors of
the distances, is below the last place of the query's answer. Of vectors that lie all alike far
from each other, the bounds exclude few annuli, and the work is the product of queries and rows,
in blocks; it is spread over tasks in any case.

A vector takes part if it isn't null and holds neither nulls nor values that aren't finite; shorter
vectors count as filled up with zeros. Ties go to the smaller id, null ids last. Repeated rows are
rows of their own: each is asked for if its id is wanted, and found by all others. Sums wrap around
beyond 64 bits. Texts aren't read. Fewer rows than k give shorter answers; an empty table gives none.
Columns other than id and vector are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows, freeze, scalar_row
from cooccur.operators.numbering import number_rows

#: Vectors that pivots are fitted to, and pivots, at most.
SAMPLE = 4096
PIVOTS = 64
#: Vectors of an annulus, queries of a block, and annuli that a task visits for a block, at most.
CELL = 2048
QUERIES = 512
VISITS = 32
RESULT = "query_id long, rank int, vec_id long, score long"


class Shape(NamedTuple):
    """How vectors are packed: their number type, their length, and whether sums of products are exact in doubles."""

    kind: str
    length: int
    exact: bool

    def matrix(self, packed: pa.Array) -> np.ndarray:
        """Packed vectors as rows, as numbers whose products can be summed up."""
        rows = np.frombuffer(b"".join(packed.to_pylist()), self.kind).reshape(len(packed), self.length)
        return rows.astype(np.float64 if self.exact else np.int64)


class Pivots(NamedTuple):
    """Pivots, and for each the squared length that its vectors are brought to and their distances' range."""

    at: np.ndarray
    length2: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance, squared length of query and pivot's vectors together) for every query and pivot."""
        q2 = (queries**2).sum(1)[:, None]
        return np.sqrt(np.maximum(q2 + self.length2 - 2 * queries @ self.at.T, 0)), q2 + self.length2


def quantized(vector: str, scale: float) -> Column:
    """The components as floor(scale * x), null if the vector can't take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~odd, F.transform(x, lambda v: F.floor(F.lit(scale) * v)))


def _packed(rows: DataFrame) -> tuple[DataFrame, Shape]:
    """(id, wanted, vec) with the components as bytes."""
    top, bottom = F.max(F.array_max("ints")), F.min(F.array_min("ints"))
    found = scalar_row(rows.agg(F.max(F.size("ints")).alias("length"), top.alias("top"), bottom.alias("bottom")))
    most = max(found["top"] or 0, -(found["bottom"] or 0))
    kind = next(k for k, bits in (("<i2", 15), ("<i4", 31), ("<i8", 64)) if most < 1 << bits)
    shape = Shape(kind, found["length"] or 0, (found["length"] or 0) * most * most < 1 << 53)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(2)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        matrix = np.zeros((len(lists), shape.length), shape.kind)
        matrix[np.arange(shape.length) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([row.tobytes() for row in matrix], pa.binary())], ["id", "wanted", "vec"])

    return arrow_rows(rows, work, "id long, wanted boolean, vec binary"), shape


def _fitted(sample: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Centres of a sample by a few rounds of k-means."""
    n = min(PIVOTS, int(np.ceil(np.sqrt(len(sample)))))
    centres = sample[np.random.default_rng(11).choice(len(sample), n, replace=False)]
    for _ in range(rounds):
        nearest = _nearest(sample, centres)[0]
        sizes = np.bincount(nearest, minlength=n)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre, and the squared distance from it."""
    d2 = (vectors**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * vectors @ centres.T
    nearest = d2.argmin(1) if centres.size else np.zeros(len(vectors), np.int64)
    return nearest, np.maximum(d2[np.arange(len(vectors)), nearest], 0)


def _keyed(classes: DataFrame, shape: Shape) -> tuple[DataFrame, Pivots]:
    """``classes`` with their ``pivot`` and distance ``r``, and the pivots."""
    sampled = classes.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").toArrow()["vec"].combine_chunks()
    centres = _fitted(shape.matrix(sampled).astype(np.float64))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = shape.matrix(batch.column(0)).astype(np.float64)
        nearest, d2 = _nearest(vectors, centres)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(d2), pa.array((vectors**2).sum(1))],
            [*batch.schema.names, "pivot", "d2", "length2"])

    near = freeze(arrow_rows(classes, work, "vec binary, ids array<long>, pivot int, d2 double, length2 double"))
    own2 = (centres**2).sum(1)
    length2 = own2.copy()
    for row in near.groupBy("pivot").agg(F.max("length2").alias("m")).collect():  # a row for each pivot
        length2[row["pivot"]] = max(length2[row["pivot"]], row["m"])

    def of_pivot(values: np.ndarray) -> Column:
        return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("pivot"))

    lift = F.sqrt(F.greatest(of_pivot(length2) - F.col("length2"), F.lit(0.0))) - of_pivot(np.sqrt(length2 - own2))
    keyed = near.select("vec", "ids", "pivot", F.sqrt(F.col("d2") + lift * lift).alias("r"))
    low, high = np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
    for row in keyed.groupBy("pivot").agg(F.min("r").alias("low"), F.max("r").alias("high")).collect():
        low[row["pivot"]], high[row["pivot"]] = row["low"], row["high"]
    return keyed, Pivots(centres, length2, low, high)


class _Best:
    """The ``k`` best answers so far to each query of a block: greatest scores, smaller ids first, null ids last."""

    def __init__(self, queries: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least
        self.rows = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]

    def add(self, asked: np.ndarray, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray, first: np.ndarray) -> None:
        """Scores of the queries ``asked`` with vectors whose ids are ``first[i]`` to ``first[i + 1]``."""
        reach = self.least[asked]
        if scores.shape[1] > self.k:
            reach = np.maximum(reach, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k])
        query, at = np.nonzero(scores >= reach[:, None])
        times = (first[1:] - first[:-1])[at]
        place = np.arange(times.sum()) + np.repeat(first[at] - (np.cumsum(times) - times), times)
        new = [np.repeat(asked[query], times), np.repeat(scores[query, at], times).astype(np.int64), ids[place], unknown[place]]
        query, score, id_, none = [np.concatenate(x) for x in zip(self.rows, new)]
        order = np.lexsort((id_, none, -score, query))
        start = np.searchsorted(query[order], query[order])
        rank = np.arange(len(order)) - start
        kept = order[rank < self.k]
        self.rows = [query[kept], score[kept], id_[kept], none[kept]]
        full = order[rank == self.k - 1]
        self.least[query[full]] = np.maximum(self.least[query[full]], score[full])


def _visited(visits: DataFrame, blocks: DataFrame, annuli: DataFrame, pivots: Pivots, shape: Shape, k: int) -> DataFrame:
    """(block, place, score, id): the best answers of the visits (block, pivot, cell), ``k`` or more of each task's."""
    annulus = visits.join(annuli, ["pivot", "cell"])
    tasks = visits.groupBy("block").agg(F.ceil(F.count("*") / VISITS).cast("int").alias("tasks"))
    dealt = annulus.join(tasks, "block").withColumn("task", F.pmod(F.xxhash64("pivot", "cell"), F.col("tasks")))
    asked = blocks.join(tasks, "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - F.lit(1).cast("long"))).alias("task"), "vecs", "least")
    schema = "block long, place int, score long, id long"
    names = ["block", "place", "score", "id"]
    empty = pa.table([pa.nulls(0, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], names=names)

    def work(asked: pa.Table, rows: pa.Table) -> pa.Table:
        if not asked.num_rows or not rows.num_rows:
            return empty
        queries = shape.matrix(asked["vecs"].combine_chunks().flatten())
        best = _Best(len(queries), k, asked["least"].combine_chunks().flatten().to_numpy(zero_copy_only=False).copy())
        pivot = rows["pivot"].to_numpy()
        d, total = pivots.distances(queries.astype(np.float64))
        d, total = d[:, pivot], total[:, pivot]
        slack = 1e-5 * np.sqrt(total) + 1e-6
        nearest = np.maximum(np.maximum(d - rows["high"].to_numpy(), rows["low"].to_numpy() - d) - slack, 0)
        most = (total - nearest**2) / 2 + 1e-9 * total + 1e-6
        for i in np.argsort(-most.max(0), kind="stable").tolist():
            able = np.flatnonzero(most[:, i] >= best.least)
            if not len(able):
                continue
            vectors = rows["rows"][i].values
            ids = vectors.field("ids")
            flat = ids.flatten()
            first = np.append(0, np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)))
            scores = queries[able] @ shape.matrix(vectors.field("vec")).T
            best.add(able, scores, flat.fill_null(0).to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False), first)
        query, score, id_, none = best.rows
        return pa.table([
            pa.array(np.full(len(query), asked["block"][0].as_py())), pa.array(query.astype(np.int32)), pa.array(score),
            pa.array(id_, mask=none)], names=names)

    keys = ["block", "task"]
    return asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(work, schema)


def _open_ranges(blocks: DataFrame, pivots: Pivots, shape: Shape) -> DataFrame:
    """(block, pivot, from, to): distances from the pivot at which a better answer to some query of the block can lie."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for block, vecs, least in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            d, total = pivots.distances(shape.matrix(vecs.values).astype(np.float64))
            reach2 = total * (1 + 1e-9) + 1e-6 - 2 * least.values.to_numpy(zero_copy_only=False).astype(np.float64)[:, None]
            reach = np.sqrt(np.maximum(reach2, 0)) + 1e-5 * np.sqrt(total) + 1e-6
            able = (reach2 >= 0) & (d - reach <= pivots.high) & (d + reach >= pivots.low)
            start, end = np.where(able, d - reach, np.inf).min(0), np.where(able, d + reach, -np.inf).max(0)
            found += [(block, p, start[p], end[p]) for p in np.flatnonzero(able.any(0)).tolist()]
        columns = list(zip(*found)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["block", "pivot", "from", "to"])

    return arrow_rows(blocks.select("block", "vecs", "least"), work, "block long, pivot int, from double, to double")


def _with_least(blocks: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """``blocks`` with what an answer must reach: the score of the k-th of the answers so far."""
    reached = best.where(F.col("rank") == k).groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("reached"))  # a row for each query of a block
    least = F.transform("least", lambda low, i: F.coalesce(F.try_element_at("reached", i.cast("int")), low))
    return blocks.join(reached, "block", "left").select("block", "vecs", F.when(
        F.col("reached").isNotNull(), least).otherwise(F.col("least")).alias("least"))


def _ranked(answers: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_matches(
    rows: DataFrame, wanted: Column, *, k: int = 20, scale: float = 64.0, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is ``wanted`` the ``k`` other rows of greatest inner product.

    Components count as floor(scale * x). ``wanted`` is a condition on the columns of ``rows``.
    """
    spark: SparkSession = rows.sparkSession
    own = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.coalesce(wanted, F.lit(False)).alias("wanted"), quantized(vector, scale).alias("ints"))
    packed, shape = _packed(own.where("ints is not null"))
    packed = freeze(packed)
    first = W.partitionBy("vec").orderBy(F.asc_nulls_last("id"))
    few = packed.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("nth", "id"))), lambda x: x["id"])
    classes = freeze(few.groupBy("vec").agg(ids.alias("ids")))
    if not classes.head(1):
        return spark.createDataFrame([], RESULT)
    keyed, pivots = _keyed(classes, shape)
    cells = freeze(number_rows(keyed, [F.asc("pivot"), F.asc("r"), F.asc("vec")], "nth").withColumn("cell", F.floor(F.col("nth") / CELL)))
    annuli = freeze(cells.groupBy("pivot", "cell").agg(
        F.min("r").alias("low"), F.max("r").alias("high"), F.collect_list(F.struct("ids", "vec")).alias("rows")))
    asked = packed.where("wanted").select("id", "vec")
    numbered = freeze(number_rows(
        cells.join(asked.select("vec").distinct(), "vec", "left_semi").select("vec", "pivot", "cell", F.col("nth").alias("at")),
        [F.asc("at")], "nth").select("vec", "pivot", "cell", F.floor(F.col("nth") / QUERIES).alias("block"),
                                     (F.col("nth") % QUERIES).cast("int").alias("place")))
    vecs = F.transform(F.array_sort(F.collect_list(F.struct("place", "vec"))), lambda x: x["vec"])
    blocks = freeze(numbered.groupBy("block").agg(vecs.alias("vecs")).withColumn(
        "least", F.transform("vecs", lambda _: F.lit(-(1 << 63)).cast("long"))))
    near = freeze(numbered.select("block", "pivot", "cell").distinct())
    best = freeze(_ranked(_visited(near, blocks, annuli, pivots, shape, k + 1), k + 1))
    blocks = freeze(_with_least(blocks, best, k + 1))
    ranges = freeze(_open_ranges(blocks, pivots, shape))
    able = annuli.select("pivot", "cell", "low", "high").join(ranges, "pivot").where("low <= to and high >= from")
    more = freeze(able.select("block", "pivot", "cell").join(near, ["block", "pivot", "cell"], "left_anti"))
    answers = best.select("block", "place", "score", "id").unionByName(_visited(more, blocks, annuli, pivots, shape, k + 1))
    listed = _ranked(answers, k + 1).groupBy("block", "place").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", F.col("id").alias("vec_id")))).alias("found"))
    # Written before it is joined, so that the rows of a vector that many queries share can be split among tasks.
    found = freeze(listed.join(numbered.select("vec", "block", "place"), ["block", "place"]).select("vec", "found"))
    return _without_own(asked.join(found, "vec"), shape, k)


def _without_own(found: DataFrame, shape: Shape, k: int) -> DataFrame:
    """Each query's answers without the query's own row: one with its id and the score of its vector with itself."""
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = shape.matrix(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array((vectors * vectors).sum(1).astype(np.int64))], ["query_id", "found", "self"])

    scored = arrow_rows(
        found.select("id", "vec", "found"), work, "query_id long, found array<struct<rank: int, score: long, vec_id: long>>, self long")
    own = F.filter("found", lambda x: (x["vec_id"] == F.col("query_id")) & (x["score"] == F.col("self")))
    at = F.coalesce(F.get(own, F.lit(0))["rank"], F.lit(k + 1))
    others = F.slice(F.filter("found", lambda x: x["rank"] != F.col("own")), 1, k)
    return scored.withColumn("own", at).select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
