"""Mixing sources to target weights by capped water-filling.

A source's share of the words follows its weight, but no source is repeated more than
``max_epochs`` times: sources above that are clamped and the excess goes to the others by
weight, until none is above. A source then gives every document its whole repetitions, and a
seeded selection of documents one more, so that its words come within half a document of its
target. DataFrame functions only.

Null and empty texts have size 0 and are never taken. A null source is a source of its own,
the last in order. Repeated rows are separate documents: where only a part of rows with equal id
and text fits, so many of them are taken once more (which of them depends on how the rows lie in
their files). Very long texts are documents like others: a source is off its target by half of
its last document at most. Sources without words get the target 0; an empty table gives an empty
mix. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.llm.frames import freeze, scalar_row, unused
from cooccur.operators.numbering import number_rows
from cooccur.session import scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Digits of the seeded place of a document that each step of the selection looks at.
STEP_BITS = 10
STEPS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: Sequence[float], name: str = "weight") -> DataFrame:
    """Give sources weights by their order (code points, null last), starting over after the last weight."""
    key = sources.columns[0]
    place = unused(sources, "place")
    numbered = number_rows(sources, [F.col(key).asc_nulls_last()], place)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return numbered.withColumn(name, F.element_at(cycle, (F.col(place) % len(weights) + 1).cast("int"))).drop(place)


def source_targets(sources: DataFrame, max_epochs: int, budget: float | None = None) -> DataFrame:
    """Add ``target`` to one row per source with ``source_size`` and ``weight``.

    The level is the words per weight of the sources that are not clamped. Clamping a source
    raises it for the others, so clamped sources stay so and the rounds end; each is an
    aggregate to one row. ``budget`` is the words of the whole mix (default: all there are).
    """
    totals = scalar_row(sources.agg(F.sum("source_size").alias("size")))
    wanted = float(totals["size"] or 0) if budget is None else float(budget)
    most = F.col("source_size") * F.lit(max_epochs)
    level, clamped = 0.0, -1
    while True:
        over = most <= F.col("weight") * F.lit(level)
        now = scalar_row(sources.agg(
            F.sum(F.when(over, most).otherwise(0)).alias("clamped"),
            F.count(F.when(over, 1)).alias("n"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ))
        if now["n"] == clamped or not now["weight"]:
            break
        clamped, level = now["n"], max(0.0, wanted - now["clamped"]) / now["weight"]
    return sources.withColumn("target", F.least(most.cast("double"), F.col("weight") * F.lit(level)))


def _place(seed: int, *keys: Column) -> Column:
    """A document's seeded place, as a non-negative number of ``STEPS * STEP_BITS`` bits."""
    return F.xxhash64(F.lit(seed), *keys).bitwiseAND(F.lit((1 << (STEPS * STEP_BITS)) - 1))


def extra_repetitions(sized: DataFrame, rests: DataFrame) -> DataFrame:
    """(src, limit place, limit id): the last document of each source that is taken once more.

    Documents stand in the order of (place, id, digest). Sums over the leading digits of the
    place find the group in which the words reach the rest of the target; only that group is
    summed by the next digits, so no task sorts more than the documents that share all
    digits of one place, and the sums of each step are a bounded number of rows per source.
    """
    found = rests.where("rest > 0").select("src", "rest", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("head"))
    for step in range(STEPS):
        shift = (STEPS - step - 1) * STEP_BITS
        digits = F.shiftright("place", shift)
        inside = sized.join(found, "src").where(F.shiftright("place", shift + STEP_BITS) == F.col("head"))
        sums = inside.groupBy("src", digits.alias("at")).agg(
            F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("before"))
        earlier = W.partitionBy("src").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
        stepped = sums.withColumn("start", F.col("before") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        reached = stepped.where((F.col("start") < F.col("rest")) & (F.col("start") + F.col("words") >= F.col("rest")))
        found = freeze(reached.select("src", "rest", F.col("start").alias("before"), F.col("at").alias("head")))
    # Rows with equal id and text are alike: of these groups one is taken in part, if any.
    groups = sized.join(found, "src").where("place = head").groupBy("src", "id", "tie").agg(
        F.count("*").alias("rows"), F.max("size").alias("size"), F.max("rest").alias("rest"), F.max("before").alias("before"))
    so_far = W.partitionBy("src").orderBy(F.asc_nulls_first("id"), F.asc("tie")).rowsBetween(W.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum(F.col("rows") * F.col("size")).over(so_far), F.lit(0))
    fitting = F.least(F.col("rows"), F.floor((F.col("rest") - start) / F.greatest(F.col("size"), F.lit(1)) + 0.5))
    limits = freeze(groups.withColumn("taken", fitting).where("taken >= 1").groupBy("src").agg(
        F.max(F.struct("id", "tie", "taken", "rows")).alias("g")).select("src", "g.*"))
    cut = _nth_rows(sized, limits.where("taken < rows"))
    last = F.struct("id", "tie", F.coalesce("nth", F.lit((1 << 63) - 1)).alias("row"))
    return found.join(limits.join(cut, "src", "left").select("src", last.alias("last")), "src", "left").select("src", "head", "last")


def _nth_rows(sized: DataFrame, groups: DataFrame) -> DataFrame:
    """(src, nth): the number of the ``taken``-th of each group's rows, by their numbers.

    Counts of leading digits find it, so a group that holds most of a source is never sorted.
    """
    wanted = groups.select("src", "id", "tie", "taken")
    if not wanted.head(1):
        return groups.sparkSession.createDataFrame([], wanted.select("src", F.lit(0).cast("long").alias("nth")).schema)
    own = sized.select("src", "id", "tie", "row").alias("a").join(
        wanted.alias("b"), (F.col("a.src") == F.col("b.src")) & F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.tie") == F.col("b.tie"))
    ).select("a.src", "row", "taken")
    found = own.select("src", F.lit(0).cast("long").alias("head"), F.lit(0).cast("long").alias("before")).distinct()
    for shift in range(60, -1, -STEP_BITS):
        above = F.lit(0) if shift == 60 else F.shiftright("row", shift + STEP_BITS)
        counts = own.join(found, "src").where(above == F.col("head")).groupBy("src", F.shiftright("row", shift).alias("at")).agg(
            F.count("*").alias("n"), F.max("taken").alias("taken"), F.max("before").alias("before"))
        earlier = W.partitionBy("src").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
        reached = counts.withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).where(
            (F.col("start") < F.col("taken")) & (F.col("start") + F.col("n") >= F.col("taken")))
        found = freeze(reached.select("src", F.col("at").alias("head"), F.col("start").alias("before")))
    return found.select("src", F.col("head").alias("nth"))


def _keyed(docs: DataFrame, seed: int, text: str, source: str, doc_id: str) -> DataFrame:
    """(doc, mix): a row's columns, and what the selection needs of it."""
    tie = F.coalesce(F.xxhash64(F.col(text)), F.lit(0))
    key = F.struct(
        F.struct(F.col(source).alias("source")).alias("src"), F.col(doc_id).alias("id"), tie.alias("tie"),
        word_count(F.col(text)).alias("size"), _place(seed, F.col(doc_id), tie).alias("place"),
        F.monotonically_increasing_id().alias("row"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("mix"))


def mix_plan(sized: DataFrame, weights: Sequence[float] | DataFrame, *, max_epochs: int = 3, budget: float | None = None) -> DataFrame:
    """One row per source: size, target, whole repetitions, and where the selection for one more ends.

    ``sized`` has (src, id, tie, size, place) of every document. ``weights`` is a sequence, dealt
    to the sources in order, or a table (source, weight) with a row for every source.
    """
    sizes = sized.groupBy("src").agg(F.sum("size").alias("source_size")).select("src.source", "source_size")
    if isinstance(weights, DataFrame):
        name, weight = weights.columns[:2]
        weights = weights.select(F.col(name).alias("_s"), F.col(weight).cast("double").alias("weight"))
        weighed = sizes.join(weights, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    else:
        weighed = cycled_weights(sizes, weights)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = freeze(
        source_targets(freeze(weighed), max_epochs, budget)
        .withColumn("whole", F.floor(rate))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("src", F.struct("source")).drop("source"))
    return freeze(targets.join(extra_repetitions(sized, targets), "src", "left"))


def _times(key: str) -> Column:
    of = F.col(key)
    once_more = (of["place"] < F.col("head")) | (
        (of["place"] == F.col("head")) & (F.struct(of["id"].alias("id"), of["tie"].alias("tie"), of["row"].alias("row")) <= F.col("last")))
    return F.when(of["size"] > 0, F.col("whole") + F.coalesce(once_more, F.lit(False)).cast("long")).otherwise(F.lit(0)).cast("long")


def mix_sources(
    docs: DataFrame, weights: Sequence[float] | DataFrame, *, max_epochs: int = 3, budget: float | None = None,
    seed: int = 7, text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """How often each document is taken: (doc_id, source, size, source_size, target, times, taken).

    The selection depends on the seed, the ids and the texts only.
    """
    keyed = _keyed(docs.select(doc_id, source, text), seed, text, source, doc_id)
    sized = freeze(keyed.select("mix.*"))
    plan = mix_plan(sized, weights, max_epochs=max_epochs, budget=budget)
    timed = sized.withColumn("_mix", F.struct(*sized.columns)).join(plan, "src").withColumn("times", _times("_mix"))
    return timed.select(
        F.col("id").alias("doc_id"), "src.source", "size", "source_size", "target", "times",
        (F.col("times") * F.col("size")).alias("taken"))


def apply_mix(
    docs: DataFrame, weights: Sequence[float] | DataFrame, *, max_epochs: int = 3, budget: float | None = None,
    seed: int = 7, text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` as the mix takes them: a row for each repetition, with the columns of ``docs``.

    Whole rows meet only the plan's one row per source; texts are not shuffled. The table is read
    twice: if it doesn't come from files, so that rows may lie differently the second time, and a
    source's last document has copies with its id, a few more or less of these may be taken.
    """
    keyed = _keyed(docs, seed, text, source, doc_id)
    with scratch(docs.sparkSession):
        sized = freeze(keyed.select("mix.*"))
        plan = freeze(mix_plan(sized, weights, max_epochs=max_epochs, budget=budget).select("src", "whole", "head", "last"), keep=True)
    timed = keyed.join(plan, keyed["mix"]["src"] == plan["src"]).select("doc", _times("mix").cast("int").alias("times"))
    return timed.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("nth")).select("doc.*")
