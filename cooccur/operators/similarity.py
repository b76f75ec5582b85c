"""Co-occurrence and cross-occurrence, scored by log-likelihood ratio.

The work is one equi-join on ``user`` and one aggregation by item pair. What keeps
it bounded:

* users with more rows than a tile are joined apart from the others (:func:`user_pairs`): their
  work is cut into tiles of equal size, the tiles are the partitioning, so they land on different
  tasks whatever kind of join is chosen, and no pair is lost;
* a caller may cap a user's items beforehand by :func:`prepare.downsample`, so that a
  user yields at most cap x cap pairs;
* item counts travel with the rows into the join, so the pair table - by far the
  largest - is shuffled for its own aggregation and for the top-k only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.config import Indicator
from cooccur.functions.scores import llr
from cooccur.operators.numbering import number_rows
from cooccur.operators.prepare import downsample, per_event, restrict_to_primary_users
from cooccur.session import allow_group_limit, freeze

TILE = 512
PAIRS_PER_PARTITION = 4_000_000
#: Pairs of heavy users that a task makes, about: a few tiles.
HEAVY_PAIRS_PER_PARTITION = 4 * TILE * TILE
#: Pairs that a task aggregates in :func:`directed_pairs`, about; an item with more is dealt out by its correlators.
PAIRS_PER_ITEM_TASK = 1_000_000


class PairWork(NamedTuple):
    """Users of the left side, and the pairs that light and heavy users make."""

    users: int
    light: int
    heavy: int


def user_sizes(left: DataFrame, right: DataFrame) -> DataFrame:
    """(user, l, r): the rows of each user on both sides."""
    own, other = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = left.select("user", own.alias("l"), other.alias("r")).unionByName(
        right.select("user", other.alias("l"), own.alias("r")))
    return both.groupBy("user").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))


def _is_heavy(tile: int) -> Column:
    return (F.col("l") > 0) & (F.col("r") > 0) & (F.greatest("l", "r") > tile)


def pair_work(sizes: DataFrame, tile: int) -> PairWork:
    """One row of sums: neither input sizes nor what adaptive execution makes of them tell the pairs of a join."""
    pairs = F.col("l") * F.col("r")
    found = sizes.agg(
        F.count_if(F.col("l") > 0), F.sum(F.when(_is_heavy(tile), 0).otherwise(pairs)), F.sum(F.when(_is_heavy(tile), pairs))).first()
    return PairWork(found[0], found[1] or 0, found[2] or 0)


def tile_users(left: DataFrame, right: DataFrame, tile: int = TILE, sizes: DataFrame | None = None):
    """Give both sides of a join on ``user`` the extra keys ``_l`` and ``_r``.

    A user with at most ``tile`` rows on both sides keeps one tile. A heavier one is
    cut into ceil(n_left/tile) x ceil(n_right/tile) tiles: each left row is copied
    along the right tiles and vice versa, so every pair meets in exactly one tile.
    Users without a row in ``sizes`` (:func:`user_sizes`) are left out.
    """
    sizes = user_sizes(left, right) if sizes is None else sizes
    tiles = sizes.where("l > 0 and r > 0").select(
        "user", F.ceil(F.col("l") / tile).cast("int").alias("_tl"), F.ceil(F.col("r") / tile).cast("int").alias("_tr"))

    def spread(side: DataFrame, own: str, own_tiles: str, other: str, other_tiles: str):
        columns = [c for c in side.columns]
        item = "item" if "item" in columns else "correlator"
        return (
            side.join(tiles, "user")
            .withColumn(own, F.pmod(F.xxhash64(item), F.col(own_tiles)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_tiles) - 1)))
            .select(*columns, "_l", "_r")
        )

    return spread(left, "_l", "_tl", "_r", "_tr"), spread(right, "_r", "_tr", "_l", "_tl")


def _parallel(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def user_pairs(left: DataFrame, right: DataFrame, tile: int, sizes: DataFrame, work: PairWork) -> DataFrame:
    """Every row of ``left`` with every row of ``right`` of the same user, without the user.

    The number of partitions follows the pairs. Heavy users' rows are copied where they are
    read and dealt out by user and both tile numbers; these partitions are given by number, so
    adaptive execution doesn't merge them, and the rows of both sides lie by tile, so a join that
    broadcasts one side does not bring a user's pairs back together.
    """
    light_left, light_right = left, right
    heavy_pairs = None
    if work.heavy:
        # At most (rows / tile) users.
        heavy = freeze(sizes.where(_is_heavy(tile)))
        light_left, light_right = (side.join(heavy.select("user"), "user", "left_anti") for side in (left, right))
        keys = ["user", "_l", "_r"]
        partitions = max(4 * _parallel(left), -(-work.heavy // HEAVY_PAIRS_PER_PARTITION))
        dealt = [side.repartition(partitions, *keys) for side in tile_users(left, right, tile, heavy)]
        heavy_pairs = dealt[0].join(dealt[1].hint("merge"), keys).drop(*keys)
    partitions = max(_parallel(left), -(-work.light // PAIRS_PER_PARTITION))
    light_pairs = light_left.repartition(partitions, "user").join(light_right.repartition(partitions, "user"), "user").drop("user")
    return light_pairs if heavy_pairs is None else light_pairs.unionByName(heavy_pairs)


def _pairs(left: DataFrame, right: DataFrame, cap: int | None, tile: int) -> DataFrame:
    right = right.withColumnRenamed("item", "correlator")
    if cap is not None and cap <= tile:
        return left.join(right, "user").drop("user")
    sizes = user_sizes(left, right)
    return user_pairs(left, right, tile, sizes, pair_work(sizes, tile))


def cooccurrence(primary: DataFrame, cap: int | None = None, tile: int = TILE) -> DataFrame:
    """(item, correlator, k11): users who did the primary event on both items.

    ``primary`` holds distinct (user, item) rows. Only one order of each pair goes
    through the aggregation; the mirror image is added to the result.
    """
    side = primary.select("user", "item")
    half = (
        _pairs(side, side, cap, tile)
        .where(F.col("item") < F.col("correlator"))
        .groupBy("item", "correlator")
        .agg(F.count("*").alias("k11"))
    )
    both = F.explode(
        F.array(
            F.struct(F.col("item").alias("a"), F.col("correlator").alias("b")),
            F.struct(F.col("correlator").alias("a"), F.col("item").alias("b")),
        )
    )
    return half.select(both.alias("p"), "k11").select(
        F.col("p.a").alias("item"), F.col("p.b").alias("correlator"), "k11"
    )


def cross_occurrence(
    primary: DataFrame, secondary: DataFrame, cap: int | None = None, tile: int = TILE
) -> DataFrame:
    """(item, correlator, k11): users with the primary event on item, the other on correlator."""
    return (
        _pairs(primary.select("user", "item"), secondary.select("user", "item"), cap, tile)
        .groupBy("item", "correlator")
        .agg(F.count("*").alias("k11"))
    )


def score_pairs(
    pairs: DataFrame, item_counts: DataFrame, correlator_counts: DataFrame, n_users: DataFrame
) -> DataFrame:
    """Attach ``llr`` to (item, correlator, k11). Counts are (item, n_users) tables."""
    a = item_counts.select("item", F.col("n_users").alias("ca"))
    b = correlator_counts.select(F.col("item").alias("correlator"), F.col("n_users").alias("cb"))
    return (
        pairs.join(a, "item")
        .join(b, "correlator")
        .withColumn("llr", llr(F.col("k11"), F.col("ca"), F.col("cb"), n_users.scalar()))
        .select("item", "correlator", "k11", "ca", "cb", "llr")
    )


def min_llr(corr: DataFrame, threshold: float | Column | None = None) -> DataFrame:
    """Keep scores at or above the threshold; without one, anything above zero."""
    if threshold is None:
        return corr.where(F.col("llr") > 0)
    return corr.where(F.col("llr") >= threshold)


def top_correlators(corr: DataFrame, k: int | dict) -> DataFrame:
    """The ``k`` strongest correlators per action and item, with their ``rank``.

    ``k`` may differ by action. The item leads the sort key: it tells most rows apart.
    """
    keys = [c for c in ("item", "action") if c in corr.columns]
    strongest = W.partitionBy(*keys).orderBy(F.desc("llr"), F.asc("correlator"))
    widest = max(k.values()) if isinstance(k, dict) else k
    allow_group_limit(corr.sparkSession, widest)
    top = corr.withColumn("rank", F.row_number().over(strongest)).where(F.col("rank") <= widest)
    if isinstance(k, dict) and len(set(k.values())) > 1:
        limit = F.lit(widest)
        for action, own in k.items():
            limit = F.when(F.col("action") == action, own).otherwise(limit)
        top = top.where(F.col("rank") <= limit)
    return top


def correlator_lists(corr: DataFrame, actions: Sequence[str]) -> DataFrame:
    """One row per item with an array of correlators, strongest first, per action.

    Lists hold at most k entries by construction of :func:`top_correlators`. An item
    without correlators has no row; an action without any is NULL.
    """
    def ranked(action: str) -> Column:
        entry = F.when(F.col("action") == action, F.struct("rank", "correlator"))
        ids = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["correlator"])
        return F.when(F.size(ids) > 0, ids).alias(action)

    return corr.groupBy("item").agg(*[ranked(a) for a in actions])


class Numbered(NamedTuple):
    """Rows of both sides with items as numbers and their counts, the numbers' items, and the pairs to come."""

    left: DataFrame
    right: DataFrame
    names: DataFrame
    sizes: DataFrame
    work: PairWork


def _numbered(actions: DataFrame, specs: Sequence[Indicator], seed: int, tile: int, secondary_only: bool = False) -> Numbered:
    """The two sides of the join on ``user``.

    The rows are frozen, so the log is read once; a cap treats each user on their own, so
    restricting the users afterwards gives the same rows as before. Item counts travel with
    the rows: after their aggregation pairs need no join.
    """
    primary = specs[0].name
    caps = {s.name: s.max_items_per_user for s in specs}
    kept = freeze(downsample(actions.where(F.col("event").isin(list(caps))), caps, seed))
    kept = restrict_to_primary_users(kept, primary)
    per_item = kept.groupBy("item").agg(
        F.array(*[F.count_if(F.col("event") == s.name) for s in specs]).alias("counts")
    )
    names = number_rows(per_item, [F.asc("item")], "item_no")
    event_no = per_event(None, {s.name: i for i, s in enumerate(specs)}).cast("int")
    counted = freeze(
        kept.withColumn("event", event_no)
        .join(names, "item")
        .select(
            "user", "event", F.col("item_no").alias("item"),
            F.get("counts", F.col("event")).alias("n_users"),
        )
    )
    left = counted.where("event = 0").select("user", "item", F.col("n_users").alias("ca"))
    right = counted.where(F.col("event") >= int(secondary_only)).select(
        "user", "event", F.col("item").alias("correlator"), F.col("n_users").alias("cb"))
    sizes = user_sizes(left, right)
    return Numbered(left, right, names, sizes, pair_work(sizes, tile))


def directed_pairs(found: Numbered, events: int, tile: int, most: int = PAIRS_PER_ITEM_TASK) -> DataFrame:
    """(event, item, correlator, k11, ca, cb, llr) in both orders inside the primary event (0), an item's pairs close together.

    A pair is not a row before it lies with its item: each row of a user's item meets the user's
    correlators as one list (of a tile, if there are many), and the lists are shuffled by item. A pair so
    takes two numbers of a list instead of a row of six, its aggregation needs no further shuffle, and of the pairs
    of an item all but the top k are dropped before they are shuffled again. An item with more than ``most`` pairs
    goes to several tasks, by correlator.
    """
    left, right, _, sizes, work = found
    heavy = (
        left.join(sizes.select("user", "r"), "user").groupBy("item").agg(F.sum("r").alias("_w")).where(F.col("_w") > most)
        .select("item", F.ceil(F.col("_w") / most).cast("int").alias("_parts")))
    # At most (pairs / most) rows.
    left = left.join(F.broadcast(heavy), "item", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    keys = ["user", "_l", "_r"]
    partitions = max(_parallel(left), -(-work.light // PAIRS_PER_PARTITION) - (-work.heavy // HEAVY_PAIRS_PER_PARTITION))
    left, right = (side.repartition(partitions, *keys) for side in tile_users(left, right, tile, sizes))
    entry = F.struct((F.col("correlator") * events + F.col("event")).alias("code"), "cb")
    lists = right.groupBy(*keys).agg(F.collect_list(entry).alias("_list")).select(
        *keys, F.col("_list.code").alias("codes"), F.col("_list.cb").alias("cbs"))
    whole = left.join(lists.hint("merge"), keys).withColumn("_part", F.explode(F.expr("sequence(0, _parts - 1)")))
    own = "pmod(xxhash64({}), _parts) = _part"
    dealt = whole.select(
        "item", "ca", "_part",
        F.expr(f"if(_parts = 1, codes, filter(codes, c -> {own.format('c')}))").alias("code"),
        F.expr(f"if(_parts = 1, cbs, filter(cbs, (b, i) -> {own.format('codes[i]')}))").alias("cb"))

    tasks = max(_parallel(left), -(-(work.light + work.heavy) // most))
    rows = dealt.repartition(tasks, "item", "_part").select("item", "ca", "_part", F.inline(F.arrays_zip("code", "cb")))
    # Both orders of a pair are scored as the one in which the item is the smaller, so that they agree in every digit.
    mirrored = (F.col("event") == 0) & (F.col("item") > F.col("correlator"))
    first, second = (F.when(mirrored, F.col(x)).otherwise(F.col(y)) for x, y in (("cb", "ca"), ("ca", "cb")))
    return (
        rows.withColumns({"event": (F.col("code") % events).cast("int"), "correlator": F.expr(f"code div {events}")})
        .where("event <> 0 or item <> correlator")
        .groupBy("item", "_part", "event", "correlator")
        .agg(F.count("*").alias("k11"), F.max("ca").alias("ca"), F.max("cb").alias("cb"))
        .withColumn("llr", llr(F.col("k11"), first, second, F.lit(work.users)))
        .drop("_part")
    )


def scored_numbers(
    actions: DataFrame,
    specs: Sequence[Indicator],
    seed: int,
    tile: int = TILE,
    secondary_only: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(pairs, names): every scored pair as numbers, and the item of each number.

    pairs is (event, item, correlator, k11, ca, cb, llr): ``event`` is a spec's place, items
    are numbered in the order of their ids. Of the pairs inside the primary event (0) there is
    one order, item < correlator; ``secondary_only`` leaves them out.
    """
    left, right, names, sizes, work = _numbered(actions, specs, seed, tile, secondary_only)
    pairs = (
        user_pairs(left, right, tile, sizes, work)
        .where("event <> 0 or item < correlator")
        .groupBy("event", "item", "correlator")
        .agg(F.count("*").alias("k11"), F.max("ca").alias("ca"), F.max("cb").alias("cb"))
        .withColumn("llr", llr(F.col("k11"), F.col("ca"), F.col("cb"), F.lit(work.users)))
    )
    return pairs, names


def named(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """``pairs`` with the items' ids in place of their numbers."""
    for column in ("item", "correlator"):
        ids = names.select(F.col("item_no").alias(column), F.col("item").alias("_id"))
        pairs = pairs.join(ids, column).drop(column).withColumnRenamed("_id", column)
    return pairs


def indicators(
    actions: DataFrame,
    specs: Sequence[Indicator],
    seed: int,
    tile: int = TILE,
) -> DataFrame:
    """CORR (action, item, correlator, llr, rank) for all event types in one pass.

    ``actions`` is binarized; the first spec is the primary event, and users without
    it do not count. Every spec brings its own cap, list length and threshold, and is
    matched to the data by event name. Pairs are counted, scored and ranked as plain
    numbers and named again when only the top k are left.
    """
    found = _numbered(actions, specs, seed, tile)
    pairs = directed_pairs(found, len(specs), tile)
    low = F.lit(None).cast("double")
    for i, spec in enumerate(specs):
        if spec.min_llr is not None:
            low = F.when(F.col("event") == i, F.lit(float(spec.min_llr))).otherwise(low)
    strong = pairs.where(F.when(low.isNull(), F.col("llr") > 0).otherwise(F.col("llr") >= low))

    corr = strong.select(F.col("event").alias("action"), "item", "correlator", "llr")
    top = top_correlators(corr, {i: s.max_correlators_per_item for i, s in enumerate(specs)})
    return named(top, found.names).select(
        F.element_at(F.array(*[F.lit(s.name) for s in specs]), F.col("action") + 1).alias("action"),
        "item", "correlator", "llr", "rank",
    )
