"""Item rankings over a time interval, used as backfill and tie-breakers.

All event-based rankings of a configuration are conditional counts in one scan and
one aggregation; sub-intervals never cause a second read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.config import Ranking, RankingType, parse_duration, parse_instant
from cooccur.functions.scores import unit_random
from cooccur.sources.events import as_time_of


@dataclass(frozen=True)
class Interval:
    start: datetime
    end: datetime

    def cut(self, parts: int) -> list[datetime]:
        """Bounds of ``parts`` equal pieces in whole milliseconds; the last takes the rest."""
        length = (self.end - self.start) // timedelta(milliseconds=1) // parts
        step = timedelta(milliseconds=length)
        return [self.start + step * i for i in range(parts)] + [self.end]


def ranking_interval(duration, offset_date=None, as_of=None) -> Interval:
    """``[end - duration, end)``; end is the offset date, else ``as_of``, else now."""
    end = parse_instant(offset_date) or parse_instant(as_of)
    end = end or datetime.now(timezone.utc).replace(tzinfo=None)
    return Interval(end - parse_duration(duration), end)


def _within(actions: DataFrame, start: datetime, end: datetime, names: Iterable[str]) -> Column:
    inside = (F.col("ts") >= as_time_of(actions, "ts", start)) & (
        F.col("ts") < as_time_of(actions, "ts", end)
    )
    names = list(names or [])
    return inside & F.col("event").isin(names) if names else inside


def _counts(actions: DataFrame, names, bounds: Sequence[datetime]) -> list[Column]:
    """One conditional count per piece, oldest first."""
    return [
        F.count_if(_within(actions, lo, hi, names)) for lo, hi in zip(bounds, bounds[1:], strict=False)
    ]


def _with_item(actions: DataFrame) -> DataFrame:
    return actions.where(F.col("item") != "")


def popular(actions: DataFrame, names: Iterable[str], interval: Interval) -> DataFrame:
    """(item, rank): events per item."""
    return (
        _with_item(actions)
        .where(_within(actions, interval.start, interval.end, names))
        .groupBy("item")
        .agg(F.count("*").cast("double").alias("rank"))
    )


def _differences(actions, names, interval, parts, combine) -> DataFrame:
    pieces = [f"_p{i}" for i in range(parts)]
    counts = _counts(actions, names, interval.cut(parts))
    seen_in_all = " and ".join(f"{p} > 0" for p in pieces)
    return (
        _with_item(actions)
        .where(_within(actions, interval.start, interval.end, names))
        .groupBy("item")
        .agg(*[c.alias(p) for c, p in zip(counts, pieces, strict=True)])
        .where(seen_in_all)
        .select("item", combine(*[F.col(p) for p in pieces]).cast("double").alias("rank"))
    )


def trending(actions: DataFrame, names: Iterable[str], interval: Interval) -> DataFrame:
    """(item, rank): newer half minus older half, items seen in both."""
    return _differences(actions, names, interval, 2, lambda old, new: new - old)


def hot(actions: DataFrame, names: Iterable[str], interval: Interval) -> DataFrame:
    """(item, rank): change of the change over thirds, items seen in all three."""
    return _differences(
        actions, names, interval, 3, lambda old, mid, new: (new - mid) - (mid - old)
    )


def random_rank(actions: DataFrame, items: DataFrame, interval: Interval, seed: int) -> DataFrame:
    """(item, rank): a reproducible number in [0, 1) for items seen or described."""
    seen = _with_item(actions).where(_within(actions, interval.start, interval.end, ()))
    every = seen.select("item").unionByName(items.select("item")).distinct()
    return every.select("item", unit_random(seed, "item").alias("rank"))


def user_defined(props: DataFrame, field: str) -> DataFrame:
    """(item, rank) read from a property in PROPS; text that is no number has no rank."""
    return (
        props.where(F.col("key") == field)
        .select("item", F.col("value").try_cast("double").alias("rank"))
        .where("rank is not null")
    )


def combine_rankings(
    actions: DataFrame,
    props: DataFrame,
    rankings: Sequence[Ranking],
    primary_event: str,
    as_of=None,
    seed: int = 1,
) -> DataFrame:
    """RANKS (item, one column per ranking); an item keeps whatever ranks it has.

    Event-based rankings share one conditional aggregation. Property and random
    ranks join it as long rows in the final per-item aggregation, not as a chain of
    outer joins.
    """
    pieces: list[Column] = []
    windows: list[Column] = []
    ranks: dict[str, Column] = {}
    extra: list[DataFrame] = []
    for i, ranking in enumerate(rankings):
        span = ranking_interval(ranking.duration, ranking.offset_date, as_of)
        names = ranking.event_names or (primary_event,)
        if ranking.type == RankingType.USER_DEFINED:
            extra.append(_long(user_defined(props, ranking.field), ranking.field))
            continue
        if ranking.type == RankingType.RANDOM:
            names, parts = (), 1
            described = props.select("item").distinct()
            extra.append(
                _long(described.select("item", unit_random(seed, "item").alias("rank")), ranking.field)
            )
        else:
            parts = {RankingType.POPULAR: 1, RankingType.TRENDING: 2, RankingType.HOT: 3}[ranking.type]
        aliases = [f"_r{i}_{p}" for p in range(parts)]
        counts = _counts(actions, names, span.cut(parts))
        pieces += [c.alias(a) for c, a in zip(counts, aliases, strict=True)]
        windows.append(_within(actions, span.start, span.end, names))
        ranks[ranking.field] = _rank_of(ranking.type, [F.col(a) for a in aliases], seed)

    frames = list(extra)
    if pieces:
        relevant = windows[0]
        for window in windows[1:]:
            relevant = relevant | window
        counted = _with_item(actions).where(relevant).groupBy("item").agg(*pieces)
        entries = F.array(*[
            F.struct(F.lit(field).alias("field"), rank.alias("rank")) for field, rank in ranks.items()
        ])
        frames.append(
            counted.select("item", F.inline(entries)).where("rank is not null")
        )
    long = frames[0]
    for frame in frames[1:]:
        long = long.unionByName(frame)
    return long.groupBy("item").agg(*[
        F.max(F.when(F.col("field") == r.field, F.col("rank"))).alias(r.field) for r in rankings
    ])


def _long(ranked: DataFrame, field: str) -> DataFrame:
    return ranked.select("item", F.lit(field).alias("field"), "rank")


def _rank_of(kind: str, counts: list[Column], seed: int) -> Column:
    """Rank from the conditional counts; NULL where the item does not qualify."""
    qualifies = counts[0] > 0
    for count in counts[1:]:
        qualifies = qualifies & (count > 0)
    if kind == RankingType.POPULAR:
        value = counts[0]
    elif kind == RankingType.TRENDING:
        value = counts[1] - counts[0]
    elif kind == RankingType.HOT:
        value = (counts[2] - counts[1]) - (counts[1] - counts[0])
    else:
        value = unit_random(seed, "item")
    return F.when(qualifies, value.cast("double"))
