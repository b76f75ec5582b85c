"""Engine parameters. Plain values only; nothing here touches Spark."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta

# Limits and names a caller gets when a parameter is left out. Events are not
# limited unless a caller asks for it.
DEFAULT_MAX_CORRELATORS_PER_EVENT_TYPE = 50
DEFAULT_NUM = 10
DEFAULT_BIAS = 1.0
DEFAULT_RETURN_SELF = False
DEFAULT_RANKING_DURATION = "3650 days"
DEFAULT_SEED = 1


class RecsModel:
    ALL = "all"
    COLLAB_FILTERING = "collabFiltering"
    BACKFILL = "backfill"
    NAMES = (ALL, COLLAB_FILTERING, BACKFILL)


class RankingType:
    POPULAR = "popular"
    TRENDING = "trending"
    HOT = "hot"
    USER_DEFINED = "userDefined"
    RANDOM = "random"


# The rank column each ranking type fills when it has no name of its own.
RANK_FIELD_BY_TYPE = {
    RankingType.POPULAR: "popRank",
    RankingType.TRENDING: "trendRank",
    RankingType.HOT: "hotRank",
    RankingType.USER_DEFINED: "userRank",
    RankingType.RANDOM: "uniqueRank",
}

_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}
_UNIT_ALIASES = {
    "second": "s", "sec": "s", "s": "s",
    "minute": "m", "min": "m", "m": "m",
    "hour": "h", "hr": "h", "h": "h",
    "day": "d", "d": "d",
}


def parse_duration(text: str | timedelta) -> timedelta:
    """``"30 days"``, ``"12 hours"``, ``"90 s"`` as a timedelta."""
    if isinstance(text, timedelta):
        return text
    found = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", text)
    unit = found and _UNIT_ALIASES.get(re.sub(r"(?<=..)s$", "", found[2].lower()))
    if not unit:
        raise ValueError(f"not a duration: {text!r}")
    return timedelta(seconds=int(found[1]) * _UNIT_SECONDS[unit])


def parse_instant(text: str | datetime | None) -> datetime | None:
    """ISO date or date-time; zoned values become naive UTC. ``None`` if unreadable."""
    if isinstance(text, str):
        try:
            text = datetime.fromisoformat(text)
        except ValueError:
            return None
    if text is not None and text.tzinfo is not None:
        text = (text - text.utcoffset()).replace(tzinfo=None)
    return text


@dataclass(frozen=True)
class Field:
    """A metadata clause: ``bias >= 0`` boosts matching items, ``bias < 0`` filters."""

    name: str
    values: tuple[str, ...]
    bias: float

    def __post_init__(self):
        object.__setattr__(self, "values", tuple(self.values))

    @property
    def is_filter(self) -> bool:
        return self.bias < 0


@dataclass(frozen=True)
class Indicator:
    """How one event type contributes to the correlators; all items of a user, unless capped."""

    name: str
    max_items_per_user: int | None = None
    max_correlators_per_item: int = DEFAULT_MAX_CORRELATORS_PER_EVENT_TYPE
    min_llr: float | None = None


@dataclass(frozen=True)
class Ranking:
    """One backfill ranking. Empty ``event_names`` means the primary event."""

    type: str = RankingType.POPULAR
    name: str | None = None
    event_names: tuple[str, ...] = ()
    offset_date: str | None = None
    duration: str = DEFAULT_RANKING_DURATION

    def __post_init__(self):
        if self.type not in RANK_FIELD_BY_TYPE:
            raise ValueError(
                f"unknown ranking type {self.type!r}; use one of {sorted(RANK_FIELD_BY_TYPE)}"
            )
        object.__setattr__(self, "event_names", tuple(self.event_names or ()))

    @property
    def field(self) -> str:
        return self.name or RANK_FIELD_BY_TYPE[self.type]


@dataclass(frozen=True)
class EventWindow:
    """Event-log retention: what :func:`clean_events` keeps and tidies."""

    duration: str | None = None
    remove_duplicates: bool = True
    compress_properties: bool = True


@dataclass(frozen=True)
class EngineConfig:
    app_name: str
    index_name: str
    type_name: str
    event_names: tuple[str, ...] = ()
    indicators: tuple[Indicator, ...] = ()
    recs_model: str = RecsModel.ALL
    blacklist_events: tuple[str, ...] = ()
    max_query_events: int | None = None
    max_events_per_event_type: int | None = None
    max_correlators_per_event_type: int = DEFAULT_MAX_CORRELATORS_PER_EVENT_TYPE
    num: int = DEFAULT_NUM
    user_bias: float = DEFAULT_BIAS
    item_bias: float = DEFAULT_BIAS
    return_self: bool = DEFAULT_RETURN_SELF
    fields: tuple[Field, ...] = ()
    rankings: tuple[Ranking, ...] = ()
    available_date_name: str | None = None
    expire_date_name: str | None = None
    date_name: str | None = None
    event_window: EventWindow | None = None
    min_events_per_user: int = 1
    seed: int = DEFAULT_SEED
    clause_score: str = "count"

    def __post_init__(self):
        for required in ("app_name", "index_name", "type_name"):
            if not getattr(self, required):
                raise ValueError(f"{required} is required")
        if not self.event_names and not self.indicators:
            raise ValueError("event_names or indicators is required")
        if self.clause_score not in ("count", "any"):
            raise ValueError("clause_score is 'count' or 'any'")
        for many in ("event_names", "indicators", "blacklist_events", "fields", "rankings"):
            object.__setattr__(self, many, tuple(getattr(self, many) or ()))

    @property
    def model_event_names(self) -> tuple[str, ...]:
        """Event types of the model; the first is the primary event."""
        return tuple(i.name for i in self.indicators) or self.event_names

    @property
    def primary_event(self) -> str:
        return self.model_event_names[0]

    @property
    def effective_indicators(self) -> tuple[Indicator, ...]:
        return self.indicators or tuple(
            Indicator(name, self.max_events_per_event_type, self.max_correlators_per_event_type)
            for name in self.event_names
        )

    @property
    def effective_rankings(self) -> tuple[Ranking, ...]:
        """Rankings with defaults applied, in the order results are sorted by."""
        rankings = self.rankings or (Ranking(),)
        return tuple(sorted(rankings, key=lambda r: (r.type, r.field)))

    @property
    def date_names(self) -> tuple[str, ...]:
        names = (self.date_name, self.available_date_name, self.expire_date_name)
        return tuple(dict.fromkeys(n for n in names if n))

    @property
    def rank_names(self) -> tuple[str, ...]:
        return ranking_fields(self.effective_rankings)


def ranking_fields(rankings) -> tuple[str, ...]:
    """Rank columns in sort order: by ranking type, then by name."""
    return tuple(r.field for r in sorted(rankings, key=lambda r: (r.type, r.field)))
