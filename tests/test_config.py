from datetime import datetime, timedelta

import pytest

from cooccur import EngineConfig, Field, Indicator, Ranking
from cooccur.config import parse_duration, parse_instant, ranking_fields

BASE = dict(app_name="a", index_name="i", type_name="t")


@pytest.mark.parametrize("text, expected", [
    ("3650 days", timedelta(days=3650)), ("1 day", timedelta(days=1)), ("12 hours", timedelta(hours=12)),
    ("90 s", timedelta(seconds=90)), ("5m", timedelta(minutes=5)), ("2 mins", timedelta(minutes=2)),
])
def test_durations(text, expected):
    assert parse_duration(text) == expected


def test_bad_duration():
    with pytest.raises(ValueError):
        parse_duration("soon")


def test_instants_become_naive_utc():
    assert parse_instant("2024-01-01T02:00:00+02:00") == datetime(2024, 1, 1)
    assert parse_instant("nonsense") is None


def test_required_members():
    with pytest.raises(ValueError):
        EngineConfig(**BASE)
    with pytest.raises(ValueError):
        EngineConfig(**{**BASE, "index_name": ""}, event_names=("buy",))


def test_indicators_come_before_event_names():
    cfg = EngineConfig(**BASE, event_names=("view",), indicators=(Indicator("buy"), Indicator("view")))
    assert cfg.model_event_names == ("buy", "view") and cfg.primary_event == "buy"
    assert EngineConfig(**BASE, event_names=("view", "buy")).primary_event == "view"


def test_event_names_alone_give_default_indicators():
    cfg = EngineConfig(**BASE, event_names=("buy",), max_events_per_event_type=7)
    assert cfg.effective_indicators == (Indicator("buy", 7, 50),)
    assert cfg.max_query_events is None
    assert EngineConfig(**BASE, event_names=("buy",)).effective_indicators == (Indicator("buy", None, 50),)


def test_rankings_get_defaults_before_they_are_sorted():
    cfg = EngineConfig(**BASE, event_names=("buy",))
    assert cfg.rank_names == ("popRank",)
    several = [Ranking("trending"), Ranking("hot", name="z"), Ranking("hot"), Ranking("popular")]
    assert ranking_fields(several) == ("hotRank", "z", "popRank", "trendRank")


def test_unknown_ranking_type():
    with pytest.raises(ValueError):
        Ranking("viral")


def test_fields():
    assert Field("f", ["v"], -1.0).is_filter and not Field("f", ["v"], 0.0).is_filter
