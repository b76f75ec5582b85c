import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cooccur.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""
    def collect(df, *columns):
        got = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in got.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def micro(spark):
    """EVENTS: 4 users, 5 items, a duplicate, a missing target, a property chain."""
    schema = (
        "event_id string, event string, entity_type string, entity_id string, "
        "target_entity_type string, target_entity_id string, event_time string, properties string"
    )
    log = []

    def add(event, user, item, day):
        log.append((f"e{len(log)}", event, "user", user, "item", item, f"2024-01-{day:02d} 10:00:00", None))

    for user, item, day in [("u1", "a", 2), ("u1", "b", 3), ("u2", "a", 4), ("u2", "b", 20),
                            ("u2", "c", 21), ("u3", "a", 22), ("u3", "c", 23)]:
        add("buy", user, item, day)
    for user, item, day in [("u1", "d", 1), ("u2", "d", 5), ("u3", "e", 6), ("u4", "e", 7), ("u4", "a", 25)]:
        add("view", user, item, day)
    add("buy", "u1", "a", 2)
    add("view", "u1", None, 9)

    def prop(event, item, text, day):
        log.append((f"p{len(log)}", event, "item", item, None, None, f"2024-01-{day:02d} 00:00:00", text))

    prop("$set", "a", '{"color":"red","size":"1","tags":["x","y"]}', 1)
    prop("$set", "a", '{"color":"blue"}', 3)
    prop("$unset", "a", '{"size":""}', 2)
    prop("$set", "b", '{"color":"red","size":"7"}', 1)
    frame = spark.createDataFrame(log, schema)
    return frame.selectExpr(
        *[c for c in frame.columns if c not in ("event_time", "properties")],
        "cast(event_time as timestamp_ntz) event_time", "properties",
        "cast(event_time as timestamp_ntz) creation_time",
    )
