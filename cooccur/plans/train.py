"""Training: event log and item properties to one document per item (MODEL).

MODEL  id, <event> ARRAY<STRING>..., <rank> DOUBLE..., <metadata> typed...
"""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cooccur.config import EngineConfig, RecsModel
from cooccur.operators.popularity import combine_rankings
from cooccur.operators.prepare import binarize, min_events_per_user
from cooccur.operators.properties import aggregate_properties, extract_typed, props_to_map
from cooccur.operators.similarity import correlator_lists, indicators
from cooccur.operators.cleaning import clean_events
from cooccur.sources.events import app_events, scan_events, split_actions
from cooccur.session import freeze
from cooccur.sources.store import field_types, property_types


def sanity_check(actions: DataFrame, props: DataFrame | None, primary_event: str) -> None:
    """Fail early on training data that cannot give a model."""
    if actions.isEmpty():
        raise ValueError("no actions: the event log has none of the configured event types")
    if actions.where(F.col("event") == primary_event).isEmpty():
        raise ValueError(f"no users with the primary event {primary_event!r}")
    if props is not None and props.isEmpty():
        raise ValueError("no item properties")


def check_mode(mode: str) -> None:
    if mode not in RecsModel.NAMES:
        raise ValueError(f"unknown recs_model {mode!r}; use one of {', '.join(RecsModel.NAMES)}")


def actions_of(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    return split_actions(scan_events(app_events(events, cfg.app_name), names=cfg.model_event_names), cfg.model_event_names)


def correlators(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """CORR of the configured event types."""
    actions = min_events_per_user(actions_of(events, cfg), cfg.min_events_per_user)
    return indicators(binarize(actions), cfg.effective_indicators, cfg.seed)


def rankings(events: DataFrame, props: DataFrame, cfg: EngineConfig, as_of=None) -> DataFrame:
    """RANKS of the configured rankings."""
    actions = scan_events(app_events(events, cfg.app_name)).select(
        "event", F.col("target_entity_id").alias("item"), F.col("event_time").alias("ts")
    )
    return combine_rankings(
        actions, props, cfg.effective_rankings, cfg.primary_event, as_of, cfg.seed
    )


def typed_fields(props: DataFrame, cfg: EngineConfig, types: dict[str, str] | None = None) -> DataFrame:
    """(id, one typed column per property). The schema is discovered unless given."""
    if types is None:
        types = field_types(property_types(props, cfg.date_names, cfg.rank_names))
    return extract_typed(props_to_map(props), cfg.date_names, cfg.rank_names, types).withColumnRenamed("item", "id")


def assemble(parts: list[DataFrame]) -> DataFrame:
    """One row per id from partial documents; where two give a column, the later wins.

    All parts meet in one aggregation by id rather than a chain of outer joins.
    """
    columns: dict[str, list[int]] = {}
    for i, part in enumerate(parts):
        for c in part.columns:
            if c != "id":
                columns.setdefault(c, []).append(i)
    kinds = {c: parts[owners[-1]].schema[c].dataType for c, owners in columns.items()}

    def aligned(i: int, part: DataFrame) -> DataFrame:
        cells = []
        for c, owners in columns.items():
            for owner in owners:
                value = F.col(c) if owner == i else F.lit(None)
                cells.append(value.cast(kinds[c]).alias(f"{c}@{owner}"))
        return part.select("id", *cells)

    rows = reduce(DataFrame.unionByName, [aligned(i, p) for i, p in enumerate(parts)])
    return rows.groupBy("id").agg(*[
        F.coalesce(*[F.first(f"{c}@{o}", ignorenulls=True) for o in reversed(owners)]).alias(c)
        for c, owners in columns.items()
    ])


def train(
    events: DataFrame,
    cfg: EngineConfig,
    as_of=None,
    current: DataFrame | None = None,
    types: dict[str, str] | None = None,
    props: DataFrame | None = None,
    check: bool = True,
) -> DataFrame:
    """MODEL for the configured mode.

    ``current`` is the published model that ``backfill`` refreshes (``None`` if there
    is none yet); ``props`` replaces the properties found in the event log. Only events
    of the configured app count, after the configured ``event_window`` if there is one.
    """
    check_mode(cfg.recs_model)
    events = app_events(events, cfg.app_name)
    if cfg.event_window is not None:
        now = as_of or datetime.now(UTC).replace(tzinfo=None)
        cleaned, _ = clean_events(events, cfg.event_window, now)
        events = freeze(cleaned.withColumn("app", F.lit(cfg.app_name)))
    if props is None:
        props = aggregate_properties(events)
    if check:
        sanity_check(actions_of(events, cfg), props, cfg.primary_event)
    lists = None
    if cfg.recs_model != RecsModel.BACKFILL:
        lists = correlator_lists(correlators(events, cfg), cfg.model_event_names)
        lists = lists.withColumnRenamed("item", "id")
    if cfg.recs_model == RecsModel.COLLAB_FILTERING:
        return lists
    fields = typed_fields(props, cfg, types)
    ranks = rankings(events, props, cfg, as_of).withColumnRenamed("item", "id")
    base = lists if lists is not None else current
    return assemble([part for part in (base, fields, ranks) if part is not None])
