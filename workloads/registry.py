"""One named query per operator, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cooccur import EventWindow, Field, Indicator, RecsModel
from cooccur.operators import clauses as cl
from cooccur.operators import cleaning, matching, popularity, prepare, properties, ranking, similarity
from cooccur.plans import recommend as rec
from cooccur.plans import train as tr
from cooccur.session import freeze, fresh_path
from cooccur.sources import events as ev
from cooccur.sources import queries as qs
from cooccur.sources import store
from cooccur.streaming import events as st
from workloads import tables as t

QUERIES = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _text(column: str):
    return F.array_join(column, ",").alias(column)


# --- sources and sinks --------------------------------------------------------


@register
def scan_events(spark: SparkSession, sf: str) -> DataFrame:
    found = ev.scan_events(
        t.event_log(spark, sf), names=["purchase", "view"], start="2024-01-05", until="2024-01-25"
    )
    return found.select(
        "event_id", "event", F.col("entity_id").alias("user"), F.col("target_entity_id").alias("item"),
        F.col("event_time").alias("ts"),
    )


@register
def two_apps(spark, sf):
    """Training on a log of two apps sees the configured one's events."""
    log = t.event_log(spark, sf).withColumn(
        "app", F.when(F.col("entity_id").cast("bigint") % 3 == 0, "other").otherwise("shop"))
    actions = tr.actions_of(log, t.engine())
    return actions.groupBy("event", "item").agg(F.count("*").alias("n"), F.countDistinct("user").alias("users"))


@register
def split_actions(spark, sf):
    return ev.split_actions(t.event_log(spark, sf), t.E_EVENTS)


@register
def interval_events(spark, sf):
    actions = ev.split_actions(t.event_log(spark, sf), t.E_EVENTS)
    return ev.events_in_interval(actions, "2024-01-10", "2024-01-20", ["view"])


@register
def recent_events(spark, sf):
    log = t.event_log(spark, sf)
    users = log.select(F.col("entity_id").alias("user"))
    recent = ev.recent_events_by_entity(log, users, t.E_EVENTS, 5)
    return recent.select(
        F.col("entity_id").alias("user"), "event", "event_id", F.col("recency").cast("bigint").alias("recency")
    )


def _queries(spark, sf) -> DataFrame:
    return qs.read_queries(t.query_texts(spark, sf))


@register
def read_queries(spark, sf):
    fields = F.transform(
        "fields", lambda f: F.concat_ws("/", f["name"], F.array_join(f["values"], "+"), f["bias"].cast("string"))
    )
    return _queries(spark, sf).select(
        "query_id", "user", "user_bias", "item", "item_bias", F.array_join(fields, ";").alias("fields"),
        "current_date", F.col("date_range.name").alias("range_name"), F.col("date_range.before").alias("before"),
        F.col("date_range.after").alias("after"), _text("blacklist_items"), "return_self",
        F.col("num").cast("double").alias("num"), _text("event_names"), "with_ranks", "error",
    )


def _item_documents(spark, sf) -> DataFrame:
    return t.items(spark, sf).withColumnRenamed("item", "id").withColumn("categories", F.array("brand", "type"))


@register
def publish_read_roundtrip(spark, sf):
    root = fresh_path(spark, "models")
    model = _item_documents(spark, sf)
    store.publish_model(model.withColumn("price", F.lit(0.0)), root, "items")
    store.publish_model(model, root, "items")
    return store.read_model(spark, root, "items").select(
        "id", "brand", "type", "price", _text("categories"), F.col("availableDate").cast("timestamp_ntz").alias("availableDate")
    )


@register
def lookup_items(spark, sf):
    seen = t.event_log(spark, sf).select(F.col("target_entity_id").alias("id"))
    return store.lookup_items(_item_documents(spark, sf), seen).select("id", "brand", "type", "price")


@register
def bundle_roundtrip(spark, sf):
    actions = ev.split_actions(t.event_log(spark, sf), t.E_EVENTS)
    root = fresh_path(spark, "bundle")
    store.save_bundle(
        {
            "user_index": prepare.id_dictionary(actions, "user"),
            "item_index": prepare.id_dictionary(actions, "item"),
            "popularity": actions.groupBy("item").agg(F.count("*").cast("double").alias("rank")),
            "items": t.items(spark, sf),
        },
        root,
    )
    kept = store.load_bundle(spark, root, ["user_index", "item_index", "popularity", "items"])
    indexed = actions.join(kept["popularity"], "item").join(kept["items"].select("item", "brand"), "item")
    indexed = prepare.encode(indexed, "user", kept["user_index"], "user_idx")
    return prepare.encode(indexed, "item", kept["item_index"], "item_idx").select(
        "event", "user_idx", "item_idx", "rank", "brand"
    )


@register
def model_fields(spark, sf):
    props = t.item_properties(spark, sf).unionByName(
        properties.aggregate_properties(t.property_log(spark, sf))
    )
    return store.model_fields(
        properties.props_to_map(props), ["availableDate", "expireDate"], ["userRank", "popRank"]
    )


# --- cleaning -----------------------------------------------------------------

_EVENT_OUT = ["event_id", "event", "entity_type", "entity_id", "target_entity_id", "event_time"]


@register
def clean_window(spark, sf):
    return cleaning.clean_event_window(t.full_log(spark, sf), "10 days", t.AS_OF).select(*_EVENT_OUT)


@register
def dedup_events(spark, sf):
    return cleaning.dedup_events(t.full_log(spark, sf)).select(*_EVENT_OUT, "properties", "creation_time")


@register
def compress_props(spark, sf):
    return cleaning.compress_properties(t.full_log(spark, sf)).select(*_EVENT_OUT, "properties")


@register
def remove_events(spark, sf):
    log = t.full_log(spark, sf)
    errors = log.where(F.col("event") == "error").select("event_id")
    return cleaning.remove_events(log, errors).select(*_EVENT_OUT)


@register
def clean_all(spark, sf):
    """Read back from the published version."""
    root = fresh_path(spark, "cleaned")
    kept, _ = cleaning.publish_cleaned(t.full_log(spark, sf), EventWindow("10 days"), t.AS_OF, root)
    return kept.select(*_EVENT_OUT, "properties")


@register
def clean_removed(spark, sf):
    _, removed = cleaning.clean_events(t.full_log(spark, sf), EventWindow("10 days"), t.AS_OF)
    return removed


# --- properties ---------------------------------------------------------------


@register
def aggregate_props(spark, sf):
    return properties.aggregate_properties(t.property_log(spark, sf))


def _map_text(column: str):
    entries = F.transform(F.map_entries(column), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.array_sort(entries), ";").alias(column)


@register
def props_to_map(spark, sf):
    props = properties.aggregate_properties(t.property_log(spark, sf))
    return properties.props_to_map(props).select("item", _map_text("props"))


@register
def combine_maps(spark, sf):
    described = t.item_properties(spark, sf)
    logged = properties.aggregate_properties(t.property_log(spark, sf))
    override = logged.where(F.col("key") == "p1").withColumn("key", F.lit("brand"))
    return properties.combine_maps_by_key([described, logged, override])


@register
def combine_collections(spark, sf):
    actions = ev.split_actions(t.event_log(spark, sf), t.E_EVENTS)
    lists = actions.select("user", F.array("item", "event").alias("words"))
    return properties.combine_collections_by_key(lists, "user", "words").select("user", _text("words"))


@register
def union_all(spark, sf):
    actions = ev.split_actions(t.event_log(spark, sf), t.E_EVENTS)
    described = t.items(spark, sf).select("item", "brand")
    return properties.union_all([actions.select("user", "item"), described, actions.select("event", "item")])


@register
def merge_fields_ranks(spark, sf):
    span = popularity.ranking_interval("30 days", t.AS_OF)
    actions = ev.split_actions(t.event_log(spark, sf), t.E_EVENTS)
    ranks = popularity.popular(actions, ["view"], span).withColumnRenamed("rank", "price")
    fields = t.items(spark, sf).select("item", "brand", "price")
    return properties.merge_fields_ranks(fields, ranks.withColumn("popRank", F.col("price") * 2))


@register
def extract_typed(spark, sf):
    maps = properties.props_to_map(t.item_properties(spark, sf))
    schema = {"brand": "string", "categories": "array<string>", "userRank": "string",
              "availableDate": "string", "expireDate": "array<string>"}
    typed = properties.extract_typed(maps, ["availableDate", "expireDate"], ["userRank"], schema)
    return typed.select(
        "item", "brand", _text("categories"), "userRank", "availableDate",
        F.get("expireDate", F.lit(0)).alias("expireDate"),
    )


# --- interaction preparation --------------------------------------------------


def _e_actions(spark, sf) -> DataFrame:
    return ev.split_actions(t.event_log(spark, sf), t.E_EVENTS)


def _o_actions(spark, sf) -> DataFrame:
    return t.order_actions(spark, sf)


@register
def binarize(spark, sf):
    return prepare.binarize(_e_actions(spark, sf))


@register
def primary_users(spark, sf):
    return prepare.restrict_to_primary_users(prepare.binarize(_o_actions(spark, sf)), "buy")


@register
def id_dictionary(spark, sf):
    return prepare.id_dictionary(_o_actions(spark, sf), "user")


@register
def dictionary_merge(spark, sf):
    first = prepare.id_dictionary(_e_actions(spark, sf), "item")
    return prepare.id_dictionary(_o_actions(spark, sf), "item", first)


@register
def encode_decode(spark, sf):
    known = prepare.id_dictionary(_e_actions(spark, sf), "item")
    pairs = prepare.binarize(_o_actions(spark, sf))
    coded = prepare.encode(pairs, "item", known, "idx", default=-1)
    counted = coded.groupBy("event", "idx").agg(F.count("*").alias("n"))
    return prepare.decode(counted, "idx", known, "item", default="unknown")


@register
def dictionary_take(spark, sf):
    return prepare.take(prepare.id_dictionary(_o_actions(spark, sf), "item"), 25)


@register
def interaction_counts(spark, sf):
    return prepare.interaction_counts(prepare.binarize(_o_actions(spark, sf)))


@register
def downsample(spark, sf):
    return prepare.downsample(prepare.binarize(_o_actions(spark, sf)), {"buy": 8, "view": 5, "cart": 5}, 7)


@register
def downsample_items(spark, sf):
    return prepare.downsample(prepare.binarize(_e_actions(spark, sf)), 10, 7, max_per_item=6)


@register
def min_events_per_user(spark, sf):
    return prepare.min_events_per_user(prepare.binarize(_o_actions(spark, sf)), 30)


# --- similarity ---------------------------------------------------------------


def _primary(spark, sf) -> DataFrame:
    pairs = prepare.binarize(_e_actions(spark, sf))
    return pairs.where(F.col("event") == "purchase").select("user", "item")


def _buyers_pairs(spark, sf) -> DataFrame:
    pairs = prepare.binarize(_e_actions(spark, sf).where(F.col("event").isin("purchase", "view")))
    return prepare.restrict_to_primary_users(pairs, "purchase")


def _scored(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Scored pairs of purchases and views by item numbers, and the numbers' items."""
    actions = prepare.binarize(_e_actions(spark, sf))
    return similarity.scored_numbers(
        actions, [Indicator("purchase"), Indicator("view")], 1, secondary_only=True
    )


def _named(pairs, names) -> DataFrame:
    return similarity.named(pairs, names).select("item", "correlator", "k11", "ca", "cb", "llr")


@register
def cooccurrence(spark, sf):
    return similarity.cooccurrence(_primary(spark, sf))


@register
def cooccurrence_tiled(spark, sf):
    return similarity.cooccurrence(_primary(spark, sf), tile=4)


@register
def cross_occurrence(spark, sf):
    """Uncapped: heavy users are cut into tiles."""
    pairs = freeze(_buyers_pairs(spark, sf))
    primary, secondary = (
        pairs.where(F.col("event") == e).select("user", "item") for e in ("purchase", "view")
    )
    return similarity.cross_occurrence(primary, secondary)


@register
def llr_scores(spark, sf):
    """The operator on plain ids: counts are joined to the pairs."""
    pairs = freeze(_buyers_pairs(spark, sf))
    counts = prepare.interaction_counts(pairs)
    primary, secondary = (
        pairs.where(F.col("event") == e).select("user", "item") for e in ("purchase", "view")
    )
    of_primary, of_secondary = (
        counts.where(F.col("event") == e).select("item", "n_users") for e in ("purchase", "view")
    )
    return similarity.score_pairs(
        similarity.cross_occurrence(primary, secondary), of_primary, of_secondary,
        prepare.primary_user_count(pairs, "purchase"),
    )


@register
def min_llr(spark, sf):
    pairs, names = _scored(spark, sf)
    return _named(similarity.min_llr(pairs, 2.0), names)


@register
def cross_llr_topk(spark, sf):
    pairs, names = _scored(spark, sf)
    top = similarity.named(similarity.top_correlators(similarity.min_llr(pairs), 10), names)
    return top.select("item", "correlator", "llr", F.col("rank").cast("bigint").alias("rank"))


def _order_indicators(spark, sf) -> DataFrame:
    actions = prepare.binarize(_o_actions(spark, sf).where(F.col("event").isin(*t.O_EVENTS)))
    pairs = prepare.restrict_to_primary_users(actions, "buy")
    specs = [Indicator(event, max_correlators_per_item=10) for event in t.O_EVENTS]
    return similarity.indicators(pairs, specs, 1)


@register
def cross_llr_topk_orders(spark, sf):
    return _order_indicators(spark, sf).select(
        "action", "item", "correlator", "llr", F.col("rank").cast("bigint").alias("rank")
    )


def _corr(spark, sf, **changes) -> DataFrame:
    return tr.correlators(t.event_log(spark, sf), t.engine(**changes))


@register
def indicators_all(spark, sf):
    return _corr(spark, sf).select(
        "action", "item", "correlator", "llr", F.col("rank").cast("bigint").alias("rank")
    )


@register
def correlator_lists(spark, sf):
    lists = similarity.correlator_lists(_corr(spark, sf), t.E_EVENTS)
    return lists.select("item", *[_text(e) for e in t.E_EVENTS])


# --- rankings -----------------------------------------------------------------

_MONTH = popularity.ranking_interval("30 days", t.AS_OF)


@register
def rank_popular(spark, sf):
    return popularity.popular(_e_actions(spark, sf), ["purchase"], _MONTH)


@register
def rank_trending(spark, sf):
    return popularity.trending(_e_actions(spark, sf), ["view", "click"], _MONTH)


@register
def rank_hot(spark, sf):
    return popularity.hot(_e_actions(spark, sf), ["view"], _MONTH)


@register
def rank_random(spark, sf):
    return popularity.random_rank(_e_actions(spark, sf), t.items(spark, sf), _MONTH, 3)


@register
def rank_user_defined(spark, sf):
    return popularity.user_defined(t.item_properties(spark, sf), "userRank")


@register
def ranks_combined(spark, sf):
    return tr.rankings(t.event_log(spark, sf), t.item_properties(spark, sf), t.engine())


# --- training -----------------------------------------------------------------


def _model(spark, sf, **changes) -> DataFrame:
    current = changes.pop("current", None)
    return tr.train(
        t.event_log(spark, sf), t.engine(**changes), current=current,
        props=t.item_properties(spark, sf),
    )


def _model_text(model: DataFrame) -> DataFrame:
    return model.select(*[
        _text(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in model.schema
    ])


@register
def train_all(spark, sf):
    return _model_text(_model(spark, sf))


@register
def train_cf(spark, sf):
    return _model_text(_model(spark, sf, recs_model=RecsModel.COLLAB_FILTERING))


@register
def train_backfill(spark, sf):
    """Refresh a published collaborative model with newer ranks and fields."""
    root = fresh_path(spark, "backfill")
    stale = _model(spark, sf).withColumns({"brand": F.lit("old"), "popRank": F.lit(-1.0)})
    store.publish_model(stale, root, "items")
    refreshed = _model(
        spark, sf, recs_model=RecsModel.BACKFILL, current=store.read_model(spark, root, "items")
    )
    return _model_text(refreshed)


@register
def sanity_check(spark, sf):
    actions = _e_actions(spark, sf)
    tr.sanity_check(actions, t.item_properties(spark, sf), "purchase")
    return actions.groupBy("event").agg(F.countDistinct("user").alias("users"), F.count("*").alias("actions"))


# --- recommendation queries ---------------------------------------------------


def _served(spark, sf, **changes) -> DataFrame:
    """A trained model as queries meet it: published and read back."""
    root = fresh_path(spark, "served")
    store.publish_model(_model(spark, sf, **changes), root, "items")
    return store.read_model(spark, root, "items")


def _asked(spark, sf) -> DataFrame:
    return freeze(qs.resolve_queries(_queries(spark, sf), t.engine(), t.CURRENT_DATE))


def _history(spark, sf, asked) -> DataFrame:
    return cl.user_history(asked, t.event_log(spark, sf), t.E_EVENTS)


def _similar(asked, model) -> DataFrame:
    return cl.similar_items(asked, model, t.E_EVENTS)


@register
def q_rejects(spark, sf):
    """Every query once more, some cut off and some with another user: those that get no answer."""
    asked = t.query_texts(spark, sf)
    number = F.get_json_object("value", "$.queryId").cast("bigint")
    again = asked.where(number % 3 <= 1).select(
        F.when(number % 3 == 0, F.concat(F.lit("cut "), F.substring("value", 1, 8))).otherwise(
            F.regexp_replace("value", '"returnSelf":true,', "")).alias("value"),
        number.cast("string").alias("query_id"))
    whole = asked.select("value", number.cast("string").alias("query_id"))
    return qs.rejected_queries(qs.read_queries(whole.unionByName(again)))


@register
def q_history(spark, sf):
    return _history(spark, sf, _asked(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@register
def q_history_capped(spark, sf):
    """The one query about the cap: the latest three items per event type."""
    capped = cl.user_history(_asked(spark, sf), t.event_log(spark, sf), t.E_EVENTS, 3)
    return capped.withColumn("pos", F.col("pos").cast("bigint"))


@register
def q_similar(spark, sf):
    return _similar(_asked(spark, sf), _served(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@register
def q_boost_fields(spark, sf):
    shared = [Field("categories", ("LARGE",), 2.0), Field("brand", ("Brand#1",), -1.0)]
    return cl.boosted_fields(_asked(spark, sf), shared).withColumn("values", F.array_join("values", "+"))


@register
def q_score(spark, sf):
    model, asked = _served(spark, sf), _asked(spark, sf)
    clauses = freeze(rec.should_clauses(asked, _history(spark, sf, asked), _similar(asked, model), t.engine()))
    return matching.score_shared(clauses, matching.postings(model))


@register
def q_score_any(spark, sf):
    model, asked = _served(spark, sf), _asked(spark, sf)
    clauses = freeze(rec.should_clauses(asked, _history(spark, sf, asked), _similar(asked, model), t.engine()))
    return matching.score_shared(clauses, matching.postings(model), "any")


@register
def q_must_history(spark, sf):
    asked = _asked(spark, sf)
    clauses = rec.must_history(asked, _history(spark, sf, asked))
    return matching.matches_all(clauses, matching.postings(_served(spark, sf)))


@register
def q_must_similar(spark, sf):
    model, asked = _served(spark, sf), _asked(spark, sf)
    clauses = rec.must_similar(asked, _similar(asked, model))
    return matching.matches_all(clauses, matching.postings(model))


@register
def q_must_fields(spark, sf):
    shared = [Field("categories", ("SMALL", "LARGE", "ECONOMY"), -1.0), Field("brand", (), -1.0)]
    clauses = cl.field_clauses(cl.filter_fields(_asked(spark, sf), shared))
    return matching.matches_shared(clauses, matching.postings(_item_documents(spark, sf)))


@register
def q_date_range(spark, sf):
    ranges = _asked(spark, sf).select("query_id", "date_range")
    return matching.must_date_range(ranges, matching.item_dates(_item_documents(spark, sf)))


@register
def q_available(spark, sf):
    moments = _asked(spark, sf).where("date_range is null").select("query_id", "current_date")
    return matching.must_available(
        moments, _item_documents(spark, sf), "availableDate", "expireDate"
    )


@register
def q_exclusions(spark, sf):
    return ranking.exclusions(_asked(spark, sf), t.event_log(spark, sf), ["purchase", "signup"], "purchase")


@register
def q_exclude_self(spark, sf):
    return ranking.exclude_self(_asked(spark, sf))


@register
def q_backfill(spark, sf):
    """The first items by rank for every query, past what its user has bought."""
    asked, log = _asked(spark, sf), t.event_log(spark, sf)
    cfg = t.engine()
    places = rec.number_items(_served(spark, sf, recs_model=RecsModel.BACKFILL), cfg)
    needs = asked.select("query_id", F.lit("").alias("sig"), F.col("num").cast("bigint").alias("need"))
    taken = ranking.exclusions(asked, log, (), "purchase").withColumn("sig", F.lit(""))
    ordered = freeze(
        places.select(F.lit("").alias("sig"), F.col("id").alias("item"), F.col("gpos").alias("spos"))
    )
    return ranking.backfill_candidates(needs, taken, ordered).select("query_id", "item")


@register
def q_topn(spark, sf):
    """The best items per user by how often the user met them, ties by price."""
    met = t.event_log(spark, sf).select(
        F.col("entity_id").alias("query_id"), F.col("target_entity_id").alias("item")
    )
    counted = met.groupBy("query_id", "item").agg(F.count("*").cast("double").alias("score"))
    priced = counted.join(t.items(spark, sf).select("item", "price"), "item")
    order = ranking.rank_order(["price"], priced.columns)
    return ranking.top_n(priced, order, 10).withColumn("position", F.col("position").cast("bigint"))


@register
def q_results_with_ranks(spark, sf):
    met = t.event_log(spark, sf).select(
        F.col("entity_id").alias("query_id"), F.col("target_entity_id").alias("item")
    )
    counted = met.groupBy("query_id", "item").agg(F.count("*").cast("double").alias("score"))
    top = ranking.top_n(counted, [F.asc("item")], 5)
    top = top.join(_asked(spark, sf).select("query_id", "with_ranks"), "query_id")
    model = _served(spark, sf, recs_model=RecsModel.BACKFILL)
    shown = ranking.with_ranks(top, model, ["popRank", "userRank"])
    return shown.withColumn("position", F.col("position").cast("bigint"))


@register
def q_serve_first(spark, sf):
    """Answers from purchases where a user has any, else from views, else from clicks."""
    actions = _e_actions(spark, sf)

    def answers(event: str) -> DataFrame:
        counted = actions.where(F.col("event") == event).groupBy(
            F.col("user").alias("query_id"), "item"
        ).agg(F.count("*").cast("double").alias("score"))
        return ranking.top_n(counted, [F.asc("item")], 3)

    served = ranking.serve_first([answers(e) for e in t.E_EVENTS])
    return served.withColumn("position", F.col("position").cast("bigint"))


def _recommend(spark, sf, **changes) -> DataFrame:
    cfg, model = t.engine(**changes), _served(spark, sf, **changes)
    results = rec.recommend(_queries(spark, sf), t.event_log(spark, sf), model, cfg, t.CURRENT_DATE)
    return results.withColumn("position", F.col("position").cast("bigint"))


@register
def recommend(spark, sf):
    return _recommend(spark, sf)


@register
def recommend_open(spark, sf):
    """No availability test: most queries have no filter and may be backfilled."""
    return _recommend(
        spark, sf, available_date_name=None, expire_date_name=None, date_name="availableDate",
        blacklist_events=("purchase", "view"),
    )


@register
def recommend_shared_fields(spark, sf):
    """Engine-wide fields: one boosts, one filters, every query alike."""
    return _recommend(
        spark, sf, clause_score="any",
        fields=(Field("categories", ("SMALL", "Brand#3"), 3.0),
                Field("categories", ("SMALL", "LARGE", "ECONOMY"), -1.0)),
    )


# --- streaming ----------------------------------------------------------------


def _event_stream(spark, sf) -> DataFrame:
    raw = (
        spark.readStream.schema(t.table(spark, sf, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
    )
    return t.as_event_log(raw)


@register
def stream_dedup(spark, sf):
    out = fresh_path(spark, "dedup")
    unique = st.stream_dedup(_event_stream(spark, sf), "40 days").select(
        "event_id", "event", F.col("entity_id").alias("user")
    )
    query = (
        unique.writeStream.format("parquet").option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/data")


@register
def stream_popular(spark, sf):
    out = fresh_path(spark, "popular")
    windows = st.stream_popular(_event_stream(spark, sf), "1 day", "40 days")
    st.append_updates(windows, f"{out}/data", f"{out}/state").awaitTermination()
    latest = st.latest_updates(spark, f"{out}/data", ["window", "item"], "rank")
    return latest.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "item", "rank")


@register
def stream_publish(spark, sf):
    out = fresh_path(spark, "publish")
    windows = st.stream_popular(_event_stream(spark, sf), "7 days", "40 days")
    st.stream_publish(windows, out, "ranks", f"{out}/state").awaitTermination()
    model = store.read_model(spark, out, "ranks")
    return model.select(F.col("window_start").cast("timestamp_ntz").alias("week"), "item", "rank")
