"""Recommendation against a direct evaluation of every (query, item) pair."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cooccur import EngineConfig, Field, Indicator, Ranking
from cooccur.operators import matching
from cooccur.operators.numbering import free_positions, number_rows, positions_within
from cooccur.operators.ranking import serve_first
from cooccur.plans.recommend import recommend
from cooccur.plans.train import assemble, sanity_check, train
from cooccur.sources.events import split_actions
from cooccur.sources.queries import read_queries

NOW = datetime(2024, 6, 1)
ITEMS = [f"i{n:03d}" for n in range(60)]
COLORS = ["red", "green", "blue"]


def make_model(rng):
    day = timedelta(days=1)
    return [
        (
            item,
            rng.sample(ITEMS, rng.randint(0, 6)) or None,
            rng.sample(ITEMS, rng.randint(0, 4)) or None,
            rng.choice(COLORS) if rng.random() < 0.9 else None,
            rng.sample(["s", "m", "l"], rng.randint(1, 2)),
            float(rng.randint(0, 5)) if rng.random() < 0.7 else None,
            NOW + day * rng.randint(-50, 20),
            NOW + day * rng.randint(-5, 400) if rng.random() < 0.9 else None,
        )
        for item in ITEMS
    ]


def make_events(rng):
    events = []
    for n in range(500):
        user = "u0" if n % 3 == 0 else f"u{rng.randint(1, 11)}"
        when = NOW - timedelta(minutes=rng.randint(1, 300))
        events.append((f"e{n:04d}", rng.choice(["buy", "view"]), "user", user, "item", rng.choice(ITEMS), when))
    return events


def make_queries(rng):
    queries = []
    for n in range(40):
        q = {"queryId": f"q{n:02d}"}
        if rng.random() < 0.8:
            q["user"] = f"u{rng.randint(0, 13)}"
        if rng.random() < 0.5:
            q["item"] = rng.choice([*ITEMS, "gone"])
        if rng.random() < 0.4:
            q["userBias"] = rng.choice([-1.0, 0.0, 2.0])
        if rng.random() < 0.4:
            q["itemBias"] = rng.choice([-1.0, 0.5])
        fields = []
        if rng.random() < 0.3:
            fields.append({"name": "color", "values": rng.sample(COLORS, rng.randint(0, 2)), "bias": -1.0})
        if rng.random() < 0.3:
            fields.append({"name": "sizes", "values": ["s", "m"], "bias": rng.choice([0.0, 1.5])})
        if fields:
            q["fields"] = fields
        if rng.random() < 0.25:
            after = NOW + timedelta(days=rng.randint(-60, 0))
            q["dateRange"] = {"name": "available", "after": after.isoformat()}
            if rng.random() < 0.5:
                q["dateRange"]["before"] = (after + timedelta(days=40)).isoformat()
        if rng.random() < 0.3:
            q["blacklistItems"] = rng.sample(ITEMS, 5)
        if rng.random() < 0.3:
            q["returnSelf"] = True
        if rng.random() < 0.5:
            q["num"] = rng.randint(1, 25)
        if rng.random() < 0.3:
            q["eventNames"] = ["view"]
        queries.append(q)
    return queries


def evaluate(cfg, model, events, q):
    """[(item, score)] of one query, straight from the definitions."""
    docs = {m[0]: dict(zip(("buy", "view", "color", "sizes", "popRank", "available", "expire"), m[1:], strict=True)) for m in model}

    def terms(doc, field):
        value = doc.get(field)
        return set() if value is None else {value} if isinstance(value, str) else set(value)

    def boost(bias):
        return bias if bias > 0 and bias != 1 else 1.0

    user_bias, item_bias = q.get("userBias", cfg.user_bias), q.get("itemBias", cfg.item_bias)
    mine = sorted((e for e in events if e[3] == q.get("user")), key=lambda e: (e[6], e[0]), reverse=True)
    should, must = [], []
    for name in q.get("eventNames", cfg.model_event_names):
        items = list(dict.fromkeys(e[5] for e in mine if e[1] == name))[:cfg.max_query_events]
        if items:
            (must if user_bias < 0 else should).append((name, items, boost(user_bias)))
    own = docs.get(q.get("item"))
    for name in cfg.model_event_names:
        if own and own[name]:
            (must if item_bias < 0 else should).append((name, own[name][:cfg.max_query_events], boost(item_bias)))
    fields = {(f["name"], tuple(f["values"]), f["bias"]) for f in q.get("fields", [])}
    fields |= {(f.name, f.values, f.bias) for f in cfg.fields}
    should += [(n, v, boost(b)) for n, v, b in fields if b >= 0]
    must += [(n, v, 0) for n, v, b in fields if b < 0 and v]
    gone = {e[5] for e in mine if e[1] in (cfg.blacklist_events or cfg.model_event_names[:1])}
    gone |= set(q.get("blacklistItems", []))
    if not q.get("returnSelf", cfg.return_self):
        gone.add(q.get("item"))
    scored = []
    for item, doc in docs.items():
        if item in gone or any(not terms(doc, n) & set(v) for n, v, _ in must):
            continue
        if "dateRange" in q:
            at, r = doc[q["dateRange"]["name"]], q["dateRange"]
            if "after" in r and not at > datetime.fromisoformat(r["after"]):
                continue
            if "before" in r and not at < datetime.fromisoformat(r["before"]):
                continue
        elif cfg.available_date_name:
            if doc["expire"] is None or not doc["available"] < NOW < doc["expire"]:
                continue
        hits = [(len(terms(doc, n) & set(v)), b) for n, v, b in should]
        total = sum((k if cfg.clause_score == "count" else min(k, 1)) * b for k, b in hits)
        rank = doc["popRank"]
        scored.append((-round(total, 6), -rank if rank is not None else float("inf"), item))
    return [(item, -s) for s, _, item in sorted(scored)[:q.get("num", cfg.num)]]


BASE = dict(app_name="a", index_name="i", type_name="t", event_names=("buy", "view"),
            rankings=(Ranking("popular"),), max_query_events=8)
CONFIGS = {
    "plain": {},
    "dates": dict(available_date_name="available", expire_date_name="expire"),
    "any": dict(clause_score="any", blacklist_events=("view",), user_bias=3.0),
    "shared": dict(fields=(Field("color", ("red", "blue"), 2.5), Field("sizes", ("s", "l"), -1.0))),
    "closing": dict(user_bias=-1.0, item_bias=-1.0, return_self=True),
}


@pytest.mark.parametrize("name, partitions", [(n, 4) for n in CONFIGS] + [("plain", 1), ("shared", 7)])
def test_equals_direct_evaluation(spark, monkeypatch, name, partitions):
    if name == "dates":  # many small slices of the catalog
        monkeypatch.setattr("cooccur.plans.recommend.FIRST_SLICE", 4)
        monkeypatch.setattr("cooccur.plans.recommend.SLICE_GROWTH", 3)
    rng = random.Random(len(name))
    model, events, queries = make_model(rng), make_events(rng), make_queries(rng)
    cfg = EngineConfig(**{**BASE, **CONFIGS[name]})
    ntz = "timestamp_ntz"
    m = spark.createDataFrame(model, f"id string, buy array<string>, view array<string>, color string, "
                              f"sizes array<string>, popRank double, available {ntz}, expire {ntz}")
    e = spark.createDataFrame(events, "event_id string, event string, entity_type string, entity_id string, "
                              f"target_entity_type string, target_entity_id string, event_time {ntz}")
    q = read_queries(spark.createDataFrame([(json.dumps(x),) for x in queries], "value string"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = recommend(q, e, m, cfg, NOW).orderBy("query_id", "position").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    answers = {x["queryId"]: [] for x in queries}
    for r in got:
        answers[r.query_id].append((r.item, r.score))
        assert r.position == len(answers[r.query_id])
    for x in queries:
        assert answers[x["queryId"]] == evaluate(cfg, model, events, x), x


def test_numbering(spark):
    df = spark.range(5000).selectExpr("id % 7 as k", "id", "id % 3 as g")
    numbered = number_rows(df, [df.k.desc(), df.id.asc()], "pos").orderBy("pos").collect()
    assert [r.pos for r in numbered] == list(range(5000))
    assert [(r.k, r.id) for r in numbered] == sorted(((r.k, r.id) for r in numbered), key=lambda t: (-t[0], t[1]))
    inside = positions_within(df.select("g", "id"), "g", "id", "spos", block=64)
    for g in range(3):
        rows = inside.where(f"g = {g}").orderBy("id").collect()
        assert [r.spos for r in rows] == list(range(len(rows)))


@pytest.mark.parametrize("block", [4, 4096])
def test_free_positions(spark, block):
    rng = random.Random(block)
    taken = {q: sorted(rng.sample(range(60), rng.choice([0, 3, 30, 55]))) for q in range(20)}
    taken[99] = list(range(50))
    needs = {q: rng.randint(1, 12) for q in taken}
    got = free_positions(
        spark.createDataFrame(list(needs.items()), "query_id long, need long"),
        spark.createDataFrame([(q, p) for q, ps in taken.items() for p in ps], "query_id long, spos long"),
        block,
    ).collect()
    for q, n in needs.items():
        free = [p for p in range(200) if p not in taken[q]][:n]
        assert sorted(r.spos for r in got if r.query_id == q) == free


def test_training_modes(spark, micro):
    cfg = EngineConfig(**BASE)
    as_of = "2024-01-31"
    whole = {r.id: r for r in train(micro, cfg, as_of).collect()}
    # every buyer bought a, so nothing tells its company apart; b and c are each other's
    assert whole["a"].buy is None and whole["b"].buy == ["c"] and whole["c"].buy == ["b"]
    assert whole["a"].color == "blue" and whole["a"].tags == ["x", "y"] and whole["a"].popRank == 4.0
    assert whole["c"].popRank == 2.0 and whole["c"].color is None
    lists = train(micro, EngineConfig(**BASE, recs_model="collabFiltering"), as_of)
    assert set(lists.columns) == {"id", "buy", "view"}
    fresh = EngineConfig(**BASE, recs_model="backfill")
    assert {r.id for r in train(micro, fresh, as_of).collect()} == {"a", "b", "c"}
    current = spark.createDataFrame([("a", ["q"], "old"), ("z", ["a"], "old")], "id string, buy array<string>, color string")
    merged = {r.id: r for r in train(micro, fresh, as_of, current=current).collect()}
    assert merged["a"].buy == ["q"] and merged["a"].color == "blue" and merged["z"].color == "old"
    with pytest.raises(ValueError, match="backfill"):
        train(micro, EngineConfig(**BASE, recs_model="nope"))


def test_sanity(micro):
    actions = split_actions(micro, ["view"])
    with pytest.raises(ValueError, match="primary"):
        sanity_check(actions, None, "buy")
    with pytest.raises(ValueError, match="no actions"):
        sanity_check(actions.limit(0), None, "buy")


def test_assemble_prefers_later_parts(spark, rows):
    a = spark.createDataFrame([("x", "1", "p")], "id string, c string, d string")
    b = spark.createDataFrame([("x", "2"), ("y", "3")], "id string, c string")
    assert rows(assemble([a, b]), "id", "c", "d") == [("x", "2", "p"), ("y", "3", None)]


def test_serve_first(spark, rows):
    a = spark.createDataFrame([("q1", "i1")], "query_id string, item string")
    b = spark.createDataFrame([("q1", "i2"), ("q2", "i3")], "query_id string, item string")
    assert rows(serve_first([a, b]), "query_id", "item") == [("q1", "i1"), ("q2", "i3")]


def test_far_dates_match_without_months_in_between(spark):
    model = spark.createDataFrame(
        [("a", "1990-01-01", "9999-12-31"), ("b", "2024-01-01", "2024-02-01"), ("c", "2030-01-01", "9999-12-31"), ("d", None, "9999-12-31")],
        "id string, s string, e string",
    ).selectExpr("id", "cast(s as date) available", "cast(e as date) expire")
    moments = spark.createDataFrame([("q1", "2024-01-15"), ("q2", "2040-01-01")], "query_id string, m string").selectExpr(
        "query_id", "cast(m as timestamp_ntz) current_date")
    found = matching.must_available(moments, model, "available", "expire")
    assert {tuple(r) for r in found.collect()} == {("q1", "a"), ("q1", "b"), ("q2", "a"), ("q2", "c")}
    ranges = spark.createDataFrame([("r", "expire", None, "2024-01-15")], "query_id string, name string, before string, after string").selectExpr(
        "query_id", "struct(name, cast(before as timestamp_ntz) before, cast(after as timestamp_ntz) after) date_range")
    found = matching.must_date_range(ranges, matching.item_dates(model))
    assert {r["item"] for r in found.collect()} == {"a", "b", "c", "d"}


@pytest.fixture(scope="module")
def dated(spark):
    """Items with repeated dates, dates a second apart, missing dates, and empty lives."""
    return spark.range(2000).selectExpr(
        "cast(id as string) id",
        "if(id % 50 = 7, null, timestamp_ntz '2020-01-01' + make_dt_interval(cast(id % 300 as int), 0, 0, id % 3)) available",
        "if(id % 40 = 3, null, timestamp_ntz '2020-01-01' + make_dt_interval(cast((id % 300) + (id % 7) * 20 as int))) expire")


def test_moments_between_the_same_dates_are_one_filter(spark, dated):
    cfg = EngineConfig("s", "items", "item", indicators=(Indicator("buy"),), available_date_name="available", expire_date_name="expire")
    queries = spark.range(500).selectExpr(
        "concat('q', id) query_id", "cast(null as array<struct<name: string, values: array<string>, bias: double>>) fields",
        "timestamp_ntz '2020-03-01 06:00:00' + make_dt_interval(0, 0, 0, id) current_date",
        "cast(null as struct<name: string, before: timestamp_ntz, after: timestamp_ntz>) date_range")
    marked = matching.with_signature(queries, cfg, dated)
    filters = matching.signatures(marked)
    assert marked.count() == 500 and filters.count() == 1
    found = matching.signature_matches(filters, dated, matching.postings(dated), cfg)
    now = "timestamp_ntz '2020-03-01 06:00:00'"
    want = {r["id"] for r in dated.where(f"available < {now} and expire > {now}").collect()}
    assert {r["item"] for r in found.collect()} == want and found.count() == len(want) > 50


def test_date_filters_equal_a_plain_comparison(spark, dated):
    moments = spark.range(90).selectExpr("id query_id", "timestamp_ntz '2019-12-25' + make_dt_interval(cast(id * 5 as int), 0, 0, id % 2) current_date")
    got = sorted((r["query_id"], r["item"]) for r in matching.must_available(moments, dated, "available", "expire").collect())
    pairs = moments.join(dated, F.expr("available < current_date and current_date < expire"))
    assert got == sorted((r["query_id"], r["id"]) for r in pairs.select("query_id", "id").collect()) and got
    ranges = spark.range(80).selectExpr("id query_id", """named_struct('name', if(id % 9 = 0, 'absent', if(id % 2 = 0, 'available', 'expire')),
        'before', if(id % 5 = 0, null, timestamp_ntz '2020-01-20' + make_dt_interval(cast(id * 3 as int))),
        'after', if(id % 4 = 0, null, timestamp_ntz '2020-01-01' + make_dt_interval(cast(id * 2 as int)))) date_range""")
    found = matching.must_date_range(ranges, matching.item_dates(dated))
    at = "if(date_range.name = 'available', available, if(date_range.name = 'expire', expire, null))"
    pairs = ranges.join(dated, F.expr(
        f"{at} is not null and (date_range.after is null or {at} > date_range.after) and (date_range.before is null or {at} < date_range.before)"))
    want = sorted((r["query_id"], r["id"]) for r in pairs.select("query_id", "id").collect())
    assert sorted((r["query_id"], r["item"]) for r in found.collect()) == want and want


def test_ranges_and_moments_keep_apart_what_dates_keep_apart(spark, dated):
    """Signatures are equal if, and only if, their filters admit the same dates."""
    cfg = EngineConfig("s", "items", "item", indicators=(Indicator("buy"),), available_date_name="available", expire_date_name="expire")
    rows = [("a", "2020-02-01 00:00:00", None), ("b", "2020-02-01 00:00:01", None), ("c", "2020-02-01 12:00:00", None), ("d", "2020-02-01 13:00:00", None),
            ("e", None, ("expire", "2020-02-01 00:00:00")), ("f", None, ("expire", "2020-02-01 09:00:00")), ("g", None, ("expire", "2020-02-01 10:00:00"))]
    queries = spark.createDataFrame([(q, m, r) for q, m, r in rows], "query_id string, m string, r struct<name: string, after: string>").selectExpr(
        "query_id", "cast(null as array<struct<name: string, values: array<string>, bias: double>>) fields",
        "coalesce(cast(m as timestamp_ntz), timestamp_ntz '2020-05-05') current_date",
        """if(r is null, null, named_struct('name', r.name, 'before', cast(null as timestamp_ntz), 'after', cast(r.after as timestamp_ntz))) date_range""")
    marked = {r["query_id"]: r["sig"] for r in matching.with_signature(queries, cfg, dated).collect()}
    # An item becomes available a second after midnight.
    assert marked["a"] == marked["b"] and marked["c"] == marked["d"] and marked["e"] == marked["f"] == marked["g"]
    assert len(set(marked.values())) == 3
