"""The same results in plain SQL over the given tables.

Written from the definitions, not from the Spark plans: queries meet items in a
cross product, log-likelihood in its entropy form, positions by one global sort.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

E_NAMES = "('purchase', 'view', 'click')"
MONTH = ("timestamp '2024-01-01'", "timestamp '2024-01-31'")


def oracle(fn):
    ORACLES[fn.__name__] = fn()
    return fn


def statement(ctes: list[str], select: str) -> str:
    return f"with {', '.join(ctes)} {select}" if ctes else select


# --- tables as event logs, metadata and queries --------------------------------

EV = """ev as (
    select cast(event_id as varchar) event_id, event_type event, cast(user_id as varchar) u,
           json_extract_string(props, '$.k') item, ts
    from events)"""

ACT = f"act as (select event, u, item, ts, event_id from ev where event in {E_NAMES})"

ORD = """ord as (
    select case l_returnflag when 'N' then 'buy' when 'A' then 'view' else 'cart' end event,
           cast(o_custkey as varchar) u, cast(l_partkey as varchar) item, o_orderdate ts
    from lineitem join orders on l_orderkey = o_orderkey)"""

ITEM = """item_meta as (
    select cast(p_partkey as varchar) item, p_brand brand, p_type "type",
           cast(p_size as double) userRank, p_retailprice price,
           cast(date '1995-01-01' + cast(p_partkey % 2000 as int) as timestamp) availableDate,
           cast(date '1995-01-01' + cast(p_partkey % 2000 as int) + p_size * 30 as timestamp) expireDate
    from part)"""

PROP = """prop as (
    select item, 'brand' as key, brand as value from item_meta
    union all select item, 'categories', '["' || brand || '","' || "type" || '"]' from item_meta
    union all select item, 'userRank', cast(userRank as varchar) from item_meta
    union all select item, 'availableDate', strftime(availableDate, '%Y-%m-%d') from item_meta
    union all select item, 'expireDate', strftime(expireDate, '%Y-%m-%d') from item_meta)"""

PLOG = """plog as (
    select cast(event_id as varchar) event_id,
           case when event_type = 'error' then '$unset' else '$set' end event,
           json_extract_string(props, '$.k') item, 'p' || cast(event_id % 4 as varchar) key,
           cast(value as varchar) value, ts
    from events)"""

FULL = """logged as (
        select event_id, event, 'user' entity_type, u entity_id, item target_entity_id, ts event_time,
               cast(null as varchar) properties, ts creation_time, null as key, null as value
        from ev
        union all
        select 'p' || event_id, event, 'item', item, null, ts, '{"' || key || '":"' || value || '"}',
               ts, key, value
        from plog),
    full_log as (
        select * from logged
        union all select 'x' || event_id, event, entity_type, entity_id, target_entity_id, event_time,
                         properties, creation_time + interval 1 hour, key, value from logged)"""

BIN_E = "bin as (select distinct event, u, item from act where u <> '' and item <> '')"
BIN_O = "bin as (select distinct event, u, item from ord)"

EVENT_OUT = "event_id, event, entity_type, entity_id, target_entity_id, event_time"

LAST_PROPS = """last_props as (
    select item, key, value from (
        select *, row_number() over (partition by item, key order by ts desc, event_id desc) n from plog)
    where n = 1 and event = '$set' and value is not null)"""


# --- sources --------------------------------------------------------------------


@oracle
def scan_events():
    return statement([EV], """select event_id, event, u as "user", item, ts from ev
        where event in ('purchase', 'view') and ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-25'""")


@oracle
def two_apps():
    return statement([EV, ACT], """select event, item, count(*) n, count(distinct u) users from act
        where cast(u as bigint) % 3 <> 0 and u <> '' and item <> '' group by event, item""")


@oracle
def split_actions():
    return statement([EV, ACT], """select event, u as "user", item, ts from act where u <> '' and item <> ''""")


@oracle
def interval_events():
    return statement([EV, ACT], """select event, u as "user", item, ts from act
        where event = 'view' and ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20'""")


@oracle
def recent_events():
    return statement([EV, ACT], """select u as "user", event, event_id, recency from (
        select *, row_number() over (partition by u, event order by ts desc, event_id desc) recency from act)
        where recency <= 5""")


ASKED = """asked as (
    select cast(uid as varchar) query_id, uid,
        case when uid % 11 = 0 then -1.0 when uid % 4 = 0 then 2.0 end user_bias0,
        cast(uid % 100 as varchar) self,
        case when uid % 13 = 0 then -1.0 when uid % 6 = 0 then 0.5 end item_bias0,
        case when uid % 3 = 0 then 'Brand#' || cast(uid % 25 + 1 as varchar) end brand_only,
        case when uid % 3 <> 0 and uid % 4 = 1 then 'Brand#' || cast(uid % 10 + 1 as varchar) end brand_boost,
        case when uid % 2 = 0 then timestamp '1997-06-01' end current_date0,
        case when uid % 5 = 0 then cast(date '1995-01-01' + cast(uid % 1500 + 200 as int) as timestamp) end before,
        case when uid % 5 = 0 and uid % 2 = 0
             then cast(date '1995-01-01' + cast(uid % 1500 as int) as timestamp) end after,
        case when uid % 8 = 0 then cast((uid + 1) % 100 as varchar) end black1,
        case when uid % 8 = 0 then cast((uid + 2) % 100 as varchar) end black2,
        uid % 7 = 0 return_self,
        case when uid % 9 = 0 then 15 end num0,
        uid % 10 = 0 views_only,
        uid % 2 = 0 with_ranks
    from (select distinct user_id uid from events)),
q as (select *, cast(coalesce(user_bias0, 1.0) as double) user_bias,
             cast(coalesce(item_bias0, 1.0) as double) item_bias, coalesce(num0, 10) num,
             coalesce(current_date0, timestamp '1997-01-01') now_at from asked)"""


@oracle
def read_queries():
    return statement([ASKED], """select query_id, query_id as "user", cast(user_bias0 as double) user_bias, self item,
        cast(item_bias0 as double) item_bias,
        case when brand_only is not null then 'brand/' || brand_only || '/-1.0'
             when brand_boost is not null then 'categories/' || brand_boost || '+SMALL/1.5' end fields,
        current_date0 "current_date", case when before is not null then 'availableDate' end range_name,
        before, after, black1 || ',' || black2 blacklist_items,
        case when return_self then true end return_self, cast(num0 as double) num,
        case when views_only then 'view' end event_names, with_ranks, cast(null as varchar) error
        from asked""")


@oracle
def publish_read_roundtrip():
    return statement([ITEM], """select item id, brand, "type", price, brand || ',' || "type" categories, availableDate
        from item_meta""")


@oracle
def lookup_items():
    return statement([EV, ITEM], """select item id, brand, "type", price from item_meta
        where item in (select item from ev)""")


@oracle
def bundle_roundtrip():
    return statement([EV, ACT, ITEM], """select event, user_idx, item_idx, rank, brand from act
        join (select u, row_number() over (order by md5(u), u) - 1 user_idx from (select distinct u from act)) using (u)
        join (select item, row_number() over (order by md5(item), item) - 1 item_idx
              from (select distinct item from act)) using (item)
        join (select item, cast(count(*) as double) rank from act group by item) using (item)
        join item_meta using (item)""")


@oracle
def model_fields():
    return statement([ITEM, PROP, PLOG, LAST_PROPS], """select key,
        case when bool_or(value like '[%') then 'array<' || kind || '>' else kind end "type"
        from (select key, value, case when key in ('availableDate', 'expireDate') then 'timestamp_ntz'
                                      when key in ('userRank', 'popRank') then 'double' else 'string' end kind
              from (select key, value from prop union all select key, value from last_props))
        group by key, kind""")


# --- cleaning -------------------------------------------------------------------

WINDOWED = """windowed as (select * from full_log
    where event_time > timestamp '2024-01-21' or event in ('$set', '$unset'))"""


def deduped(source: str) -> str:
    return f"""deduped as (select * from (select *, row_number() over (
        partition by event, entity_type, entity_id, target_entity_id, event_time, properties
        order by creation_time, event_id) copy_no from {source}) where copy_no = 1)"""


def compressed(source: str) -> str:
    return f"""changes as (
        select *, row_number() over (partition by entity_id, key order by event_time desc, event_id desc) n
        from {source} where event in ('$set', '$unset')),
    final_props as (
        select entity_id, '{{' || string_agg('"' || key || '":"' || value || '"', ',' order by key) || '}}' properties
        from changes where n = 1 and event = '$set' and value is not null group by entity_id),
    last_change as (
        select entity_id, event_id, event_time from (
            select *, row_number() over (partition by entity_id order by event_time desc, event_id desc) m
            from {source} where event in ('$set', '$unset')) where m = 1),
    squeezed as (
        select {EVENT_OUT}, properties from {source} where event not in ('$set', '$unset')
        union all
        select event_id, '$set', 'item', entity_id, null, event_time, coalesce(properties, '{{}}')
        from last_change left join final_props using (entity_id))"""


@oracle
def clean_window():
    return statement([EV, PLOG, FULL, WINDOWED], f"select {EVENT_OUT} from windowed")


@oracle
def dedup_events():
    return statement([EV, PLOG, FULL, deduped("full_log")],
                     f"select {EVENT_OUT}, properties, creation_time from deduped")


@oracle
def compress_props():
    return statement([EV, PLOG, FULL, compressed("full_log")], f"select {EVENT_OUT}, properties from squeezed")


@oracle
def remove_events():
    return statement([EV, PLOG, FULL], f"select {EVENT_OUT} from full_log where event <> 'error'")


CLEANED = [EV, PLOG, FULL, WINDOWED, deduped("windowed"), compressed("deduped")]


@oracle
def clean_all():
    return statement(CLEANED, f"select {EVENT_OUT}, properties from squeezed")


@oracle
def clean_removed():
    return statement(CLEANED, """select event_id from full_log
        where event_id not in (select event_id from squeezed)""")


# --- properties -----------------------------------------------------------------


@oracle
def aggregate_props():
    return statement([PLOG, LAST_PROPS], "select item, key, value from last_props")


@oracle
def props_to_map():
    return statement([PLOG, LAST_PROPS], """select item, string_agg(key || '=' || value, ';' order by key) props
        from last_props group by item""")


@oracle
def combine_maps():
    return statement([PLOG, LAST_PROPS, ITEM, PROP], """select item, key, value from (
        select *, row_number() over (partition by item, key order by prio desc) n from (
            select item, key, value, 0 prio from prop
            union all select item, key, value, 1 from last_props
            union all select item, 'brand', value, 2 from last_props where key = 'p1'))
        where n = 1""")


@oracle
def combine_collections():
    return statement([EV, ACT], """select u as "user", string_agg(word, ',' order by word) words from (
        select u, item word from act union all select u, event from act) group by u""")


@oracle
def union_all():
    return statement([EV, ACT, ITEM], """select u as "user", item, null as brand, null as event from act
        union all select null, item, brand, null from item_meta
        union all select null, item, null, event from act""")


@oracle
def merge_fields_ranks():
    return statement([EV, ACT, ITEM], f"""select coalesce(i.item, r.item) item, brand, coalesce(r.n, i.price) price,
        r.n * 2 popRank
        from item_meta i full outer join (
            select item, cast(count(*) as double) n from act
            where event = 'view' and ts >= {MONTH[0]} and ts < {MONTH[1]} group by item) r on i.item = r.item""")


@oracle
def extract_typed():
    return statement([ITEM], """select item, brand, brand || ',' || "type" categories, userRank, availableDate, expireDate
        from item_meta""")


# --- interaction preparation ------------------------------------------------------


@oracle
def binarize():
    return statement([EV, ACT, BIN_E], """select event, u as "user", item from bin""")


@oracle
def primary_users():
    return statement([ORD, BIN_O], """select event, u as "user", item from bin
        semi join (select distinct o_custkey::varchar u from lineitem join orders on l_orderkey = o_orderkey
            where l_returnflag = 'N') buyers using (u)""")


def numbered(source: str, column: str) -> str:
    return f"""(select id, row_number() over (order by md5(id), id) - 1 idx
        from (select distinct {column} id from {source}))"""


@oracle
def id_dictionary():
    return statement([ORD], f"select id, idx from {numbered('ord', 'u')}")


@oracle
def dictionary_merge():
    return statement([EV, ACT, ORD, f"old as {numbered('act', 'item')}"], """
        select id, idx from old
        union all
        select id, row_number() over (order by md5(id), id) - 1 + (select max(idx) + 1 from old)
        from (select distinct item id from ord where item not in (select id from old))""")


@oracle
def encode_decode():
    return statement([EV, ACT, ORD, BIN_O], """select event, count(*) n, case when known then item else 'unknown' end item
        from (select event, item, item in (select item from act) known from bin)
        group by event, case when known then item else 'unknown' end""")


@oracle
def dictionary_take():
    return statement([ORD], f"select id, idx from {numbered('ord', 'item')} where idx < 25")


@oracle
def interaction_counts():
    return statement([ORD, BIN_O], "select event, item, count(*) n_users from bin group by event, item")


def capped(source: str, seed: int, cap: str, columns: str = "event, u", tie: str = "item", name: str = "cap") -> str:
    return f"""{name} as (select event, u, item from (
        select *, row_number() over (partition by {columns} order by md5('{seed}|' || u || '|' || item), {tie}) nth
        from {source}) where nth <= {cap})"""


@oracle
def downsample():
    return statement([ORD, BIN_O, capped("bin", 7, "case event when 'buy' then 8 else 5 end")],
                     """select event, u as "user", item from cap""")


@oracle
def downsample_items():
    return statement(
        [EV, ACT, BIN_E, capped("bin", 7, "10"), capped("cap", 7, "6", "event, item", "u", "cap2")],
        """select event, u as "user", item from cap2""")


@oracle
def min_events_per_user():
    return statement([ORD, BIN_O], """select event, u as "user", item from bin
        where u in (select u from bin group by u having count(*) >= 30)""")


# --- similarity -------------------------------------------------------------------


def h(x: str) -> str:
    return f"(case when {x} > 0 then ({x}) * ln({x}) else 0.0 end)"


LLR = "round(greatest(0.0, 2 * ({} - ({}))), 6)".format(
    " + ".join(h(x) for x in ("k11", "cb - k11", "ca - k11", "n - ca - cb + k11")),
    " + ".join(h(x) for x in ("ca", "n - ca", "cb", "n - cb")) + " - " + h("n"),
)


def correlated(primary: str, specs: dict[str, tuple[int, str]]) -> list[str]:
    """CTEs up to ``corr`` from ``bin``; specs are name: (k, threshold test)."""
    ks = " ".join(f"when '{e}' then {s[0]}" for e, s in specs.items())
    tests = " ".join(f"when '{e}' then llr {s[1]}" for e, s in specs.items())
    names = ", ".join(f"'{e}'" for e in specs)
    return [
        f"buyers as (select distinct u from bin where event = '{primary}')",
        f"res as (select * from bin where u in (select u from buyers) and event in ({names}))",
        "cnt as (select event, item, cast(count(*) as double) c from res group by event, item)",
        f"""prs as (select b.event action, a.item, b.item correlator, cast(count(*) as double) k11
            from res a join res b on a.u = b.u
            where a.event = '{primary}' and not (b.event = '{primary}' and a.item = b.item)
            group by b.event, a.item, b.item)""",
        f"""sc as (select action, item, correlator, k11, ca, cb, {LLR} llr from (
            select p.*, x.c ca, y.c cb, (select cast(count(*) as double) from buyers) n from prs p
            join cnt x on x.event = '{primary}' and x.item = p.item
            join cnt y on y.event = p.action and y.item = p.correlator))""",
        f"""corr as (select action, item, correlator, llr, rank from (
            select *, row_number() over (partition by action, item order by llr desc, correlator) rank
            from sc where case action {tests} end)
            where rank <= case action {ks} end)""",
    ]


E_SPECS = {"purchase": (10, "> 0"), "view": (8, ">= 1.5"), "click": (5, "> 0")}
CORR_E = [EV, ACT, BIN_E, *correlated("purchase", E_SPECS)]
PLAIN_SPECS = {"purchase": (10, "> 0"), "view": (10, "> 0")}
PLAIN_E = [EV, ACT, BIN_E, *correlated("purchase", PLAIN_SPECS)]


@oracle
def cooccurrence():
    return statement([EV, ACT, BIN_E], """select a.item, b.item correlator, count(*) k11 from bin a join bin b on a.u = b.u
        where a.event = 'purchase' and b.event = 'purchase' and a.item <> b.item group by a.item, b.item""")


ORACLES["cooccurrence_tiled"] = ORACLES["cooccurrence"]


@oracle
def cross_occurrence():
    return statement([EV, ACT, BIN_E], """select a.item, b.item correlator, count(*) k11 from bin a join bin b on a.u = b.u
        where a.event = 'purchase' and b.event = 'view' group by a.item, b.item""")


SCORED = """select item, correlator, cast(k11 as bigint) k11, cast(ca as bigint) ca, cast(cb as bigint) cb, llr
    from sc where action = 'view'"""


@oracle
def llr_scores():
    return statement(PLAIN_E, SCORED)


@oracle
def min_llr():
    return statement(PLAIN_E, SCORED + " and llr >= 2.0")


@oracle
def cross_llr_topk():
    return statement(PLAIN_E, "select item, correlator, llr, rank from corr where action = 'view'")


@oracle
def cross_llr_topk_orders():
    specs = {event: (10, "> 0") for event in ("buy", "view", "cart")}
    return statement([ORD, BIN_O, *correlated("buy", specs)], "select action, item, correlator, llr, rank from corr")


@oracle
def indicators_all():
    return statement(CORR_E, "select action, item, correlator, llr, rank from corr")


LISTS = """lists as (select item,
    string_agg(correlator, ',' order by rank) filter (where action = 'purchase') purchase,
    string_agg(correlator, ',' order by rank) filter (where action = 'view') "view",
    string_agg(correlator, ',' order by rank) filter (where action = 'click') click
    from corr group by item)"""


@oracle
def correlator_lists():
    return statement([*CORR_E, LISTS], """select item, purchase, "view", click from lists""")


# --- rankings ---------------------------------------------------------------------


def piece(names: str, lo: str, hi: str) -> str:
    return f"""cast(count(*) filter (where event in ({names}) and ts >= timestamp '{lo}' and ts < timestamp '{hi}')
        as double)"""


RANKED = f"""counted as (select item,
        {piece("'purchase'", "2024-01-01", "2024-01-31")} pop,
        {piece("'view', 'click'", "2024-01-01", "2024-01-16")} t1,
        {piece("'view', 'click'", "2024-01-16", "2024-01-31")} t2,
        {piece("'view'", "2024-01-01", "2024-01-11")} h1,
        {piece("'view'", "2024-01-11", "2024-01-21")} h2,
        {piece("'view'", "2024-01-21", "2024-01-31")} h3,
        count(*) filter (where ts >= {MONTH[0]} and ts < {MONTH[1]}) seen
    from ev where item <> '' group by item)"""

UNIQUE = "cast(('0x' || substr(md5('{seed}|' || item), 1, 8)) as bigint) / 4294967296.0"

RANKS = f"""ranks as (select item,
        case when h1 > 0 and h2 > 0 and h3 > 0 then (h3 - h2) - (h2 - h1) end hotRank,
        case when pop > 0 then pop end popRank,
        {UNIQUE.format(seed=1)} uniqueRank,
        case when t1 > 0 and t2 > 0 then t2 - t1 end trendRank,
        userRank
    from (select item from item_meta union select item from counted where seen > 0)
    left join counted using (item) left join item_meta using (item))"""


@oracle
def rank_popular():
    return statement([EV, RANKED], "select item, pop rank from counted where pop > 0")


@oracle
def rank_trending():
    return statement([EV, RANKED], "select item, t2 - t1 rank from counted where t1 > 0 and t2 > 0")


@oracle
def rank_hot():
    return statement([EV, RANKED], """select item, (h3 - h2) - (h2 - h1) rank from counted
        where h1 > 0 and h2 > 0 and h3 > 0""")


@oracle
def rank_random():
    return statement([EV, ACT, ITEM], f"""select item, {UNIQUE.format(seed=3)} rank from (
        select item from item_meta union
        select item from act where ts >= {MONTH[0]} and ts < {MONTH[1]})""")


@oracle
def rank_user_defined():
    return statement([ITEM], "select item, userRank rank from item_meta")


@oracle
def ranks_combined():
    return statement([EV, ITEM, RANKED, RANKS], "select item, hotRank, popRank, uniqueRank, trendRank, userRank from ranks")


# --- training ---------------------------------------------------------------------

MODEL = [*CORR_E, LISTS, ITEM, RANKED, RANKS, """model as (
    select r.item id, purchase, "view", click, availableDate, brand, brand || ',' || "type" categories, expireDate,
           r.userRank, hotRank, popRank, uniqueRank, trendRank, "type"
    from ranks r left join item_meta m on m.item = r.item left join lists l on l.item = r.item)"""]

MODEL_OUT = """select id, purchase, "view", click, availableDate, brand, categories, expireDate, userRank,
    hotRank, popRank, uniqueRank, trendRank from model"""


@oracle
def train_all():
    return statement(MODEL, MODEL_OUT)


@oracle
def train_cf():
    return statement([*CORR_E, LISTS], """select item id, purchase, "view", click from lists""")


@oracle
def train_backfill():
    return statement(
        MODEL,
        MODEL_OUT.replace(", brand,", ", coalesce(brand, 'old') brand,").replace("popRank,", "coalesce(popRank, -1.0) popRank,"))


@oracle
def sanity_check():
    return statement([EV, ACT], "select event, count(distinct u) users, count(*) actions from act group by event")


# --- recommendation queries ---------------------------------------------------------

HIST = """hist as (
    select query_id, event, item, pos, case when user_bias > 0 and user_bias <> 1 then user_bias end boost,
           user_bias < 0 closing
    from q join (
        select u, event, item, row_number() over (partition by u, event order by ts desc, event_id desc) pos from (
            select *, row_number() over (partition by u, event, item order by ts desc, event_id desc) n from act)
        where n = 1) on u = query_id
    where event = 'view' or not views_only)"""

SIM = """sim as (
    select query_id, action event, correlator item, rank pos,
           case when item_bias > 0 and item_bias <> 1 then item_bias end boost, item_bias < 0 closing
    from q join corr on corr.item = self)"""

TERMS = """terms as (
    select action field, correlator as value, item from corr
    union all select 'brand', brand, item from item_meta
    union all select 'categories', brand, item from item_meta
    union all select 'categories', "type", item from item_meta)"""

WANTS = """wants as (
    select query_id, 'history:' || event clause, event field, item as value, coalesce(boost, 1.0) weight, closing from hist
    union all
    select query_id, 'similar:' || event, event, item, coalesce(boost, 1.0), closing from sim
    union all
    select query_id, 'fields', 'categories', unnest([brand_boost, 'SMALL']), 1.5, false from q
    where brand_boost is not null)"""

ASK = [*MODEL, ASKED, HIST, SIM, TERMS, WANTS]


def met_all(kind: str) -> str:
    return f"""select query_id, item from (
            select query_id, item, count(distinct clause) met
            from wants join terms using (field, value) where closing and {kind} group by query_id, item)
        join (select query_id, count(distinct clause) wanted from wants where closing and {kind} group by query_id)
        using (query_id) where met = wanted"""


@oracle
def q_rejects():
    return statement([EV, ASKED], """select query_id, 'not a query' as error, 1 as rows from asked where uid % 3 = 0
        union all
        select query_id, 'different queries with one id', 2 from asked where uid % 3 = 1 and return_self""")


@oracle
def q_history_capped():
    return statement([EV, ACT, ASKED, HIST], "select query_id, event, item, pos, boost from hist where pos <= 3")


@oracle
def q_history():
    return statement([EV, ACT, ASKED, HIST], "select query_id, event, item, pos, boost from hist")


@oracle
def q_similar():
    return statement([*CORR_E, ASKED, SIM], "select query_id, event, item, pos, boost from sim")


@oracle
def q_boost_fields():
    return statement([ASKED], """select query_id, 'categories' as name, brand_boost || '+SMALL' as "values",
        cast(1.5 as double) bias from q where brand_boost is not null
        union all select query_id, 'categories', 'LARGE', cast(2.0 as double) from q""")


@oracle
def q_score():
    return statement(ASK, """select query_id, item, round(sum(cast(weight as double)), 6) score
        from wants join terms using (field, value) where not closing group by query_id, item""")


@oracle
def q_score_any():
    return statement(ASK, """select query_id, item, round(sum(weight), 6) score from (
        select query_id, item, clause, max(cast(weight as double)) weight
        from wants join terms using (field, value) where not closing group by query_id, item, clause)
        group by query_id, item""")


@oracle
def q_must_history():
    return statement(ASK, met_all("clause like 'history:%'"))


@oracle
def q_must_similar():
    return statement(ASK, met_all("clause like 'similar:%'"))


@oracle
def q_must_fields():
    return statement([ASKED, ITEM], """select query_id, item from q, item_meta
        where (brand_only is null or brand = brand_only) and "type" in ('SMALL', 'LARGE', 'ECONOMY')""")


@oracle
def q_date_range():
    return statement([ASKED, ITEM], """select query_id, item from q, item_meta
        where before is not null and availableDate < before and (after is null or availableDate > after)""")


@oracle
def q_available():
    return statement([ASKED, ITEM], """select query_id, item from q, item_meta
        where before is null and availableDate < now_at and now_at < expireDate""")


def excluded(blacklist: str) -> str:
    return f"""gone as (
        select query_id, item from q join ev on u = query_id where event in ({blacklist})
        union select query_id, black1 from q where black1 is not null
        union select query_id, black2 from q where black2 is not null
        union select query_id, self from q where not return_self)"""


@oracle
def q_exclusions():
    return statement([EV, ASKED, excluded("'purchase', 'signup'")], "select query_id, item from gone")


@oracle
def q_exclude_self():
    return statement([ASKED], "select query_id, self item from q where not return_self")


BY_RANK = """hotRank desc nulls last, popRank desc nulls last, uniqueRank desc nulls last,
    trendRank desc nulls last, userRank desc nulls last, id"""


@oracle
def q_backfill():
    return statement([EV, ACT, ITEM, RANKED, RANKS, ASKED, excluded("'purchase'")], f"""
        select query_id, id item from (
            select query_id, id, num, row_number() over (partition by query_id order by {BY_RANK}) n
            from q, (select item id, * from ranks)
            where not exists (select 1 from gone g where g.query_id = q.query_id and g.item = id))
        where n <= num""")


@oracle
def q_topn():
    return statement([EV, ITEM], """select item, query_id, score, price, position from (
        select *, row_number() over (partition by query_id order by score desc, price desc nulls last, item) position
        from (select u query_id, item, cast(count(*) as double) score from ev group by u, item) join item_meta using (item))
        where position <= 10""")


@oracle
def q_results_with_ranks():
    return statement([EV, ITEM, RANKED, RANKS, ASKED], """select query_id, position, item, score,
        case when with_ranks then popRank end popRank, case when with_ranks then userRank end userRank
        from (select *, row_number() over (partition by query_id order by score desc, item) position
              from (select u query_id, item, cast(count(*) as double) score from ev group by u, item))
        join q using (query_id) left join ranks using (item) where position <= 5""")


@oracle
def q_serve_first():
    return statement([EV, ACT], """select query_id, item, score, position from (
        select *, min(algorithm) over (partition by query_id) first_algorithm from (
            select u query_id, item, cast(count(*) as double) score,
                   case event when 'purchase' then 0 when 'view' then 1 else 2 end algorithm,
                   row_number() over (partition by u, event order by count(*) desc, item) position
            from act group by u, event, item)
        where position <= 3) where algorithm = first_algorithm""")


def recommended(
    blacklist: str = "'purchase'", available: bool = True, count: bool = True,
    shared: str = "0.0", eligible: str = "true",
) -> str:
    life = "availableDate < now_at and now_at < expireDate" if available else "true"
    hits = (
        "select query_id, item, sum(cast(weight as double)) s from hit where not closing group by query_id, item"
        if count else
        """select query_id, item, sum(w) s from (
            select query_id, item, clause, max(cast(weight as double)) w from hit where not closing
            group by query_id, item, clause) group by query_id, item"""
    )
    return statement(
        [*ASK, excluded(blacklist),
         "hit as (select * from wants join terms using (field, value))",
         f"scored as ({hits})",
         f"closed as ({met_all('true')})"],
        f"""select query_id, position, item, score,
            case when with_ranks then hotRank end hotRank, case when with_ranks then popRank end popRank,
            case when with_ranks then uniqueRank end uniqueRank, case when with_ranks then trendRank end trendRank,
            case when with_ranks then userRank end userRank
        from (
            select *, row_number() over (partition by query_id order by score desc, {BY_RANK}) position from (
                select q.query_id, m.id, m.id item, num, with_ranks, hotRank, popRank, uniqueRank, trendRank, userRank,
                       round(coalesce(s, 0.0) + {shared}, 6) score
                from q cross join model m
                left join scored on scored.query_id = q.query_id and scored.item = m.id
                where (brand_only is null or brand = brand_only)
                  and case when before is not null
                           then availableDate < before and (after is null or availableDate > after)
                           else {life} end
                  and (q.query_id not in (select query_id from wants where closing)
                       or exists (select 1 from closed c where c.query_id = q.query_id and c.item = m.id))
                  and not exists (select 1 from gone g where g.query_id = q.query_id and g.item = m.id)
                  and {eligible}))
        where position <= num""")


ORACLES["recommend"] = recommended()
ORACLES["recommend_open"] = recommended("'purchase', 'view'", available=False)
ORACLES["recommend_shared_fields"] = recommended(
    count=False,
    shared="case when \"type\" = 'SMALL' or brand = 'Brand#3' then 3.0 else 0.0 end",
    eligible="\"type\" in ('SMALL', 'LARGE', 'ECONOMY')",
)


# --- streaming ------------------------------------------------------------------


@oracle
def stream_dedup():
    return statement([EV], """select event_id, event, u as "user" from ev""")


@oracle
def stream_popular():
    return statement([EV], """select date_trunc('day', ts) as day, item, cast(count(*) as double) rank from ev
        where item <> '' group by 1, 2""")


@oracle
def stream_publish():
    return statement([EV], """select timestamp '1970-01-01' + to_days(cast(7 * floor(epoch(ts) / 604800) as int)) as week, item,
        cast(count(*) as double) rank from ev where item <> '' group by 1, 2""")
