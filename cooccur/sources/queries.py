"""Batches of recommendation queries (QUERIES), one JSON object per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cooccur.config import EngineConfig
from cooccur.functions.typed import instant

# The members of a query as they appear in JSON.
QUERY_JSON = (
    "queryId string, user string, userBias double, item string, itemBias double, "
    "fields array<struct<name: string, values: array<string>, bias: double>>, "
    "currentDate string, dateRange struct<name: string, before: string, after: string>, "
    "blacklistItems array<string>, returnSelf boolean, num int, eventNames array<string>, "
    "withRanks boolean, _bad string"
)

QUERY_SCHEMA = (
    "query_id string, user string, user_bias double, item string, item_bias double, "
    "fields array<struct<name: string, values: array<string>, bias: double>>, "
    "current_date timestamp_ntz, "
    "date_range struct<name: string, before: timestamp_ntz, after: timestamp_ntz>, "
    "blacklist_items array<string>, return_self boolean, num int, event_names array<string>, "
    "with_ranks boolean"
)


def read_queries(source: str | DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """QUERIES plus an ``error`` column, NULL for usable rows.

    ``source`` is a path of JSON lines or a frame with the text in ``value`` (and
    optionally a ``query_id``). A date range may lack one bound, not both.
    """
    text = spark.read.text(source) if isinstance(source, str) else source
    given = F.col("query_id") if "query_id" in text.columns else F.lit(None).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = text.select("value", given.alias("_given"), F.from_json("value", QUERY_JSON, options).alias("q"))
    q, dates = F.col("q"), F.col("q.dateRange")
    before, after = (instant(F.nullif(dates[b], F.lit(""))) for b in ("before", "after"))
    error = (
        F.when(q.isNull() | q["_bad"].isNotNull(), "not a query")
        .when(dates.isNotNull() & dates["name"].isNull(), "date range without a name")
        .when(dates.isNotNull() & before.isNull() & after.isNull(), "date range without a bound")
    )
    return parsed.select(
        F.coalesce("_given", q["queryId"], F.md5("value")).alias("query_id"),
        q["user"].alias("user"),
        q["userBias"].alias("user_bias"),
        q["item"].alias("item"),
        q["itemBias"].alias("item_bias"),
        q["fields"].alias("fields"),
        instant(q["currentDate"]).alias("current_date"),
        F.when(
            dates.isNotNull(),
            F.struct(dates["name"].alias("name"), before.alias("before"), after.alias("after")),
        ).alias("date_range"),
        q["blacklistItems"].alias("blacklist_items"),
        q["returnSelf"].alias("return_self"),
        q["num"].alias("num"),
        q["eventNames"].alias("event_names"),
        q["withRanks"].alias("with_ranks"),
        error.alias("error"),
    )


def _by_id(queries: DataFrame) -> DataFrame:
    """(query_id, _least, _most): the extremes of the usable rows of each id, NULL without any."""
    usable = F.col("error").isNull() if "error" in queries.columns else F.lit(True)
    row = F.when(usable, F.struct(*[c for c in queries.columns if c not in ("query_id", "error")]))
    return queries.groupBy("query_id").agg(F.min(row).alias("_least"), F.max(row).alias("_most"))


def rejected_queries(queries: DataFrame) -> DataFrame:
    """(query_id, error, rows) of the rows of QUERIES that get no answer.

    Unusable rows come with their own error, the usable ones of an id that has several
    different ones as ``"different queries with one id"``.
    """
    several = _by_id(queries).where("_least <> _most").select("query_id", F.lit(True).alias("_several"))
    ambiguous = F.when(F.col("_several"), F.lit("different queries with one id"))
    return (
        queries.select("query_id", "error")
        .join(several, "query_id", "left")
        .withColumn("error", F.coalesce("error", ambiguous))
        .groupBy("query_id", "error")
        .agg(F.count("*").alias("rows"))
        .where("error is not null")
    )


def resolve_queries(queries: DataFrame, cfg: EngineConfig, as_of=None) -> DataFrame:
    """Usable queries, one row per id, with engine defaults filled in.

    Rows of one id that are alike count once; an id with different usable rows is not
    answered. What is left out here is what :func:`rejected_queries` returns. Unusable
    rows are dropped after the grouping: a filter on parsed text would otherwise be moved
    down to the scan and parse every row once more.
    """
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    names = F.array(*[F.lit(n) for n in cfg.model_event_names])
    filled = {
        "user_bias": F.lit(cfg.user_bias),
        "item_bias": F.lit(cfg.item_bias),
        "num": F.lit(cfg.num),
        "return_self": F.lit(cfg.return_self),
        "with_ranks": F.lit(False),
        "current_date": now,
        "event_names": names,
    }
    once = _by_id(queries).where("_least = _most").select("query_id", "_most.*")
    return once.withColumns({c: F.coalesce(F.col(c), default) for c, default in filled.items()})
