"""The given parquet tables seen as event logs, item properties and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cooccur import EngineConfig, Indicator, Ranking

AS_OF = "2024-01-31 00:00:00"
CURRENT_DATE = "1997-01-01 00:00:00"

E_EVENTS = ("purchase", "view", "click")
O_EVENTS = ("buy", "view", "cart")
E_RANKINGS = (
    Ranking("popular", event_names=("purchase",), offset_date=AS_OF, duration="30 days"),
    Ranking("trending", event_names=("view", "click"), offset_date=AS_OF, duration="30 days"),
    Ranking("hot", event_names=("view",), offset_date=AS_OF, duration="30 days"),
    Ranking("random", offset_date=AS_OF, duration="30 days"),
    Ranking("userDefined"),
)
E_INDICATORS = (
    Indicator("purchase", max_correlators_per_item=10),
    Indicator("view", max_correlators_per_item=8, min_llr=1.5),
    Indicator("click", max_correlators_per_item=5),
)


def engine(**changes) -> EngineConfig:
    """The engine most workloads share: three indicators, five rankings, item dates."""
    settings = dict(
        app_name="shop", index_name="items", type_name="item",
        event_names=E_EVENTS, indicators=E_INDICATORS, rankings=E_RANKINGS,
        available_date_name="availableDate", expire_date_name="expireDate",
        seed=1,
    )
    return EngineConfig(**{**settings, **changes})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVENTS: users doing things to the item in ``props.k``."""
    return as_event_log(table(spark, sf_dir, "events"))


def as_event_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").alias("event"),
        F.lit("user").alias("entity_type"),
        F.col("user_id").cast("string").alias("entity_id"),
        F.lit("item").alias("target_entity_type"),
        F.get_json_object("props", "$.k").alias("target_entity_id"),
        F.col("ts").alias("event_time"),
        F.lit(None).cast("string").alias("properties"),
        F.col("ts").alias("creation_time"),
    )


def order_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTIONS from order lines: sold is a buy, returned after acceptance is a view."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    flag = F.col("l_returnflag")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(flag == "N", "buy").when(flag == "A", "view").otherwise("cart").alias("event"),
        F.col("o_custkey").cast("string").alias("user"),
        F.col("l_partkey").cast("string").alias("item"),
        F.col("o_orderdate").alias("ts"),
    )


def _available(partkey: Column) -> Column:
    return F.date_add(F.lit("1995-01-01").cast("date"), (partkey % 2000).cast("int"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item metadata, one row per part."""
    part = table(spark, sf_dir, "part")
    available = _available(F.col("p_partkey"))
    return part.select(
        F.col("p_partkey").cast("string").alias("item"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_size").cast("double").alias("userRank"),
        F.col("p_retailprice").alias("price"),
        available.alias("availableDate"),
        F.date_add(available, F.col("p_size") * 30).alias("expireDate"),
    )


def item_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata as PROPS rows, with brand and type as a JSON array ``categories``."""
    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    entries = F.array(
        entry("brand", F.col("brand")),
        entry("categories", F.to_json(F.array("brand", "type"))),
        entry("userRank", F.col("userRank")),
        entry("availableDate", F.col("availableDate")),
        entry("expireDate", F.col("expireDate")),
    )
    return items(spark, sf_dir).select("item", F.inline(entries))


def property_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVENTS that set or unset one of four keys of an item."""
    events = table(spark, sf_dir, "events")
    key = F.concat(F.lit("p"), (F.col("event_id") % 4).cast("string"))
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", "$unset").otherwise("$set").alias("event"),
        F.lit("item").alias("entity_type"),
        F.get_json_object("props", "$.k").alias("entity_id"),
        F.lit(None).cast("string").alias("target_entity_type"),
        F.lit(None).cast("string").alias("target_entity_id"),
        F.col("ts").alias("event_time"),
        F.to_json(F.create_map(key, F.col("value").cast("string"))).alias("properties"),
        F.col("ts").alias("creation_time"),
    )


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events and property events, each with a copy recorded an hour later."""
    log = event_log(spark, sf_dir).unionByName(
        property_log(spark, sf_dir).withColumn("event_id", F.concat(F.lit("p"), "event_id"))
    )
    copies = log.withColumns({
        "event_id": F.concat(F.lit("x"), "event_id"),
        "creation_time": F.col("creation_time") + F.expr("interval 1 hour"),
    })
    return log.unionByName(copies)


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON query per user; filters, dates and biases vary by user number."""
    u = F.col("user_id")
    every = table(spark, sf_dir, "events").select("user_id").distinct()
    brand = F.array(F.concat(F.lit("Brand#"), (u % 25 + 1).cast("string")))
    boosted = F.struct(
        F.lit("categories").alias("name"),
        F.array(F.concat(F.lit("Brand#"), (u % 10 + 1).cast("string")), F.lit("SMALL")).alias("values"),
        F.lit(1.5).alias("bias"),
    )
    filtered = F.struct(F.lit("brand").alias("name"), brand.alias("values"), F.lit(-1.0).alias("bias"))
    start = F.date_add(F.lit("1995-01-01").cast("date"), (u % 1500).cast("int"))
    dated = F.struct(
        F.lit("availableDate").alias("name"),
        F.date_format(F.date_add(start, 200), "yyyy-MM-dd'T'00:00:00").alias("before"),
        F.when(u % 2 == 0, F.date_format(start, "yyyy-MM-dd'T'00:00:00")).alias("after"),
    )
    def on(step: int, value: Column) -> Column:
        return F.when(u % step == 0, value)

    query = F.struct(
        u.cast("string").alias("queryId"),
        u.cast("string").alias("user"),
        F.when(u % 11 == 0, -1.0).when(u % 4 == 0, 2.0).alias("userBias"),
        (u % 100).cast("string").alias("item"),
        F.when(u % 13 == 0, -1.0).when(u % 6 == 0, 0.5).alias("itemBias"),
        F.when(u % 3 == 0, F.array(filtered)).when(u % 4 == 1, F.array(boosted)).alias("fields"),
        on(2, F.lit("1997-06-01T00:00:00")).alias("currentDate"),
        on(5, dated).alias("dateRange"),
        on(8, F.array(((u + 1) % 100).cast("string"), ((u + 2) % 100).cast("string"))).alias("blacklistItems"),
        on(7, F.lit(True)).alias("returnSelf"),
        on(9, F.lit(15)).alias("num"),
        on(10, F.array(F.lit("view"))).alias("eventNames"),
        (u % 2 == 0).alias("withRanks"),
    )
    return every.select(F.to_json(query).alias("value"))
