"""Logical inputs of the marts taken from the driver's star-schema tables.

differ from it and are listed in README.md.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.functions.scalars import money, total
from martloom.operators.joins import enrich
from martloom.operators.rows import computed_once
from martloom.schema import DOUBLE, INT, LONG, TEXT, TS_NTZ, record
from martloom.session import fresh_path
from martloom.sources.files import read_lookup

# Statuses and event types of the test data.
CLOSED, OPEN, REFUNDED = "F", "O", "P"
STATUSES = [CLOSED, OPEN, REFUNDED]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
ENTER, LEAVE, WRITE, SUBSCRIBE, SEND = "signup", "error", "purchase", "view", "click"

SCHEMAS = {
    "region": record(r_regionkey=INT, r_name=TEXT),
    "nation": record(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": record(c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=TEXT),
    "supplier": record(s_suppkey=LONG, s_name=TEXT, s_nationkey=INT, s_acctbal=DOUBLE),
    "part": record(p_partkey=LONG, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=INT, p_retailprice=DOUBLE),
    "orders": record(
        o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=DOUBLE, o_orderdate=TS_NTZ,
        o_orderpriority=TEXT
    ),
    "lineitem": record(
        l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=INT, l_quantity=DOUBLE,
        l_extendedprice=DOUBLE, l_discount=DOUBLE, l_tax=DOUBLE, l_returnflag=TEXT, l_linestatus=TEXT,
        l_shipdate=TS_NTZ
    ),
    "events": record(event_id=LONG, ts=TS_NTZ, user_id=LONG, event_type=TEXT, value=DOUBLE, props=TEXT),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per courier and order, summed before the order is looked up so that
    an order with very many lines is small at the join."""
    shares = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(
        total(money("l_extendedprice")).alias("amount"),
        total(F.col("l_tax").cast("decimal(4,2)") * money("l_extendedprice")).alias("tips"),
        F.min((F.lit(5) - F.lit(20) * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(4,2)")).alias("rate"),
    )
    dates = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return shares.join(dates, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("courier_id"),
        "rate", "amount", "tips", "order_date",
    )


def tiers(spark: SparkSession) -> DataFrame:
    """Example rate card."""
    rows = [
        (Decimal("0"), Decimal("3.9"), Decimal("0.04"), Decimal("50")),
        (Decimal("3.9"), Decimal("4.1"), Decimal("0.06"), Decimal("80")),
        (Decimal("4.1"), Decimal("99"), Decimal("0.09"), Decimal("120")),
    ]
    return spark.createDataFrame(rows, "lo decimal(4,2), hi decimal(4,2), pct decimal(4,2), floor decimal(6,2)")


FEE = Decimal("0.05")


def order_dishes(spark: SparkSession, sf_dir: str, item: str = "dish_id") -> DataFrame:
    """Distinct (order, item) with the user of the order, item being the dish or
    its category. Repeats within an order go before the join."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("dish_id")
    ).distinct()
    if item == "category":
        lines = enrich(lines, dishes(spark, sf_dir), "dish_id").select("order_id", "category").distinct()
    owners = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id")
    )
    return lines.join(owners, "order_id")


def dishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("dish_id"), F.col("p_name").alias("dish_name"), F.col("p_type").alias("category")
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the community number read out of the JSON properties."""
    rows = table(spark, sf_dir, "events")
    return computed_once(rows, "group_id", F.from_json("props", "k bigint")["k"]).drop("props")


def group_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that happened in a community."""
    return events(spark, sf_dir).select("event_id", "group_id", "user_id", F.col("event_type").alias("event"), "ts")


def group_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("event_type") == WRITE).select("group_id", "user_id", "ts")


def user_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("zone_id")
    )


COMMUNITY_ZONE = record(group_id=LONG, zone_id=LONG, version=INT)


def community_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup of the zone of a community, as an exported snapshot: four communities in
    each nation, and older versions that name a wrong one."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n"))
    rows = nation.select("n", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
    rows = rows.select((F.col("n") * 4 + F.col("i")).alias("group_id"), "n", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    snapshot = rows.select("group_id", F.when(F.col("version") == 2, F.col("n")).otherwise(F.lit(-1)).alias("zone_id"), "version")
    path = fresh_path(spark, "community-zones")
    snapshot.write.parquet(path)
    return read_lookup(spark, path, COMMUNITY_ZONE, "group_id", "version").drop("version")


def lake_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the zone they happened in, found by their community."""
    rows = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "group_id")
    return enrich(rows, community_zones(spark, sf_dir), "group_id").drop("group_id")


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("event_type") == SUBSCRIBE).select(
        "user_id", F.col("group_id").alias("restaurant_id")
    )


def zone_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    subscribed = subscriptions(spark, sf_dir).withColumnRenamed("restaurant_id", "group_id").distinct()
    return subscribed.join(user_zones(spark, sf_dir), "user_id").select("zone_id", "user_id", "group_id")


def direct_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sent and received lists, over all users: a click on k is a message to the user k
    numbers on, a signup in k a message received from there."""
    rows = events(spark, sf_dir).withColumn("other", F.col("user_id") + F.col("group_id"))
    sent = rows.filter(F.col("event_type") == SEND).select(
        F.col("user_id").alias("from_id"), F.col("other").alias("to_id"))
    received = rows.filter(F.col("event_type") == ENTER).select(
        F.col("other").alias("from_id"), F.col("user_id").alias("to_id"))
    return sent, received


def user_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        (key * 37 % 180 - 90).cast("double").alias("lat"),
        (key * 73 % 360 - 180).cast("double").alias("lon"),
    )


def zone_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("zone_id"),
        (key * 11 % 170 - 85).cast("double").alias("lat"),
        (key * 29 % 350 - 175).cast("double").alias("lon"),
    )


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one wide table: order lines with all attributes repeated on each row. Amounts are
    fixed-point and orders have their customers before the lines meet them, so that what is
    shuffled per line is narrow."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint").alias("line_no"),
        money("l_quantity").alias("qty"), money("l_extendedprice").alias("price"))
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey", "c_name", "c_mktsegment", "n_name")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date")).join(
        customer, F.col("o_custkey") == F.col("c_custkey"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_orderkey").alias("order_id"), "order_date", "line_no", "qty", "price",
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_segment"), F.col("n_name").alias("customer_country"),
            F.col("p_partkey").alias("dish_id"), F.col("p_name").alias("dish_name"),
            F.col("p_type").alias("dish_category"),
            F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"),
        )
    )


WIDE_DIMS = {
    "customer": ["customer_id", "customer_name", "customer_segment", "customer_country"],
    "dish": ["dish_id", "dish_name", "dish_category"],
    "vendor": ["vendor_id", "vendor_name"],
}
WIDE_MEASURES = ["order_id", "order_date", "line_no", "qty", "price"]
