"""DataFrames over the given tables that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvein.operators.ratings import prepare_ratings
from tallyvein.sources.readers import table


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def customer_parts(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).select("o_custkey", "l_partkey")


def customer_months(spark: SparkSession, folder: str) -> DataFrame:
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return table(spark, folder, "orders").select("o_custkey", month.alias("order_month"))


def customer_nations(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    placed = order_lines(spark, folder).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return placed.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("o_custkey", "n_name")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(F.lit("#"), F.col("event_type"), F.lit(" #k"), F.get_json_object("props", "$.k"))
    return table(spark, folder, "events").select("event_id", "ts", text.alias("text"))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = order_lines(spark, folder).withColumn("stars", F.ceil(F.col("l_quantity") / 10))
    return prepare_ratings(lines, "o_custkey", "l_partkey", "stars")


def building_customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_name")


def event_points(spark: SparkSession, folder: str) -> DataFrame:
    """Events as points of (value, key, hour) with their type."""
    events = table(spark, folder, "events")
    features = F.array(
        F.col("value"), F.get_json_object("props", "$.k").cast("double"), F.hour("ts").cast("double")
    )
    return events.select(F.col("event_id").alias("point_id"), features.alias("features"), "event_type")


def r6(col):
    """Six places: sums of doubles depend on their order beyond that."""
    return F.round(col, 6)
