"""Domain views (view, impression, action, cart, versions of users, contents) over the star-schema tables.

Absent strings are '' and absent numbers 0, as in the event logs. Every view is a plain projection, so filters and
column selections reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.session import table

NAVIGATE, PURCHASE, ADD_TO_CART, CHECKOUT, SIGN_UP = 2, 3, 4, 8, 15


def millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ or TIMESTAMP column (UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def _content() -> Column:
    return F.get_json_object("props", "$.k")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with the common fields: platform, anonymous user, content and event-API time."""
    return table(spark, sf_dir, "events").select(
        F.lit(1).cast("bigint").alias("platform_id"),
        F.col("event_id"),
        F.col("user_id").cast("string").alias("log_user_id"),
        _content().alias("content_id"),
        F.col("event_type"),
        F.col("value"),
        F.col("ts").cast("timestamp_ntz").alias("rowtime"),
    )


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("event_type = 'view' AND event_id % 2 = 0").select(
        "platform_id", "log_user_id", F.col("event_id").cast("string").alias("view_id"), "content_id", "rowtime"
    )


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("event_type = 'view' AND event_id % 2 = 1").select(
        "platform_id", "log_user_id", F.col("event_id").cast("string").alias("impression_id"), "content_id", "rowtime"
    )


def action_type() -> Column:
    return (
        F.when(F.col("event_type") == "click", NAVIGATE)
        .when(F.col("event_type") == "purchase", PURCHASE)
        .otherwise(SIGN_UP)
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("event_type IN ('click', 'purchase', 'signup')").select(
        "platform_id",
        "log_user_id",
        F.col("event_id").cast("string").alias("action_id"),
        "content_id",
        action_type().alias("action_type"),
        "rowtime",
    )


def cart_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cart item of a purchase order; prices in micros of a currency unit."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint") * 10000
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.lit(1).cast("bigint").alias("platform_id"),
        F.col("o_custkey").cast("string").alias("log_user_id"),
        F.col("o_orderkey").cast("string").alias("action_id"),
        F.col("l_partkey").cast("string").alias("content_id"),
        F.lit(PURCHASE).alias("action_type"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        cents.alias("line_micros"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("rowtime"),
    ).selectExpr("*", "line_micros div quantity AS price_usd_micros_per_unit")
