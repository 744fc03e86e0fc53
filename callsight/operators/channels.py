"""Channel x category reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ratio
from .clean import category_without_default, with_order


def channel_category_orders(df: DataFrame) -> DataFrame:
    """Orders per (channel, category), order rows only."""
    return (with_order(df).groupBy("channel", "product_category")
            .agg(F.count(F.lit(1)).alias("orders")))


def channel_category_share(df: DataFrame) -> DataFrame:
    """A18, NULL category labelled and excluded (P14), each row with
    the channel total and its percent share (2 decimals).

    The window runs over the aggregated table (one row per channel and
    category), never over contacts."""
    agg = category_without_default(channel_category_orders(df))
    w = Window.partitionBy("channel")
    return (agg.withColumn("channel_orders", F.sum("orders").over(w))
               .withColumn("share_pct", F.round(F.col("orders") * F.lit(100.0) / F.col("channel_orders"), 2)))


def channel_category_conversion(df: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """Orders, contacts and order rate per (channel, category), most
    orders first.  ``drop_null_keys=True`` reproduces the pandas notebook
    (T1): groups with a NULL key -- there, every ``NA`` category, i.e. all
    non-orders -- disappear, and the rate is 1.0 everywhere."""
    if drop_null_keys:
        df = df.where(F.col("channel").isNotNull() & F.col("product_category").isNotNull())
    return (df.groupBy("channel", "product_category")
              .agg(F.sum("has_order").alias("orders"), F.count(F.lit(1)).alias("total_contacts"))
              .withColumn("order_rate", ratio("orders", "total_contacts"))
              .orderBy(F.desc_nulls_last("orders"), "channel", "product_category"))


def conversion_by_channel(df: DataFrame) -> DataFrame:
    """Contacts, orders and order rate (NULL flags ignored) per channel."""
    return (df.groupBy("channel")
              .agg(F.count(F.lit(1)).alias("total_contacts"), F.sum("has_order").alias("orders"),
                   F.avg("has_order").alias("order_rate"))
              .orderBy("channel"))


def category_ranking(df: DataFrame) -> DataFrame:
    """Categories by orders and amount, order rows only."""
    return (with_order(df).groupBy("product_category")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_amount").alias("amount"))
            .orderBy(F.desc("orders"), "product_category"))
