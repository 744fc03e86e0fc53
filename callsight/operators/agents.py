"""Agent reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ratio


def agent_summary(df: DataFrame) -> DataFrame:
    """Orders and contacts per agent in one aggregate (the studied app
    joins two aggregates of the same table, J2)."""
    return (df.groupBy("agent_id")
              .agg(F.sum("has_order").alias("total_orders"), F.count(F.lit(1)).alias("total_contacts")))


def join_agents(orders: DataFrame, contacts: DataFrame) -> DataFrame:
    """Inner equi-join of two per-agent aggregates."""
    return orders.join(contacts, "agent_id", "inner")


def agent_conversion(df: DataFrame) -> DataFrame:
    """A20 plus order rate."""
    return agent_summary(df).withColumn("order_rate", ratio("total_orders", "total_contacts"))


def top_agents(df: DataFrame, k: int = 10) -> DataFrame:
    """K3: the ``k`` agents with most orders; agent id breaks ties.
    Planned as a distributed top-k (``TakeOrderedAndProject``)."""
    return (agent_summary(df)
            .orderBy(F.desc_nulls_last("total_orders"), F.asc("agent_id")).limit(k))


def bottom_agents(df: DataFrame, k: int = 10) -> DataFrame:
    """K4: the ``k`` agents with fewest orders; agent id breaks ties."""
    return (agent_summary(df)
            .orderBy(F.asc_nulls_last("total_orders"), F.asc("agent_id")).limit(k))
