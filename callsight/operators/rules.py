"""Deterministic hash buckets (splits, samples) and the order summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_unit(c, salt: str = "") -> Column:
    """Deterministic uniform number in [0, 1) from the md5 of ``salt || c``."""
    s = F.concat(F.lit(salt), F.col(c).cast("string")) if isinstance(c, str) else \
        F.concat(F.lit(salt), c.cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def hash_bucket(c, buckets: int = 100, salt: str = "") -> Column:
    """md5 bucket of an id: ``first 8 hex digits mod buckets``."""
    s = F.concat(F.lit(salt), F.col(c).cast("string")) if isinstance(c, str) else \
        F.concat(F.lit(salt), c.cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long") % buckets


def order_summary(df: DataFrame) -> DataFrame:
    """Number of orders and their share of all rows (NULL flag = no order)."""
    is_order = F.coalesce(F.col("has_order") == 1, F.lit(False))
    return df.agg(F.count_if(is_order).alias("orders"),
                  F.avg(is_order.cast("double")).alias("order_share"))
