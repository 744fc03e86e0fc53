"""Monthly, hourly and daily trends.

The studied app joins two aggregates of the same table on (year, month);
here both measures come from one ``groupBy`` (one scan, one exchange) and
the join operator is kept only for inputs that really are two tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.calendar import with_calendar
from ..functions.scalar import ratio

_FLAG = "has_order"


def _monthly(df: DataFrame) -> DataFrame:
    return with_calendar(df, parts=("year", "month"))


def monthly_volume(df: DataFrame) -> DataFrame:
    """A11."""
    return _monthly(df).groupBy("year", "month").agg(F.count(F.lit(1)).alias("total_contacts"))


def monthly_orders(df: DataFrame) -> DataFrame:
    """A12."""
    return _monthly(df).groupBy("year", "month").agg(F.sum(_FLAG).alias("total_orders"))


def join_monthly(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join of two monthly aggregates (NULL keys drop out)."""
    return a.join(b, ["year", "month"], "inner")


def monthly_summary(df: DataFrame) -> DataFrame:
    """Contacts and orders per month, ordered (K1), with ``YYYY-MM``."""
    return (_monthly(df).groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("total_contacts"), F.sum(_FLAG).alias("total_orders"))
            # text label from the keys after the aggregate: keeps a hash aggregate
            .withColumn("year_month", F.format_string("%04d-%02d", "year", "month"))
            .orderBy("year", "month"))


def monthly_conversion(df: DataFrame) -> DataFrame:
    """Counts non-NULL ids, sums flags, order rate."""
    return (_monthly(df).groupBy("year", "month")
            .agg(F.count("interaction_id").alias("total_contacts"), F.sum(_FLAG).alias("total_orders"))
            .withColumn("order_rate", ratio("total_orders", "total_contacts"))
            .orderBy("year", "month"))


def monthly_interest(df: DataFrame) -> DataFrame:
    """Interested / not interested per month."""
    r = F.col("agent_result")
    return (_monthly(df).groupBy("year", "month")
            .agg(F.count_if(r == "interesado").alias("interested"),
                 F.count_if(r == "no_interesado").alias("not_interested"))
            .orderBy("year", "month"))


def interest_long(df: DataFrame) -> DataFrame:
    """Contacts per (year, month, result)."""
    return _monthly(df).groupBy("year", "month", "agent_result").agg(F.count(F.lit(1)).alias("total"))


def interest_pivot(df: DataFrame, values: Sequence[str] = (*S.RESULTS, S.UNKNOWN_RESULT)) -> DataFrame:
    """Month x result matrix, missing -> 0.  The year is dropped like in
    the studied notebook.  Pivot values are listed, which saves the job
    that would otherwise collect them."""
    return (_monthly(df).groupBy("month").pivot("agent_result", list(values))
            .agg(F.count(F.lit(1))).na.fill(0).orderBy("month"))


def volume_by_hour(df: DataFrame) -> DataFrame:
    """R1."""
    return (df.groupBy(F.hour("contact_ts").alias("hour"))
              .agg(F.count(F.lit(1)).alias("total_contacts"), F.sum(_FLAG).alias("total_orders"))
              .orderBy("hour"))


def volume_by_day(df: DataFrame) -> DataFrame:
    """R2."""
    return (df.groupBy(F.to_date("contact_ts").alias("day"))
              .agg(F.count(F.lit(1)).alias("total_contacts"), F.sum(_FLAG).alias("total_orders"))
              .orderBy("day"))


def hour_weekday_matrix(df: DataFrame) -> DataFrame:
    """Contacts per hour (rows) and weekday 1=Sunday..7 (columns d1..d7)."""
    base = df.select(F.hour("contact_ts").alias("hour"), F.dayofweek("contact_ts").alias("dow"))
    out = base.groupBy("hour").pivot("dow", list(range(1, 8))).agg(F.count(F.lit(1))).na.fill(0)
    return out.withColumnsRenamed({str(i): f"d{i}" for i in range(1, 8)}).orderBy("hour")


def interest_by_hour(df: DataFrame) -> DataFrame:
    """Interest and orders by contact hour."""
    r = F.col("agent_result")
    return (df.groupBy(F.hour("contact_ts").alias("hour"))
              .agg(F.count(F.lit(1)).alias("total_contacts"),
                   F.count_if(r == "interesado").alias("interested"),
                   F.count_if(r == "no_interesado").alias("not_interested"))
              .withColumn("interest_rate", ratio("interested", "total_contacts"))
              .orderBy("hour"))
