"""Table-level indicators.

Every indicator is a single aggregate (Spark plans it as partial
aggregation -> exchange -> final), never one job per number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import percent_label, ratio
from .quantiles import exact_quantiles

CATEGORICAL = ("channel", "agent_result", "product_category")
NUMERIC = ("has_order", "order_amount")


def total_contacts(df: DataFrame) -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias("total_contacts"))


def kpis(df: DataFrame) -> DataFrame:
    """A1-A5 in one row: contacts, order rate (NULL flags ignored), orders,
    non-orders, unknown flags and non-order rate over all rows (so the two
    rates need not add up to 1 when flags are NULL)."""
    f = F.col("has_order")
    agg = df.agg(
        F.count(F.lit(1)).alias("total_contacts"),
        F.avg(f).alias("order_rate"),
        F.count_if(f == 1).alias("orders"),
        F.count_if(f == 0).alias("non_orders"),
        F.count_if(f.isNull()).alias("unknown_flag"),
    )
    return agg.withColumn("non_order_rate", ratio("non_orders", "total_contacts"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, long form (column, n_nulls), in column order."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_nulls")


def null_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL share per column, largest first."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return (wide.unpivot([], cols, "column", "null_share")
                .orderBy(F.desc("null_share"), "column"))


def describe_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation,
    exact), max per numeric column; one row per column.

    The quartiles come from ``exact_quantiles`` (bucketed ranks, no column's
    values gathered in one task), the moments from one aggregate."""
    longf = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("x")).select("x.column", "x.v")
    stats = longf.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    probs = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    q = (exact_quantiles(longf, "column", "v", list(probs))
         .groupBy("column").pivot("p", list(probs)).agg(F.first("q")))
    q = q.withColumnsRenamed({str(p): name for p, name in probs.items()})
    return stats.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def top_values(df: DataFrame, columns: Sequence[str] = CATEGORICAL, k: int = 10) -> DataFrame:
    """Value counts including NULL, the ``k`` most frequent per
    column (ties: smaller value first, NULL first).  One scan: the columns
    are stacked, counted together and cut with a per-column rank, which
    Spark pre-limits per partition before the exchange."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("x")).select("x.column", "x.value")
    counts = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Per value the count and its share of all rows (percent),
    largest first.  The grand total is a scalar subquery, not a window over
    one partition."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("total"))
              .withColumn("percent", F.col("total") * F.lit(100.0) / total)
              .withColumn("percent_label", percent_label("percent"))
              .orderBy(F.desc("total"), F.asc_nulls_first(column)))


def class_balance(df: DataFrame, label: str = "has_order") -> DataFrame:
    """Rows per flag value."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
