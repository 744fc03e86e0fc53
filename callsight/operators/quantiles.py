"""Exact quantiles (linear interpolation) without one task per column.

Spark's exact ``percentile`` merges, per group, a map of every distinct value
in a single task.  Here the distinct values of each key are cut into
buckets at approximate boundaries (a bounded sketch, used only to split the
work), bucket offsets come from a prefix sum over the small bucket-count
table, each bucket ranks its own values, and the values at the two
positions around ``p * (n - 1)`` are fetched by an equi-join on (key,
bucket).  The result equals ``percentile`` (same interpolation formula).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.contacts import materialize


def exact_quantiles(df: DataFrame, key: str, value: str, probs: Sequence[float],
                    buckets: int = 64) -> DataFrame:
    """One row per (key, p) with the exact quantile ``q``."""
    hist = (df.where(F.col(value).isNotNull())
              .groupBy(key, F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = hist.groupBy(key).agg(F.percentile_approx("_v", cuts, 10000).alias("_b"))      # one row per key
    hist = hist.join(F.broadcast(bounds), key).withColumn(
        "_bucket", F.coalesce(F.size(F.filter("_b", lambda b: b < F.col("_v"))), F.lit(0))).drop("_b")
    # one consistent bucketing for the branches below (sketch merges need
    # not be repeatable, a recomputed branch must see the same buckets)
    hist = materialize(hist)
    bc = hist.groupBy(key, "_bucket").agg(F.sum("_c").alias("_bn"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bc = (bc.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
            .withColumn("_n", F.sum("_bn").over(Window.partitionBy(key))))
    upto = Window.partitionBy(key, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (hist.join(bc.select(key, "_bucket", "_off"), [key, "_bucket"])
                  .withColumn("_end", F.col("_off") + F.sum("_c").over(upto))
                  .withColumn("_start", F.col("_end") - F.col("_c")))
    # target positions (0-based) around p * (n - 1), both ends
    totals = bc.select(key, "_n").distinct()
    p_arr = F.array(*[F.lit(float(p)) for p in probs])
    targets = (totals.select(key, "_n", F.explode(p_arr).alias("p"))
                     .withColumn("_h", F.col("p") * (F.col("_n") - 1))
                     .select(key, "p", "_h", F.explode(F.array(F.floor("_h"), F.ceil("_h"))).alias("_pos")))
    # the bucket holding each position: a join of two small tables
    tb = targets.join(bc, [key]).where((F.col("_pos") >= F.col("_off")) & (F.col("_pos") < F.col("_off") + F.col("_bn")))
    hit = (tb.select(key, "p", "_h", "_pos", "_bucket")
             .join(ranked.select(key, "_bucket", "_v", "_start", "_end"), [key, "_bucket"])
             .where((F.col("_pos") >= F.col("_start")) & (F.col("_pos") < F.col("_end"))))
    lo = F.min_by("_v", "_pos")
    hi = F.max_by("_v", "_pos")
    out = hit.groupBy(key, "p").agg(F.first("_h").alias("_h"), lo.alias("_lo"), hi.alias("_hi"))
    h = F.col("_h")
    q = F.when(F.floor(h) == F.ceil(h), F.col("_lo")).when(F.col("_lo") == F.col("_hi"), F.col("_lo")) \
        .otherwise((F.ceil(h) - h) * F.col("_lo") + (h - F.floor(h)) * F.col("_hi"))
    return out.select(key, "p", q.alias("q"))
