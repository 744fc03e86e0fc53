"""Dense numbering 1..N in a hash-permuted order, without a global window.

A window ordered over the whole table would run in one task.  Instead rows
are cut into buckets by equal ranges of a uniform hash (balanced by
construction), each bucket is numbered by its own window, and the bucket
offsets come from a prefix sum over the per-bucket counts (a table of
``buckets`` rows, broadcast).
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_HASH_SPACE = 4294967296  # 16**8


def assign_numbers(df: DataFrame, id_col: str, out: str = "number",
                   buckets: int = 1024, salt: str = "") -> DataFrame:
    """Number rows 1..N ordered by (md5 hash of ``salt || id``, id), one window per hash range (``buckets`` of them)."""
    key = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(id_col).cast("string"))), 1, 8),
                 16, 10).cast("long")
    keyed = df.withColumn("_key", key).withColumn(
        "_bucket", F.floor(F.col("_key") * F.lit(buckets) / F.lit(_HASH_SPACE)).cast("int"))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    prefix = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(prefix), F.lit(0))).drop("_n")
    w = Window.partitionBy("_bucket").orderBy("_key", id_col)
    return (keyed.join(F.broadcast(offsets), "_bucket")
                 .withColumn(out, F.col("_offset") + F.row_number().over(w))
                 .drop("_key", "_bucket", "_offset"))
