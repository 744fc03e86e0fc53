"""Connected components of a link table, as rounds of joins and aggregates.

Alternating large-star and small-star steps: every round groups links by
node and re-hangs neighbours on the smallest one, so the links of a hot node
are rewritten row by row (window minimum over a partition that Spark sorts
and spills), never gathered in one object.  Nothing but one number per
round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a > b).  Large star: neighbours above a node hang on its
    smallest neighbour; small star: the node and those below it do."""
    if large:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        new = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionAll(least.select("a", F.col("m").alias("b"))))
    return new.where("a <> b").distinct()


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links`` (a, b: long) -> (node, root) with the smallest node of each
    component as root; nodes without a link are not listed.  Raises if the
    links have not settled after ``rounds`` rounds (each at least halves the
    number of roots within a component's path, so 60 covers any table)."""
    now = (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now = checkpointed(now)
    seen = None
    for _ in range(rounds):
        now = checkpointed(_star(_star(now, True), False))
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (mark["n"], mark["x"]) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = (mark["n"], mark["x"])
    raise RuntimeError("links did not settle")
