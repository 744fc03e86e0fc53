"""Attribute orders to contacts of the same client within a time window.

An interval join ``order_ts BETWEEN contact_ts AND contact_ts + window`` is
made an equi-join by cutting time into buckets as long as the window: a
matching order lies in the contact's bucket or the next one, so every
order is listed under its own bucket and the previous one (x2 rows), and
every contact under its own bucket only.  Each (contact, order) pair then
meets in exactly one bucket, the join key (client, bucket) spreads a busy
client over time, and the per-contact aggregate reuses the join's
partitioning (no second exchange).  Contacts of the sentinel client (all
NULL clients collapsed into one key) cannot match anything and bypass the
join entirely instead of forming one huge partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.contacts import write_bucketed


BUCKET = "attribution_bucket"


def time_bucket(ts, hours: int):
    """Bucket number of a naive timestamp: whole hours since 1970 / ``hours``
    (wall-clock based, independent of the session time zone)."""
    h = F.unix_date(F.to_date(ts)).cast("long") * 24 + F.hour(ts)
    return F.floor(h / F.lit(hours)).cast("long")


def matchable(exclude_clients: Sequence[str] = (S.SENTINEL_CLIENT,), exclude_times: Sequence[str] = (S.DEFAULT_TS,)) -> Column:
    """Contacts with a known client and a known time: only these can be given orders (never NULL)."""
    known = F.col("client_id").isNotNull() & F.col("contact_ts").isNotNull() & ~F.col("client_id").isin(*exclude_clients)
    for t in exclude_times:
        known = known & (F.col("contact_ts") != F.to_timestamp_ntz(F.lit(t), F.lit("yyyy-MM-dd HH:mm:ss")))
    return F.coalesce(known, F.lit(False))


def bucketed_contacts(contacts: DataFrame, name: str, path: str, buckets: int, window_hours: int = 24) -> DataFrame:
    """The contacts as a table bucketed and sorted by the attribution's join key, written once.  ``buckets`` should be
    at least the session's number of shuffle partitions, else the planner prefers to shuffle."""
    keyed = contacts.withColumn(BUCKET, time_bucket(F.col("contact_ts"), window_hours))
    return write_bucketed(keyed, name, path, ["client_id", BUCKET], buckets, ["interaction_id"])


def attribute_orders(contacts: DataFrame, orders: DataFrame, window_hours: int = 24,
                     exclude_clients: Sequence[str] = (S.SENTINEL_CLIENT,),
                     exclude_times: Sequence[str] = (S.DEFAULT_TS,)) -> DataFrame:
    """One row per contact: orders of its client placed from the contact
    time up to ``window_hours`` later (both ends included): count, amount,
    first order (earliest, then smallest id) and a 0/1 ``attributed`` flag.
    Contacts may carry their bucket (:func:`bucketed_contacts`)."""
    has_bucket = BUCKET in contacts.columns
    c = contacts.select("interaction_id", "client_id", "contact_ts", *([BUCKET] if has_bucket else []))
    can = matchable(exclude_clients, exclude_times)
    cm = c.where(can)
    if not has_bucket:
        cm = cm.withColumn(BUCKET, time_bucket(F.col("contact_ts"), window_hours))
    o = orders.select("order_id", F.col("client_id").alias("o_client"), "order_ts", "order_amount") \
        .where(F.col("o_client").isNotNull() & F.col("order_ts").isNotNull())
    ob = time_bucket(F.col("order_ts"), window_hours)
    o = o.withColumn("o_bucket", F.explode(F.array(ob, ob - 1)))
    cond = ((cm["client_id"] == o["o_client"]) & (cm[BUCKET] == o["o_bucket"])
            & (o["order_ts"] >= cm["contact_ts"])
            & (o["order_ts"] <= cm["contact_ts"] + F.make_dt_interval(hours=F.lit(window_hours))))
    j = cm.join(o, cond, "left")
    first = F.min(F.when(F.col("order_id").isNotNull(), F.struct("order_ts", "order_id")))
    matched = (j.groupBy("client_id", BUCKET, "interaction_id", "contact_ts")
                .agg(F.count("order_id").alias("n_orders"),
                     F.sum("order_amount").alias("orders_amount"),
                     first["order_id"].alias("first_order_id"))
                .drop(BUCKET))
    rest = (c.where(~can)
              .select("client_id", "interaction_id", "contact_ts",
                      F.lit(0).cast("long").alias("n_orders"),
                      F.lit(None).cast("double").alias("orders_amount"),
                      F.lit(None).cast("string").alias("first_order_id")))
    out = matched.unionByName(rest)
    return out.withColumn("attributed", (F.col("n_orders") > 0).cast("int"))
