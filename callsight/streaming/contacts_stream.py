"""The batch operators on a stream of contact files.

The cleaning rules (P7) and order scoring (M27) are stateless column
expressions, so they apply unchanged to a streaming DataFrame.  The daily
volume report (R2) becomes a watermarked event-time window, so state is
dropped once a day can no longer change.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.attribution import matchable
from ..operators.clean import normalize_contacts
from ..plans.order_model import predict_orders


def read_contact_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw contacts arriving as files under ``path`` (fixed schema)."""
    r = spark.readStream.schema(S.CONTACT_SCHEMA).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def normalized_stream(stream: DataFrame) -> DataFrame:
    """P7 on a stream."""
    return normalize_contacts(stream)


def scored_stream(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """M27 on a stream: P(order) for every arriving contact."""
    return predict_orders(model, normalize_contacts(stream))


def wall_clock_as_utc(ts) -> F.Column:
    """A naive wall-clock time as the instant it names in UTC (event time
    needs a zoned timestamp; reading it as UTC keeps day windows equal to
    wall-clock days whatever the session time zone)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    sec = F.date_format(t, "ss.SSSSSS").cast("decimal(8,6)")
    return F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), sec, F.lit("UTC"))


def daily_volume_stream(stream: DataFrame, watermark: str = "2 days") -> DataFrame:
    """R2 as a windowed streaming aggregate: contacts and orders per day,
    emitted once the watermark passes the end of the day."""
    x = normalize_contacts(stream).withColumn("event_ts", wall_clock_as_utc("contact_ts"))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int"))
    return (x.withWatermark("event_ts", watermark)
             .groupBy(F.window("event_ts", "1 day").alias("w"))
             .agg(F.count(F.lit(1)).alias("total_contacts"), F.sum("has_order").alias("total_orders"))
             .select(day.alias("day"), "total_contacts", "total_orders"))


def order_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Orders arriving as files under ``path`` (fixed schema)."""
    r = spark.readStream.schema(S.ORDER_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def attributed_stream(contact_stream: DataFrame, orders: DataFrame, window_hours: int = 24, lateness: str = "2 days") -> DataFrame:
    """J4 on two streams: the columns of ``attribute_orders``, one row per contact once no order can match it any more.

    A left outer interval join with a watermark on either side keeps a
    contact until orders up to ``window_hours`` after it (and ``lateness``
    more) must have arrived, an order until no earlier contact can; a contact
    without an order comes out when its state expires.  The orders of a
    contact are then summed per contact, closed by the same watermark.
    Contacts without a known client or time need no state and pass at once.
    Rows later than the watermark are dropped, as in every watermarked query."""
    c = normalize_contacts(contact_stream).select("interaction_id", "client_id", "contact_ts")
    can = matchable()
    known = c.where(can).withColumn("at", wall_clock_as_utc("contact_ts")).withWatermark("at", lateness)
    o = (orders.where(F.col("client_id").isNotNull() & F.col("order_ts").isNotNull())
         .select("order_id", F.col("client_id").alias("o_client"), "order_ts", "order_amount", wall_clock_as_utc("order_ts").alias("o_at"))
         .withWatermark("o_at", lateness))
    cond = ((F.col("client_id") == F.col("o_client")) & (F.col("o_at") >= F.col("at"))
            & (F.col("o_at") <= F.col("at") + F.expr(f"INTERVAL {window_hours} HOURS")))
    j = known.join(o, cond, "leftOuter")
    first = F.min(F.when(F.col("order_id").isNotNull(), F.struct("order_ts", "order_id")))
    matched = (j.groupBy("at", "client_id", "interaction_id", "contact_ts")
               .agg(F.count("order_id").alias("n_orders"), F.sum("order_amount").alias("orders_amount"),
                    first["order_id"].alias("first_order_id")).drop("at"))
    rest = c.where(~can).select("client_id", "interaction_id", "contact_ts", F.lit(0).cast("long").alias("n_orders"),
                                F.lit(None).cast("double").alias("orders_amount"), F.lit(None).cast("string").alias("first_order_id"))
    return matched.unionByName(rest).withColumn("attributed", (F.col("n_orders") > 0).cast("int"))
