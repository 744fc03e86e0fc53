"""J4 on streams and on bucketed tables: the rows of the batch form; contacts without a time match nothing."""

import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from callsight import schema as S
from callsight.operators import attribution, clean
from callsight.sources.contacts import write_contacts
from callsight.streaming.contacts_stream import attributed_stream, order_stream, read_contact_stream

T0 = datetime(2025, 3, 1, 9)


def tables(spark):
    contacts, orders = [], []
    for i in range(300):
        client = None if i % 29 == 0 else f"C{i % 40:09d}"
        at = None if i % 31 == 0 else T0 + timedelta(hours=5 * i % 1500, seconds=i)
        contacts.append((i, client, "A000000001", "llamada", "interesado", at, "nota", 1, None, None, None))
    for k in range(400):
        client = [None, S.SENTINEL_CLIENT, f"C{k % 45:09d}"][min(k % 37, 2)]
        orders.append((f"P{k:09d}", client, T0 + timedelta(hours=7 * k % 1600, seconds=k), float(k)))
    orders.append(("P900000000", "C000000031", datetime(2025, 1, 1, 3), 1.0))       # in reach of the sentinel time only
    orders += [("P900000001", "C000000001", T0 + timedelta(hours=5, seconds=1), 1.0),            # at the contact's second
               ("P900000002", "C000000001", T0 + timedelta(hours=29, seconds=1), 1.0),           # exactly a day later
               ("P900000003", "C000000001", T0 + timedelta(hours=29, seconds=2), 1.0)]
    return spark.createDataFrame(contacts, S.CONTACT_SCHEMA), spark.createDataFrame(orders, S.ORDER_SCHEMA)


def rows(df):
    return sorted((r.interaction_id, r.client_id, r.contact_ts, r.n_orders, r.orders_amount, r.first_order_id, r.attributed)
                  for r in df.collect())


def test_contacts_without_a_time_match_nothing(spark):
    c, o = tables(spark)
    out = attribution.attribute_orders(clean.normalize_contacts(c), o)
    assert out.where("interaction_id = 31").first().client_id == "C000000031"
    assert out.where(F.col("interaction_id") % 31 == 0).agg(F.sum("n_orders")).first()[0] == 0
    known = {r.interaction_id: r for r in out.collect()}
    assert len(known) == 300 and known[1].n_orders >= 2 and known[1].first_order_id == "P900000001"


def test_streams_give_the_rows_of_the_batch(spark):
    c, o = tables(spark)
    paths = [tempfile.mkdtemp(prefix="callsight-attr-") for _ in range(3)]
    later = T0 + timedelta(days=400)
    for k in range(2):                                                      # two files, in the order of time
        write_contacts(c.where(f"interaction_id % 2 = {k}").repartition(1), f"{paths[0]}/{k}", fmt="parquet")
        o.where(F.substring("order_id", 10, 1).cast("int") % 2 == k).repartition(1).write.parquet(f"{paths[1]}/{k}")
    stream = attributed_stream(read_contact_stream(spark, f"{paths[0]}/*"), order_stream(spark, f"{paths[1]}/*"), lateness="90 days")
    q = (stream.writeStream.format("memory").queryName("attributed_out").outputMode("append")
         .option("checkpointLocation", paths[2]).start())
    try:
        q.processAllAvailable()
        # rows far ahead move both watermarks past everything
        write_contacts(c.where("interaction_id = 1").withColumn("interaction_id", F.lit(-1).cast("long")).withColumn(
            "contact_ts", F.lit(later).cast("timestamp_ntz")), f"{paths[0]}/9", fmt="parquet")
        o.limit(1).withColumns({"order_id": F.lit("P999999999"), "client_id": F.lit("C000000001"),
                                "order_ts": F.lit(later).cast("timestamp_ntz")}).write.parquet(f"{paths[1]}/9")
        q.processAllAvailable()
    finally:
        q.stop()
    got = rows(spark.sql("SELECT * FROM attributed_out WHERE interaction_id >= 0"))
    assert got == rows(attribution.attribute_orders(clean.normalize_contacts(c), o))


def test_bucketed_contacts_are_not_shuffled(spark):
    c, o = tables(spark)
    normal = clean.normalize_contacts(c)
    stored = attribution.bucketed_contacts(normal, "attribution_contacts", tempfile.mkdtemp(prefix="callsight-bucket-") + "/t", 16)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attribution.attribute_orders(stored, o)
        plain = attribution.attribute_orders(normal, o)
        assert rows(out) == rows(plain)
        plan = out._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("Exchange hashpartitioning") == 1 and "o_client" in final.split("Exchange hashpartitioning(")[1][:60]
        assert "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE attribution_contacts")
