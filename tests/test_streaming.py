"""The cleaning rules and the daily volume on a stream of contact files."""

import tempfile

from callsight.catalog import QUERIES
from callsight.sources import raw_contacts
from callsight.sources.contacts import write_contacts
from callsight.streaming.contacts_stream import daily_volume_stream, normalized_stream, read_contact_stream
from conftest import SF


def test_stream_matches_batch(spark):
    path = tempfile.mkdtemp(prefix="callsight-stream-")
    write_contacts(raw_contacts(spark, SF, notes=False), path, fmt="parquet")
    s = normalized_stream(read_contact_stream(spark, path))
    q = s.writeStream.format("memory").queryName("norm_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    streamed = spark.sql("SELECT * FROM norm_out")
    batch = QUERIES["rule_violations_clean"](spark, SF).first()
    assert streamed.count() == 1000
    from callsight.operators.clean import rule_violations
    assert tuple(rule_violations(streamed).first()) == tuple(batch)

    d = daily_volume_stream(read_contact_stream(spark, path))
    q = d.writeStream.format("memory").queryName("daily_out").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    total = spark.sql("SELECT sum(total_contacts) FROM daily_out").first()[0]
    assert total == 1000
    streamed_days = {tuple(r) for r in spark.sql("SELECT day, total_contacts, total_orders FROM daily_out").collect()}
    batch_days = {tuple(r) for r in QUERIES["volume_by_day"](spark, SF).collect()}
    assert streamed_days == batch_days


def test_scored_stream_matches_batch(spark):
    """M27 on a stream: the same fitted model gives the same scores as in batch."""
    from callsight.catalog import contacts
    from callsight.plans import order_model
    from callsight.streaming.contacts_stream import scored_stream
    _, _, model = order_model.train_order_model(contacts(spark, SF), sample_fraction=None)
    path = tempfile.mkdtemp(prefix="callsight-score-")
    write_contacts(raw_contacts(spark, SF, notes=False), path, fmt="parquet")
    q = scored_stream(read_contact_stream(spark, path), model).writeStream.format("memory") \
        .queryName("scored_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    streamed = {(r.interaction_id, r.predicted_order, r.p_order) for r in spark.sql("SELECT * FROM scored_out").collect()}
    batch = {(r.interaction_id, r.predicted_order, r.p_order)
             for r in order_model.predict_orders(model, contacts(spark, SF)).collect()}
    assert streamed == batch and len(batch) == 1000
