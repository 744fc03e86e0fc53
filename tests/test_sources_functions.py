"""Readers/writers (S1-S11) and scalar helpers."""

import os
import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from callsight import schema as S
from callsight.functions import calendar as cal
from callsight.functions import scalar as sc
from callsight.operators import agents, clean, trends
from callsight.sources import cached, inputs_frame, preview, read_contacts, resolve_column, write_contacts


def test_csv_round_trip(spark, golden):
    path = os.path.join(tempfile.mkdtemp(prefix="callsight-csv-"), "contacts")
    write_contacts(golden, path, fmt="csv")
    back = read_contacts(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in S.CONTACT_SCHEMA]
    rows = {r.interaction_id: r for r in back.collect()}
    assert len(rows) == 12
    assert rows[8].note is None                  # an empty field comes back as NULL
    assert rows[3].order_id == "NA"              # the literal NA is data ...
    na = {r.interaction_id: r for r in read_contacts(spark, path, na_as_null=True).collect()}
    assert na[3].order_id is None                # ... unless read like the notebook (T1)
    assert rows[1].contact_ts == datetime(2025, 1, 6, 9, 15, 0)
    assert clean.rule_violations(back).first()[0] == 1


def test_parquet_partitioned_write(spark, golden):
    path = os.path.join(tempfile.mkdtemp(prefix="callsight-pq-"), "contacts")
    df = clean.normalize_contacts(golden).withColumn("month", F.month("contact_ts"))
    write_contacts(df, path, fmt="parquet", partition_by=["month"])
    back = spark.read.parquet(path)
    assert back.where("month = 11").count() == 4


def test_join_forms_equal_single_aggregate(golden):
    df = clean.normalize_contacts(golden)
    joined = trends.join_monthly(trends.monthly_volume(df), trends.monthly_orders(df))
    single = trends.monthly_summary(df).drop("year_month")
    assert sorted(joined.select("year", "month", "total_contacts", "total_orders").collect()) == \
        sorted(single.collect())
    per_agent = df.groupBy("agent_id").agg(F.sum("has_order").alias("total_orders"))
    counts = df.groupBy("agent_id").agg(F.count(F.lit(1)).alias("total_contacts"))
    assert sorted(agents.join_agents(per_agent, counts).collect()) == sorted(agents.agent_summary(df).collect())


def test_time_helpers(spark):
    df = spark.createDataFrame([("2025-01-01 13:00:00", 13), ("bad", 9)], "s string, h int")
    out = df.select(cal.parse_ts("s").alias("t"),
                    cal.ts_from_parts(F.lit("2025-01-01"), "h").alias("u")).collect()
    assert out[0].t == datetime(2025, 1, 1, 13, 0) and out[1].t is None
    assert out[1].u == datetime(2025, 1, 1, 9, 0)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(0.0, 12.345), (1.0, 0.125), (5.0, 1.0)], "i double, p double")
    rows = df.select(sc.decode_label("i", ["no", "yes"]).alias("d"),
                     sc.label_flags("i", {0.0: "zero", 1.0: "one"}).alias("f"),
                     sc.percent_label("p").alias("pl"), sc.round2("p", half_even=True).alias("he"),
                     sc.format_id("P", F.lit(1234567890)).alias("big")).collect()
    assert [r.d for r in rows] == ["no", "yes", "5.0"]
    assert [r.f for r in rows] == ["zero", "one", None]
    assert rows[0].pl == "12.35%" and rows[1].he == 0.12
    assert rows[0].big == "P1234567890"


def test_frame_helpers(spark, golden):
    assert resolve_column(golden, ["fecha", "contact_ts", "ts"]) == "contact_ts"
    assert resolve_column(golden, ["nope"]) is None
    with cached(golden) as g:
        assert g.is_cached and g.count() == 12
    assert not golden.is_cached
    assert [r.interaction_id for r in preview(golden, 3).collect()] == [1, 2, 3]
    req = inputs_frame(spark, [(1, "llamada", "interesado", 10)],
                       "request_id long, channel string, agent_result string, hour int")
    assert req.count() == 1


def test_small_helpers(golden):
    """P8, P9, P11, P16, F1, F2, F4, F5."""
    df = clean.normalize_contacts(golden)
    assert clean.by_result(df, "interesado").count() == 7
    assert clean.with_order(df).count() == 6 and clean.without_order(df).count() == 5
    assert clean.is_empty(clean.by_result(df, "nadie")) and not clean.is_empty(df)
    assert clean.require_nonblank_note(golden).count() == 10          # NULL note and '' dropped
    assert clean.drop_incomplete(golden, ["has_order"]).count() == 11
    assert clean.project(df, "interaction_id", "channel").columns == ["interaction_id", "channel"]
    assert "medio" in clean.rename(df, {"channel": "medio"}).columns
    flags = df.select(sc.flag_int(F.col("has_order") == 1).alias("f")).collect()
    assert sorted({r.f for r in flags}, key=lambda v: (v is None, v)) == [0, 1, None]
