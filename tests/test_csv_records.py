"""CSV files read by splits: quoted line breaks, quotes, carriage returns, unclosed quotes."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight import schema as S
from callsight.operators import clean
from callsight.sources import read_contacts, write_contacts
from callsight.sources.contacts import CORRUPT, VERBATIM, write_rejected
from callsight.sources.csv_records import csv_records, read_csv_records

NOTES = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("n", T.IntegerType())])


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def folder():
    return tempfile.mkdtemp(prefix="callsight-records-")


def test_one_file_of_many_splits_equals_the_multiline_reader(spark, small_splits):
    rng = random.Random(1)
    parts = ["plain", 'a "quoted" word', "line\nbreak", "two\n\nbreaks", '"', '""\n"', "comma, here", "", "ñandú\r\nend", '\n"x",\n']
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) or None, i % 7) for i in range(3000)]
    path = folder()
    df = spark.createDataFrame(rows, NOTES).coalesce(1)
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("lineSep", "\n").options(**VERBATIM).csv(path)
    got = read_csv_records(spark, path, NOTES)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    whole = spark.read.schema(NOTES).option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\n").csv(path)
    assert sorted(map(tuple, whole.collect())) == sorted(rows)
    tasks = csv_records(spark, path).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 8


def test_long_and_unclosed_records(spark, small_splits):
    path = folder()
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("id,note,n\n1,short,1\n2,\"" + "many\nlines\n" * 150 + "end\",2\n3,x,3\n")       # into the next split
    with open(os.path.join(path, "b.csv"), "w") as f:
        f.write("id,note,n\r\n4,\"a\r\nb\",4\r\n\r\n5,y,5\r\n6,\"never closed,6\n7,z,7\n")
    with open(os.path.join(path, "c.csv"), "w") as f:
        f.write("id,note,n\n" + "8,\"" + "beyond a split\n" * 900 + "end\",8\n9,w,9\n")
    with open(os.path.join(path, "d.csv"), "w") as f:
        f.write("")
    got = read_csv_records(spark, path, NOTES, corrupt_col="bad")
    rows = {r.id: (r.note, r.n) for r in got.where("bad is null").collect()}
    assert rows[2] == ("many\nlines\n" * 150 + "end", 2) and rows[4] == ("a\r\nb", 4)
    assert {1, 2, 3, 4, 5, 9} == set(rows)
    bad = [r.bad for r in got.where("bad is not null").collect()]
    assert any(b.startswith('6,"never') for b in bad) and any(b.startswith('8,"') for b in bad)
    small = read_csv_records(spark, path, NOTES, corrupt_col="bad", max_record_bytes=1000)
    assert 2 not in {r.id for r in small.where("bad is null").collect()}
    assert read_csv_records(spark, os.path.join(path, "d.csv"), NOTES).count() == 0


def test_contacts_read_the_same_in_all_ways(spark, golden):
    path = folder()
    write_contacts(golden.withColumn("note", F.concat(F.col("note"), F.lit('\n"and", more'))), path, fmt="csv")
    ways = [sorted(map(str, read_contacts(spark, path, records=r).collect())) for r in ("splits", "multiline")]
    assert ways[0] == ways[1] and len(ways[0]) == 12
    na = [sorted(map(str, read_contacts(spark, path, na_as_null=True, records=r).collect())) for r in ("splits", "multiline")]
    assert na[0] == na[1] != ways[0]


def test_rejected_rows_are_written_apart(spark, golden):
    path = folder()
    write_contacts(golden, path, fmt="csv")
    with open(os.path.join(path, "more.csv"), "w") as f:
        f.write(",".join(S.CONTACT_COLUMNS) + "\n13,C000000001,A000000001,llamada,interesado,2025-01-06 09:15:00,ok,x,NA,0.0,NA\n"      # flag is no number
                "14,bad,A000000001,fax,interesado,2024-12-31 09:15:00,ok,0,NA,0.0,NA\n15,cut\n")
    good, bad = clean.split_conforming(read_contacts(spark, path, corrupt_col=CORRUPT), CORRUPT)
    assert {r.interaction_id for r in good.collect()} == set(range(1, 13)) and CORRUPT not in good.columns
    failed = {r.interaction_id or (r[CORRUPT] or "").split(",")[0]: r.failed_checks for r in bad.collect()}
    assert failed[14] == ["client_id_format", "channel_domain", "contact_ts_range"]
    assert [failed[k][0] for k in (13, 15)] == ["malformed_record"] * 2
    write_rejected(bad, f"{path}-rejected")
    back = spark.read.parquet(f"{path}-rejected")
    assert back.count() == 3 and back.where("first_failed = 'malformed_record'").count() == 2
    assert clean.split_conforming(spark.createDataFrame([], S.CONTACT_SCHEMA))[1].count() == 0
