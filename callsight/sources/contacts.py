"""Reading and writing contact tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .csv_records import read_csv_records


CORRUPT = "malformed_record"
VERBATIM = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}     # the CSV writer trims fields by default


def read_contacts(spark: SparkSession, path: str, fmt: str = "csv", na_as_null: bool = False, schema=S.CONTACT_SCHEMA,
                  records: str = "splits", corrupt_col: str | None = None) -> DataFrame:
    """Read a contact table with the fixed schema (no inference pass).

    ``records`` says how CSV records are found: ``splits`` (quoted line breaks
    allowed, any number of tasks a file), ``multiline`` (Spark's own reader
    for them: one task a file) or ``lines`` (no line breaks in fields).
    ``na_as_null=True`` reproduces the notebook reader where the literal
    ``NA`` and empty fields become NULL.  Rows whose values do not parse are
    kept with NULLs (PERMISSIVE), the cleaning rules decide about them;
    ``corrupt_col`` adds the text of such a record, NULL for all others."""
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    options = {"nullValue": "NA"} if na_as_null else {}
    if records == "splits":
        return read_csv_records(spark, path, schema, corrupt_col, **options)
    full = schema if corrupt_col is None else T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
    reader = (spark.read.schema(full).option("header", True)
              .option("mode", "PERMISSIVE").option("multiLine", records == "multiline")
              .option("escape", '"').options(**options))   # default time parsing: 'yyyy-MM-dd HH:mm:ss' and ISO 'T' forms
    if corrupt_col:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.csv(path)


def write_rejected(rejected: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows that fail a check, apart from the accepted ones: parquet, one folder per check that failed first."""
    first = F.col("failed_checks")[0]
    rejected.withColumn("first_failed", first).write.mode(mode).partitionBy("first_failed").parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """A table whose files are bucketed by ``keys`` and sorted within: joins and aggregates on these keys read it
    without an exchange.  ``path`` is a folder that all executors share."""
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys, *sort_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def write_contacts(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """S3: fixed column order; CSV with header or parquet (optionally
    partitioned, e.g. by year/month for partition pruning)."""
    out = df.select(*[c for c in S.CONTACT_COLUMNS if c in df.columns],
                    *[c for c in (partition_by or []) if c not in S.CONTACT_COLUMNS])
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        whole = "yyyy-MM-dd HH:mm:ss.SSSSSS"          # the default forms stop at milliseconds
        w.options(header=True, escape='"', timestampFormat=whole, timestampNTZFormat=whole, **VERBATIM).csv(path)
    else:
        w.parquet(path)


def inputs_frame(spark: SparkSession, rows: Iterable[tuple], schema) -> DataFrame:
    """A relation from literal rows (requests, fixtures)."""
    return spark.createDataFrame(list(rows), schema)


def preview(df: DataFrame, n: int = 1000, order_by: str | None = "interaction_id") -> DataFrame:
    """First ``n`` rows; deterministic when an order column is given
    (planned as a distributed top-k, not a full sort)."""
    return (df.orderBy(order_by) if order_by else df).limit(n)


def row_limit_sample(df: DataFrame, n: int = 50000, order_by: str = "interaction_id") -> DataFrame:
    """The first ``n`` rows by id as a working sample (the limit is the feature)."""
    return df.orderBy(order_by).limit(n)


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First existing column out of alias candidates."""
    return next((c for c in candidates if c in df.columns), None)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist a frame for several actions, release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, a laptop) gets a
    fallback folder; on a cluster the setting is required, never a
    machine-local folder."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    if fallback is None:
        import tempfile
        fallback = tempfile.mkdtemp(prefix="callsight-ckpt-")
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir() or fallback


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (survives executor loss, unlike a local checkpoint).

    A reliable checkpoint writes its files in a second job after the one that
    computes the data; the data is persisted for the duration so that the
    second job reads it instead of computing it again."""
    checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def materialize_files(df: DataFrame) -> DataFrame:
    """Like :func:`materialize` for a large frame: Parquet files in the shared checkpoint folder, which hold rows in a
    fraction of a checkpoint's bytes and are read by column."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_literals(df: DataFrame) -> DataFrame:
    """A table of a few rows (metrics, a confusion matrix) computed once and held as literal rows of the plan."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
