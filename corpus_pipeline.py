"""Corpus pipeline: toxicity filter, near-duplicates, repeated passages, packing.

Each stage works on all its predecessor kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsight.llm.packing import pack_documents
from callsight.llm.repeats import remove_repeats, whole_characters  # noqa: F401 (the rule of the cuts, for callers)
from callsight.llm.simhash import near_duplicates
from callsight.llm.toxicity import score, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go; ids, texts and all else stay as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    some = docs.select(COLUMNS).withColumn("has_text", F.col("text").isNotNull())
    scored = score(some, train(docs, labels, docs), keep=["doc_id", "lang", "source", "n_chars", "has_text"], with_text=True)
    text = F.when(F.col("row.has_text"), F.col("text").cast("string")).alias("text")
    return scored.where("score < 0.5").select("row.doc_id", text, "row.lang", "row.source", "row.n_chars")


def near_duplicate_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at 3 or fewer fingerprint bits the document with the smallest id stays, once; rows that
    share an id but not the text are told apart by the text's hash.  Documents with a NULL id are in no group and stay."""
    key = F.struct("doc_id", F.coalesce(F.length("text"), F.lit(-1)).alias("n"), F.xxhash64("text").alias("h"))
    keyed = docs.select(COLUMNS).withColumn("key", key)
    found = near_duplicates(keyed.where("doc_id is not null"), id_col="key", shingle_words=3, max_bits=3)
    first = found.groupBy("component_id").agg(F.lit(1)).select(F.col("component_id").alias("key"))
    kept = keyed.join(first, "key", "left_semi").dropDuplicates(["key"]).select(COLUMNS)
    return kept.unionByName(docs.select(COLUMNS).where("doc_id is null"))


def repeated_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document with a smaller id holds are cut out; bytes of a character cut in
    part go with it, all others stay as they are.  ``n_chars`` follows; a NULL text stays NULL."""
    some = docs.select(COLUMNS).withColumn("has_text", F.col("text").isNotNull())
    whole = remove_repeats(some, keep=["doc_id", "lang", "source", "has_text"], characters=True)
    out = whole.select("row.doc_id", F.when(F.col("row.has_text"), F.col("kept").cast("string")).alias("text"), "row.lang", "row.source")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens: one row per piece."""
    out = pack_documents(docs, keep=["doc_id"])
    return out.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicate_documents), ("repeats", repeated_passages),
          ("packing", packing)]

ORACLE_SQL = None        # learned scores, tokens and byte-level cuts are not SQL-expressible; tests use brute force


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet into the shared checkpoint folder and read again."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="callsight-")
    folder = f"{folder}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
