"""CSV files with quoted line breaks, read by many tasks per file.

``multiLine`` gives a whole file to one task because a reader that starts in
the middle cannot know whether it stands inside quotes.  Here the file is
read as lines, by splits as any text file, and the quotes are counted first:

1. every split tells, in one row, whether it holds an odd number of quotes and
   how many records it opens if it starts outside or inside quotes;
2. a running sum over these rows (one a split) settles how each split starts;
3. a line that starts outside quotes and closes its own is a record as it
   stands and moves nowhere; only the lines of records over several lines are
   brought together, by the place where the record opens, and joined again.

A record may reach into the next split.  One that is longer than a split, or
than ``max_record_bytes`` (an unclosed quote swallows what follows), is not
put together: each of its lines comes back as a malformed record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _marked(quote: str):
    """Batches of lines -> (first row, last row, per-line marks) of each run of one split, carried from batch to batch."""
    def runs(batches):
        key, seq, inside, opens = None, 0, 0, np.zeros(2, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            odd = pc.bit_wise_and(pc.count_substring(b.column("value"), quote), 1).to_numpy(zero_copy_only=False).astype(np.int64)
            file, block = b.column("file"), b.column("block").to_numpy()
            new = np.flatnonzero(pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
                                 | (block[1:] != block[:-1])) + 1
            for i, j in zip(np.r_[0, new], np.r_[new, b.num_rows]):
                here = (file[int(i)].as_py(), int(block[i]))
                if here != key:
                    key, seq, inside, opens = here, 0, 0, np.zeros(2, np.int64)
                o = odd[i:j]
                before = (np.cumsum(o) - o + inside) & 1
                opened = np.cumsum(np.stack([(before == 0) & (o == 1), (before == 1) & (o == 1)], 1), axis=0) + opens
                yield key, b, int(i), int(j), seq + np.arange(j - i), before, o, opened
                seq, inside, opens = seq + j - i, (inside + int(o.sum())) & 1, opened[-1]

    return runs


def _summaries(quote: str):
    """One row a split: is its number of quotes odd, and how many records does it open from either start."""
    def run(batches):
        last, row = None, None
        for key, _, _, _, _, before, odd, opened in _marked(quote)(batches):
            if last is not None and key != last:
                yield row
            last = key
            row = pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([int(before[-1] ^ odd[-1])], pa.int64()),
                 pa.array([int(opened[-1, 0])], pa.int64()), pa.array([int(opened[-1, 1])], pa.int64())],
                ["file", "block", "odd", "opens0", "opens1"])
        if row is not None:
            yield row

    return run


def _placed(quote: str):
    """Every line with its number in its split, whether it starts inside quotes relative to the split's start, whether
    it holds an odd number of them, and the number of records opened up to it from either start."""
    def run(batches):
        for _, b, i, j, seq, before, odd, opened in _marked(quote)(batches):
            part = b.slice(i, j - i)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(seq), pa.array(before), pa.array(odd), pa.array(opened[:, 0]), pa.array(opened[:, 1])],
                [*part.schema.names, "seq", "before", "odd", "opened0", "opened1"])

    return run


def csv_records(spark: SparkSession, path, quote: str = '"', header: bool = True, max_record_bytes: int = 16 << 20) -> DataFrame:
    """(record, whole): every record's text; ``whole`` is false for a line that could not be put into one."""
    lines = _lines(spark, path)
    splits = lines.mapInArrow(_summaries(quote), "file string, block long, odd long, opens0 long, opens1 long")
    order = Window.partitionBy("file").orderBy("block")                      # one row a split
    inside = F.coalesce(F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    splits = splits.withColumn("inside", inside).withColumn("opens", F.when(F.col("inside") == 1, F.col("opens1")).otherwise(F.col("opens0")))
    splits = splits.select("file", "block", "inside", F.lag("block").over(order).alias("prev_block"), F.lag("opens").over(order).alias("prev_opens"))
    placed = lines.mapInArrow(_placed(quote), "value string, file string, block long, seq long, before long, odd long, opened0 long, opened1 long")
    at = placed.join(F.broadcast(splits), ["file", "block"])                 # bound: one row a split of the files
    at = at.withColumn("starts_inside", F.col("before").bitwiseXOR(F.col("inside")) == 1).withColumn(
        "opened", F.when(F.col("inside") == 1, F.col("opened1")).otherwise(F.col("opened0")))
    if header:
        at = at.where(~((F.col("block") == 0) & (F.col("seq") == 0)))
    alone = at.where(~F.col("starts_inside") & (F.col("odd") == 0)).select(F.col("value").alias("record"), F.lit(True).alias("whole"))
    pieces = at.where(F.col("starts_inside") | (F.col("odd") == 1))
    carried = F.col("starts_inside") & (F.col("opened") == 0)                # opened in the split before
    pieces = pieces.withColumns({
        "at_block": F.when(carried, F.col("prev_block")).otherwise(F.col("block")),
        "at_open": F.when(carried, F.col("prev_opens")).otherwise(F.col("opened"))})
    known = F.coalesce(F.col("at_open") > 0, F.lit(False))
    key = ["file", "at_block", "at_open"]
    sized = pieces.where(known).withColumn("bytes", F.sum(F.octet_length("value") + 1).over(Window.partitionBy(*key)))
    joined = (sized.where(F.col("bytes") <= max_record_bytes).groupBy(*key)
              .agg(F.array_sort(F.collect_list(F.struct("block", "seq", "value", "odd", "starts_inside"))).alias("p"))
              .select(F.array_join(F.col("p.value"), "\n").alias("record"),
                      F.exists("p", lambda x: x["starts_inside"] & (x["odd"] == 1)).alias("whole")))       # it is closed
    lost = pieces.where(~known).select("value").unionByName(sized.where(F.col("bytes") > max_record_bytes).select("value"))
    every = alone.unionByName(joined).unionByName(lost.select(F.col("value").alias("record"), F.lit(False).alias("whole")))
    return every.withColumn("record", F.when(F.col("record").endswith("\r"), F.substring("record", F.lit(1), F.length("record") - 1))
                            .otherwise(F.col("record"))).where(F.length("record") > 0)


def read_csv_records(spark: SparkSession, path, schema: T.StructType, corrupt_col: str | None = None, header: bool = True,
                     max_record_bytes: int = 16 << 20, **options) -> DataFrame:
    """A CSV table of ``schema`` whose quoted fields may hold line breaks, in parallel over the splits of its files.
    Values that do not parse are NULL; ``corrupt_col`` then holds the record's text (NULL for a good one)."""
    options = {"escape": '"', "mode": "PERMISSIVE", **options}
    corrupt = corrupt_col or "_corrupt"
    full = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema.fields], T.StructField(corrupt, T.StringType())])
    records = csv_records(spark, path, options.get("quote", '"'), header, max_record_bytes)
    row = F.from_csv("record", full.toDDL(), {**options, "columnNameOfCorruptRecord": corrupt})
    parsed = records.select("record", "whole", row.alias("r"))
    cols = [F.when(F.col("whole"), F.col("r")[f.name]).alias(f.name) for f in schema.fields]
    if corrupt_col:
        cols.append(F.when(F.col("whole"), F.col("r")[corrupt]).otherwise(F.col("record")).alias(corrupt_col))
    return parsed.select(*cols)
