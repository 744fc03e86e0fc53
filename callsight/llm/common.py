"""Shared helpers of the corpus operators.

Rows travel through Arrow functions as one struct column ``row`` holding the
caller's columns, so an operator's own columns never clash with them.
Everything that runs in a task handles an Arrow batch with numpy, in blocks
of about ``BLOCK_BYTES`` of text, so memory does not follow the table.
"""

from __future__ import annotations

import tempfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20
SMALL_BLOCK = 1 << 18           # where a task holds large tables beside its texts


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that ``spark.checkpoint.dir`` names.
    Only a local session without that setting gets a temporary folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="callsight-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def as_rows(df: DataFrame, keep: list[str] | None = None, text_col: str | None = None) -> DataFrame:
    """``row`` = struct of the kept columns (all by default); ``text`` = the text as bytes, NULL as empty."""
    names = df.columns if keep is None else keep
    cols = [F.struct(*[df[f"`{c}`"] for c in names]).alias("row")]
    if text_col is not None:
        cols.append(F.coalesce(df[f"`{text_col}`"].cast("binary"), F.lit(b"")).alias("text"))
    return df.select(*cols)


def row_schema(df: DataFrame, **more: T.DataType) -> T.StructType:
    """Schema of a frame made by :func:`as_rows`: its ``row`` plus result columns."""
    return T.StructType([df.schema["row"]] + [T.StructField(k, v) for k, v in more.items()])


def bytes_view(column) -> tuple[np.ndarray, np.ndarray]:
    """Arrow binary/string column -> (bytes, offsets) without copying; offsets has one more entry than rows."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.binary())
    if pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type):
        kind = np.int64
    else:
        kind = np.int32
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if "binary" in str(arr.type) else "")
    _, offsets, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, dtype=kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES):
    """Row ranges [i, j) of at most ``limit`` bytes of text each (one longer row alone)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_bytes(keep) -> np.ndarray:
    """Lookup table of 256 booleans: which bytes belong to a word."""
    return np.array([bool(keep(b)) for b in range(256)])


def lower_ascii() -> np.ndarray:
    """Lookup table of 256 bytes: A-Z to a-z, everything else as it is."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
    """Starts, ends and row index of every maximal run of word bytes; runs never cross rows.
    ``off`` is relative to ``data``."""
    n = len(data)
    w = np.zeros(n + 2, bool)
    w[1:-1] = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[off[(off >= 0) & (off <= n)]] = True
    starts = np.flatnonzero(w[1:-1] & (~w[:-2] | edge[:-1]))
    ends = np.flatnonzero(w[1:-1] & (~w[2:] | edge[1:])) + 1
    rows = np.searchsorted(off, starts, side="right") - 1
    return starts, ends, rows


MULTIPLIER = 0xD6E8FEB86659FD93
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes (equal bytes, equal hash): differences of one running polynomial sum."""
    n = len(data)
    if n == 0 or len(starts) == 0:
        return np.zeros(len(starts), np.uint64)
    if n <= BLOCK_BYTES:
        power, inverse = _block_powers(SMALL_BLOCK if n <= SMALL_BLOCK else BLOCK_BYTES)
    else:
        power, inverse = _powers(MULTIPLIER, n), _powers(INVERSE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * inverse[starts])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


@lru_cache(maxsize=2)
def _block_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers for a block of text, made once a process."""
    return _powers(MULTIPLIER, size), _powers(INVERSE, size)

