"""SimHash near-duplicates by segment bit counts.

Fingerprint: words are runs outside ASCII white space of the text with A-Z
lower-cased, shingles are ``shingle_words`` words joined by one blank, with
repeats (fewer words: the whole sequence; none: fingerprint zero).  A bit is
set if it is set in more than half of the shingles' XXH64 values (seed 42).

Links (at most ``max_bits`` differing bits) come from an embedding of the
fingerprint into bit counts: 32 segments of two bits, each replaced by its
count 0, 1 or 2.  The Manhattan distance of two such vectors never exceeds
the Hamming distance, so points further apart than ``max_bits`` cannot link.
The grid: the segments form ``max_bits + 3`` groups; two points at Manhattan
distance ``max_bits`` or less agree in all counts of at least three groups,
so they meet in the grid cell of some triple of groups.  Within a cell the
Manhattan distance is tested first, then the exact Hamming distance.

Counts are kept in unary (0: 00, 1: 01, 2: 11), which makes the Manhattan
distance the popcount of a XOR.

Equal fingerprints are collapsed before anything is joined, whatever their
number.  A cell of more than ``dense`` fingerprints is dealt out again by
groups of the exact bits (same argument, every pair still meets), and what
is left is compared in slices; a cell emits a spanning forest of its links,
never all pairs.

Defined cases: NULL or empty or white-space texts have fingerprint zero and
link like any other; very long texts are read whole; repeated rows keep one
row each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import as_rows, bytes_view, checkpointed, row_schema
from .components import connected_components
from pyspark.sql import types as T

SEED = 42


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = text.lower().split()        # bytes: lower() and split() know ASCII only
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.fromiter((digest(join(words[i:i + shingle_words]), SEED) for i in range(n)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, *, text_col: str = "text", shingle_words: int, keep=None) -> DataFrame:
    """``row`` (the kept columns) and ``fp``, the fingerprint as a signed long."""
    src = as_rows(docs, keep, text_col)

    def run(batches):
        for b in batches:
            data, off = bytes_view(b.column("text"))
            raw = data.tobytes() if len(off) > 1 else b""
            fps = [fingerprint(raw[off[i]:off[i + 1]], shingle_words) for i in range(len(off) - 1)]
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("row"), fp], ["row", "fp"])

    return src.mapInArrow(run, row_schema(src, fp=T.LongType()))


def unary_counts(x):
    """Two-bit segments with their bits sorted: equal counts, equal segments (native column)."""
    low = 0x5555555555555555
    up = F.shiftrightunsigned(x, 1)
    some = x.bitwiseOR(up).bitwiseAND(F.lit(low))
    both = x.bitwiseAND(up).bitwiseAND(F.lit(low))
    return some.bitwiseOR(F.shiftleft(both, 1))


def group_masks(groups: int, unit: int = 2) -> list[int]:
    """64 bits cut into ``groups`` runs of whole segments; one mask (signed) per triple of groups."""
    segs = 64 // unit
    cuts = [round(i * segs / groups) * unit for i in range(groups + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = []
    for picked in combinations(single, 3):
        m = 0
        for x in picked:
            m |= x
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _cells(points: DataFrame, value, masks: list[int], extra=()) -> DataFrame:
    """One row per point and grid: ``cell`` is the hash of grid number and masked value."""
    grids = F.array(*[F.xxhash64(*extra, F.lit(i), value.bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    return points.select("fp", F.explode(grids).alias("cell"))


def _links_in_cells(batches, max_bits: int):
    """Sorted (cell, fp) batches -> spanning links of every cell."""
    held_c, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for b in batches:
        c = np.concatenate([held_c, b.column("cell").to_numpy(zero_copy_only=False)])
        f = np.concatenate([held_f, b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
        last = int(np.searchsorted(c, c[-1])) if len(c) else 0     # the last cell may go on
        held_c, held_f = c[last:], f[last:]
        yield from _forest(c[:last], f[:last], max_bits)
    yield from _forest(held_c, held_f, max_bits)


def _forest(c: np.ndarray, f: np.ndarray, max_bits: int, step: int = 1 << 20):
    low = np.uint64(0x5555555555555555)
    one = np.uint64(1)
    e = ((f | (f >> one)) & low) | (((f & (f >> one)) & low) << one)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    forest_a, forest_b = [], []
    gap, live = 1, np.arange(len(c))
    while True:
        live = live[live + gap < len(c)]
        live = live[c[live] == c[live + gap]]
        if not len(live):
            break
        for s in range(0, len(live), step):
            i = live[s:s + step]
            j = i + gap
            near = np.bitwise_count(e[i] ^ e[j]) <= max_bits          # Manhattan: a lower bound
            i, j = i[near], j[near]
            near = np.bitwise_count(f[i] ^ f[j]) <= max_bits          # exact
            for x, y in zip(f[i[near]].tolist(), f[j[near]].tolist()):
                p, q = root(x), root(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    forest_a.append(x)
                    forest_b.append(y)
        gap += 1
    if forest_a:
        yield pa.RecordBatch.from_arrays([pa.array(np.array(forest_a, np.uint64).view(np.int64)),
                                          pa.array(np.array(forest_b, np.uint64).view(np.int64))], ["a", "b"])


def fingerprint_links(points: DataFrame, *, max_bits: int, dense: int = 4096) -> DataFrame:
    """Distinct fingerprints (column ``fp``) -> links (a, b) that connect exactly what links at
    ``max_bits`` or fewer differing bits connect."""
    masks = group_masks(max_bits + 3)
    fp = F.col("fp")
    cells = _cells(points, unary_counts(fp), masks)
    sized = cells.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("cell"))).where("n > 1")
    sized = checkpointed(sized)
    rare = sized.where(F.col("n") <= dense).select("cell", "fp")
    hot = sized.where(F.col("n") > dense).select("cell", "fp")
    again = _cells(hot, fp, group_masks(max_bits + 3, unit=1), extra=(F.col("cell"),))
    both = rare.unionAll(again.select("cell", "fp"))
    dealt = both.repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(lambda bs: _links_in_cells(bs, max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) and ``component_id``: the smallest id reachable over links."""
    prints = with_fingerprints(docs, text_col=text_col, shingle_words=shingle_words, keep=[id_col])
    prints = checkpointed(prints.select(F.col(f"row.`{id_col}`").alias("doc_id"), "fp"))
    points = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(fingerprint_links(points.select("fp"), max_bits=max_bits))
    at = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = at.groupBy("root").agg(F.min("least").alias("component_id"))
    component = at.join(of_root, "root").select("fp", "component_id")
    return prints.join(component, "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs, shingle_words=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
