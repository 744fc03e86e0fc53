"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` equal cells.  Every shard owns ``virtual_nodes``
pseudo-random cells; a key belongs to the first owned cell at or after its
own cell (clockwise).  A shard takes at most its capacity; keys beyond it
continue clockwise to the next shard with room.  Capacities are the row
count divided as evenly as whole numbers allow, so shard sizes differ by at
most one row, and a row leaves its home shard only when that is full.

Only counts per ring arc reach the driver (at most shards x virtual_nodes
numbers, whatever the table's size); all rows stay in native DataFrame
expressions: one pre-aggregation by key, one window per arc, two broadcast
joins with tables of fixed bound (ring cells, and arc pieces).

Defined cases: a NULL id or text hashes like an empty one; repeated equal
rows take consecutive slots; an empty table gives an empty result; the
caller's columns are not touched because only ``key`` columns are read.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import checkpointed


def ring(shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """Virtual nodes as (cell, shard) in clockwise order; a cell wanted twice goes to the smaller hash."""
    best: dict[int, tuple[str, int]] = {}
    for s in range(shards):
        for v in range(virtual_nodes):
            h = hashlib.md5(f"{s}/{v}".encode()).hexdigest()
            cell = int(h[:8], 16) % cells
            if cell not in best or (h, s) < best[cell]:
                best[cell] = (h, s)
    return sorted((c, s) for c, (_, s) in best.items())


def place(counts: list[int], owners: list[int], shards: int) -> list[list[tuple[int, int, int]]]:
    """Pieces of every arc as (first rank, shard, first slot).

    ``counts[a]`` keys wait in arc ``a``, whose clockwise end is owned by
    ``owners[a]``.  Step 0 offers every arc to its own node, step k to the
    k-th next one; a full shard passes the rest on.
    """
    total, n = sum(counts), len(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    pieces: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    waiting = deque((a, 0, c) for a, c in enumerate(counts) if c)
    step = 0
    while waiting:
        for _ in range(len(waiting)):
            a, rank, left = waiting.popleft()
            s = owners[(a + step) % n]
            take = min(left, room[s] - used[s])
            if take:
                pieces[a].append((rank, s, used[s]))
                used[s] += take
            if left > take:
                waiting.append((a, rank + take, left - take))
        step += 1
    return pieces


def _rows_of(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table from driver values, as one native JSON literal."""
    kinds = ", ".join(f"{n}: bigint" for n in names)
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kinds}>>")))


def shard(spark, keys: DataFrame, shards: int, *, virtual_nodes: int = 128, cells: int = 65536) -> DataFrame:
    """``keys`` plus ``shard`` and ``slot`` (gapless from 0 in each shard).

    Every column of ``keys`` takes part in the ring position, so pass ids and
    digests, not texts.  Rows equal in all columns share one ring position.
    """
    names = [c for c in keys.columns]
    h = F.xxhash64(*[keys[f"`{c}`"] for c in names])
    grouped = (keys.select(*[keys[f"`{c}`"].alias(f"k{i}") for i, c in enumerate(names)], h.alias("h"))
               .groupBy(*[f"k{i}" for i in range(len(names))], "h").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("cell", F.pmod(F.col("h"), F.lit(cells)))).drop("h")
    nodes = ring(shards, virtual_nodes, cells)
    arcs, a = [], 0
    for cell in range(cells):
        while a < len(nodes) and nodes[a][0] < cell:
            a += 1
        arcs.append(a % len(nodes))
    # bound: one row per ring cell
    arc_of = spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(arcs)), "array<int>")).alias("cell", "arc"))
    # digests only, written once so that the texts are read once
    in_arcs = checkpointed(grouped.join(F.broadcast(arc_of), "cell"))
    counts = [0] * len(nodes)
    for r in in_arcs.groupBy("arc").agg(F.sum("n").alias("n")).collect():   # at most len(nodes) rows
        counts[r["arc"]] = r["n"]
    pieces = place(counts, [s for _, s in nodes], shards)
    flat = []
    for arc, own in enumerate(pieces):
        for i, (rank, s, slot) in enumerate(own):
            end = own[i + 1][0] if i + 1 < len(own) else counts[arc]
            flat.append((arc, rank, end, s, slot))
    piece_of = _rows_of(spark, flat, ["arc", "lo", "hi", "shard", "base"])
    order = Window.partitionBy("arc").orderBy(F.xxhash64(*[F.col(f"k{i}") for i in range(len(names))], F.lit(1)),
                                              *[f"k{i}" for i in range(len(names))])
    ranked = in_arcs.withColumn("first", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    single = (ranked.withColumn("rank", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
              .withColumn("arc", F.col("arc").cast("long")))
    # bound: pieces <= arcs + full shards met on the way, counted on the driver above
    joined = single.join(F.broadcast(piece_of), (single["arc"] == piece_of["arc"])
                         & (single["rank"] >= piece_of["lo"]) & (single["rank"] < piece_of["hi"]))
    return joined.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)],
                         F.col("shard").cast("int").alias("shard"),
                         (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))


def document_keys(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text, NULL: none, plus 8) and ``text_crc32``."""
    raw = F.coalesce(docs["text"], F.lit(""))
    return docs.select("doc_id", (F.octet_length(raw).cast("long") + 8).alias("size"),
                       F.crc32(F.encode(raw, "UTF-8")).alias("text_crc32"))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents into shards 0..23, law ``rows``: counts at most one apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = shard(spark, document_keys(docs), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
