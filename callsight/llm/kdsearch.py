"""Exact top-k inner products with KD-trees per shard.

Each shard (a hash bucket of the rows) builds a KD-tree by median splits on
the widest dimension down to ``leaf`` rows; every leaf keeps its tight
bounding box.  The largest inner product a box can give a query is the sum
over dimensions of the larger of query x lower and query x upper bound.  A
query visits leaves best bound first and stops at the first bound below its
k-th score so far (equal bounds are visited, since ties go to the smaller
id).  The k-th score is propagated: a first pass over one shard gives each
query a valid k-th score, which travels with the query to all other shards.

Queries travel in blocks to every shard (a stated query set against all
rows); a shard returns at most k rows per query and only those that reach
the propagated score; the best k of them are kept per query.

Defined cases: vectors that are NULL or hold NULL or non-finite components
take no part; rows with a NULL id neither; vectors of another length than
the query's never meet it; fewer than k candidates are all returned; ties go
to the smaller id; rows repeated under one id are candidates each.  Scores
beyond what doubles hold exactly are computed with exact integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def build(v: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Row numbers of each leaf: median splits on the dimension of largest extent."""
    out, todo = [], [np.arange(len(v))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        x = v[rows]
        d = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
        half = len(rows) // 2
        by = np.argpartition(x[:, d], half)
        todo += [rows[by[:half]], rows[by[half:]]]
    return out


def top(ids: np.ndarray, v: np.ndarray, qids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, leaf: int):
    """Best k (query, id, score) of one shard's rows; ``floor`` is a score each query's k-th reaches anyway."""
    exact = v.dtype == object
    leaves = build(v.astype(float), leaf)
    lo = np.stack([v[r].min(axis=0) for r in leaves])
    hi = np.stack([v[r].max(axis=0) for r in leaves])
    up = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T                  # box-to-query bounds
    order = np.argsort(-up.astype(float), axis=1, kind="stable")
    best = [[] for _ in qids]
    kth = floor.copy()
    for step in range(len(leaves)):
        at = order[:, step]
        live = np.flatnonzero(up[np.arange(len(qids)), at] >= kth) if not exact else np.arange(len(qids))
        if not len(live):
            break                                                            # best-first: no later bound is larger
        for n in np.unique(at[live]):
            who = live[at[live] == n]
            rows = leaves[n]
            s = q[who] @ v[rows].T
            for a, query in enumerate(who):
                ok = (s[a] >= kth[query]) & (ids[rows] != qids[query])
                if not ok.any():
                    continue
                best[query] += list(zip((-s[a][ok]).tolist(), ids[rows][ok].tolist()))
                best[query].sort()
                del best[query][k:]
                if len(best[query]) == k:
                    kth[query] = max(kth[query], -best[query][-1][0])
    return [(int(qids[a]), int(i), int(-s)) for a, own in enumerate(best) for s, i in own]


def _matrix(column, dim: int) -> np.ndarray:
    v = column.values if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    m = np.asarray(v, dtype=np.float64).reshape(-1, dim)
    if m.size and np.abs(m).max() ** 2 * dim >= 2.0 ** 53:
        return np.array([[int(x) for x in r] for r in m], dtype=object)
    return m


def _search(rows: DataFrame, queries: DataFrame, k: int, leaf: int) -> DataFrame:
    """``rows`` (shard, dim, id, v) against ``queries`` (shard, dim, id, v, floor) of the same shard."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            dim = left.column("v_dim")[0].as_py()
            v, q = _matrix(left.column("v"), dim), _matrix(right.column("v"), dim)
            if object in (v.dtype, q.dtype):
                v, q = v.astype(object), q.astype(object)
                floor = np.array([int(x) if np.isfinite(x) else -(1 << 200) for x in right.column("floor").to_numpy()], object)
            else:
                floor = right.column("floor").to_numpy().astype(float)
            ids, qids = left.column("id").to_numpy(), right.column("id").to_numpy()
            for a in range(0, len(qids), 512):                               # blocks of queries
                found += top(ids, v, qids[a:a + 512], q[a:a + 512], floor[a:a + 512], k, leaf)
        cols = list(zip(*found)) if found else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    queries = queries.toDF("to_shard", "q_dim", "id", "v", "floor")
    rows = rows.select(F.col("shard").alias("of_shard"), F.col("dim").alias("v_dim"), "id", "v").toDF("of_shard", "v_dim", "id", "v")
    return (rows.groupBy("of_shard", "v_dim").cogroup(queries.groupBy("to_shard", "q_dim"))
            .applyInArrow(run, "query_id long, vec_id long, score long"))


def top_k(vectors: DataFrame, is_query, *, k: int = 5, scale: int = 256, rows_per_shard: int = 4096, leaf: int = 64) -> DataFrame:
    """``vectors`` (id, embedding) -> query_id, rank, vec_id, score; ``is_query`` is a condition on ``id``."""
    x = F.transform("embedding", lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("double"))
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    ready = vectors.where(F.col("id").isNotNull() & F.col("embedding").isNotNull() & fine & (F.size("embedding") > 0)).select(
        F.col("id").cast("long").alias("id"), F.size("embedding").alias("dim"), x.alias("v"))
    shards = max(1, -(-vectors.count() // rows_per_shard))
    rows = ready.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    asked = ready.where(is_query).select(*[F.col(c).alias(c) for c in ready.columns])
    none = F.lit(float("-inf"))
    first = _search(rows.where("shard = 0"), asked.select(F.lit(0).alias("shard"), "dim", "id", "v", none.alias("floor")), k, leaf)
    kth = (first.groupBy("query_id").agg(F.min("score").cast("double").alias("least"), F.count(F.lit(1)).alias("n"))
           .where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("least")))
    primed = asked.join(kth, "id", "left").withColumn("floor", F.coalesce("least", none))
    everywhere = primed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select("shard", "dim", "id", "v", "floor")
    found = _search(rows, everywhere, k, leaf)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_search(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(e.select(F.col("vec_id").alias("id"), "embedding"), F.col("id") % 50 == 0)
