"""Hard negatives with cover trees over norm-augmented vectors.

A vector x becomes (x, sqrt(M^2 - |x|^2)) with M the largest norm around and
an anchor q becomes (q, 0): then |q' - x'|^2 = |q|^2 + M^2 - 2 <q, x>, so a
ball of radius r about a centre c bounds every inner product in it from both
sides by the distance |q' - c'| -+ r.

The top of the cover tree are at most ``pivots`` centres chosen farthest
first from a bounded sample; each row belongs to the nearest one, and a cell
of many rows is dealt by a salt into shards of about ``shard_bytes``.  Below,
each shard has its own cover tree: one farthest-first pass gives nested,
separated centres, those farther apart than ``s / base**level`` form a level,
and each node keeps its exact covering radius and its range of labels.

Two searches per anchor go the same way: first its positives (best rows of
its own label), then for each positive the best rows of other labels inside
the score window.  An anchor is first sent to one shard of its own cell,
which gives it a k-th score that surely is reached; with that floor (or the
window) it goes to the shards of all cells whose bounds meet it.  In a
shard it descends level by level, drops nodes whose bounds miss the window,
takes leaves best bound first and verifies their rows by exact products.
Anchors come in groups of about ``group`` a shard, so a task holds one tree
and one group.

Defined cases: rows with a NULL id or label, a NULL or empty vector or a NULL
or non-finite component take no part; vectors of another length never meet;
repeated anchor rows count once, repeated candidates each, never against
their own id; ties go to the smaller id; a positive below 0 has an empty
window; products beyond what doubles hold are computed with whole numbers
(beyond long: an error).  Anchors without positives have no rows; an empty
table gives none.  Other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import checkpointed

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
SLACK = 1e-9                     # of the squared norms: rounding of the bounds
EXACT = 2.0 ** 53


def farthest_first(x: np.ndarray, most: int):
    """Centres, their distance to the earlier ones when chosen, and each point's centre."""
    centres, gaps, who = [0], [np.inf], np.zeros(len(x), np.int64)
    far = np.sqrt(((x - x[0]) ** 2).sum(1))
    while len(centres) < most:
        j = int(np.argmax(far))
        if not far[j] > 0:
            break
        gaps.append(far[j])
        d = np.sqrt(((x - x[j]) ** 2).sum(1))
        who[d < far] = len(centres)
        centres.append(j)
        far = np.minimum(far, d)
    return np.array(centres), np.array(gaps), who


def augmented(v: np.ndarray, m2: float) -> np.ndarray:
    return np.column_stack([v, np.sqrt(np.maximum(m2 - (v * v).sum(1), 0))])


def build(ids: np.ndarray, labels: np.ndarray, v: np.ndarray, leaf: int = 64, base: float = 1.3) -> dict:
    """Cover tree of one shard.  Level arrays hold (parent, radius, smallest label, largest label) of its nodes;
    nodes of a level are the first centres in farthest-first order."""
    m2 = float((v * v).sum(1).max())
    x = augmented(v, m2)
    centres, gaps, who = farthest_first(x, max(1, -(-len(v) // leaf)))
    sizes, s = [1], gaps[1] if len(gaps) > 1 else 0.0
    while sizes[-1] < len(centres):
        s /= base
        n = int((gaps > s).sum())
        if n > sizes[-1]:
            sizes.append(n)
    levels, at = [], who
    for k in range(len(sizes) - 1, -1, -1):
        n = sizes[k]
        if k < len(sizes) - 1:                        # hang the finer level's nodes on the nearest centre of this one
            fine = x[centres[:sizes[k + 1]]]
            near = np.stack([((fine - x[c]) ** 2).sum(1) for c in centres[:n]], 1).argmin(1)
            near[:n] = np.arange(n)
            levels[-1] = (near, *levels[-1][1:])
            at = near[at]
        radius, low, high = np.zeros(n), np.full(n, HIGHEST), np.full(n, LOWEST)
        np.maximum.at(radius, at, np.sqrt(((x - x[centres[at]]) ** 2).sum(1)))
        np.minimum.at(low, at, labels)
        np.maximum.at(high, at, labels)
        levels.append((None, radius, low, high))
    by = np.argsort(who, kind="stable")
    return {"ids": ids[by], "labels": labels[by], "v": v[by], "m2": m2, "centres": x[centres], "levels": levels[::-1],
            "ends": np.searchsorted(who[by], np.arange(len(centres) + 1))}


def ball_bounds(q: np.ndarray, centres: np.ndarray, m2: float):
    """A function radii -> (lower, upper) bounds of the anchors' inner products with all points that lie within the
    radii about the first centres.  Where doubles overflow nothing is bounded."""
    with np.errstate(all="ignore"):
        total = ((q * q).sum(1) + m2)[:, None]
        d = np.sqrt(np.maximum(total - 2 * q @ centres[:, :-1].T, 0))

    def bounds(radius):
        with np.errstate(all="ignore"):
            near, far = np.maximum(d[:, :len(radius)] - radius, 0), d[:, :len(radius)] + radius
            lower, upper = (total - far ** 2) / 2 - SLACK * total, (total - near ** 2) / 2 + SLACK * total
        return np.where(np.isnan(lower), -np.inf, lower), np.where(np.isnan(upper), np.inf, upper)

    return bounds


def search(tree: dict, q, own, label, low, high, k: int, same: bool):
    """(query row, candidate id, score) of each query's best ``k`` rows with a score in [low, high]."""
    v, ids, labels = tree["v"], tree["ids"], tree["labels"]
    whole = np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * v.shape[1] < EXACT
    leaves = len(tree["ends"]) - 1
    if whole:
        floor, top = low.astype(float), high.astype(float)
        bounds = ball_bounds(q, tree["centres"], tree["m2"])
        live = np.ones((len(q), 1), bool)
        for n, (parent, radius, first, last) in enumerate(tree["levels"]):
            lower, upper = bounds(radius)
            live = live[:, parent] if n else live
            one = (first == last) & (first == label[:, None])
            fits = (first <= label[:, None]) & (label[:, None] <= last) if same else ~one
            live = live & fits & (upper >= floor[:, None]) & (lower <= top[:, None])
        upper = np.where(live, upper, -np.inf)
    else:                                             # whole numbers beyond doubles: every leaf is verified
        v, q = (np.array([[int(x) for x in r] for r in m], object).reshape(m.shape) for m in (v, q))
        floor, top, upper = low.astype(object), high.astype(object), np.full((len(q), leaves), np.inf)
    best = np.full((len(q), k), -np.inf).astype(floor.dtype)
    found = []
    for n in np.argsort(-upper.max(axis=0), kind="stable"):
        some = np.flatnonzero((upper[:, n] >= floor) & (upper[:, n] > -np.inf))
        rows = slice(tree["ends"][n], tree["ends"][n + 1])
        if not len(some) or rows.start == rows.stop:
            continue
        s = q[some] @ v[rows].T
        ok = ((s >= floor[some, None]) & (s <= top[some, None]) & (ids[rows] != own[some, None])
              & ((labels[rows] == label[some, None]) == same)).astype(bool)
        a, b = np.nonzero(ok)
        if len(a):
            found.append((some[a], ids[rows][b], s[a, b]))
            best[some] = np.sort(np.column_stack([best[some], np.where(ok, s, -np.inf)]), axis=1)[:, -k:]
            floor[some] = np.maximum(floor[some], best[some, 0])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, cand, s = (np.concatenate(c) for c in zip(*found))
    keep = s >= floor[row]
    row, cand, s = row[keep], cand[keep], np.array([int(y) for y in s[keep]], np.int64)
    by = np.lexsort((cand, -s, row))
    row, cand, s = row[by], cand[by], s[by]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], cand[rank < k], s[rank < k]


def _packed(m: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values: 4 bytes a component where they fit, else 8."""
    m = np.ascontiguousarray(m.astype("<i4") if np.abs(m).max(initial=0) < 2 ** 31 else m.astype("<f8"))
    step = m.shape[1] * m.itemsize
    return pa.array([m.data.cast("B")[i:i + step].tobytes() for i in range(0, m.nbytes, step)], pa.binary())


def _matrix(column, dim: int) -> np.ndarray:
    raw = column.to_pylist()
    return np.stack([np.frombuffer(b, "<i4" if len(b) == 4 * dim else "<f8") for b in raw]).astype(float) if raw else np.zeros((0, dim))


def _by_length(batch, name: str = "dim"):
    dims = batch.column(name).to_numpy(zero_copy_only=False)
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


def _cells(ready: DataFrame, tops: dict, most_m2: dict) -> DataFrame:
    """``ready`` with packed vectors, each row's cell (-1: no pivot of its length), distance to its pivot, and a salt."""
    def run(batches):
        done = 0
        for whole in batches:
            for d, b in _by_length(whole):
                v = np.asarray(b.column("v").flatten(), float).reshape(-1, d)
                if d in tops:
                    x = augmented(v, most_m2[d])
                    near = [np.sqrt(((x - c) ** 2).sum(1)) for c in tops[d]]
                    cell = np.argmin(np.stack(near, 1), 1)
                    dist = np.min(np.stack(near, 1), 1)
                else:
                    cell, dist = np.full(len(v), -1), np.zeros(len(v))
                salt = (np.arange(done, done + len(v)) * 2654435761) & 0x7FFFFFFF
                done += len(v)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("label"), b.column("dim"), _packed(v), pa.array(cell.astype(np.int32)),
                     pa.array(dist), pa.array(salt.astype(np.int32))], ["id", "label", "dim", "v", "cell", "dist", "salt"])

    return ready.mapInArrow(run, "id long, label long, dim int, v binary, cell int, dist double, salt int")


class Index:
    """Shard trees of a table (``trees``) with what every task needs to route an anchor: pivots, radii, shard counts."""

    def __init__(self, rows: DataFrame, *, scale: int, pivots: int, sample: int, shard_bytes: int, leaf: int, base: float):
        x = F.transform("embedding", lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("double"))
        fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
        ready = (rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine
                            & (F.size("embedding") > 0))
                 .select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                         F.size("embedding").alias("dim"), x.alias("v")))
        norm = F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)
        sizes = {r["dim"]: (r["n"], r["m2"]) for r in                    # one row a vector length
                 ready.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m2")).collect()}
        self.m2 = {d: m for d, (_, m) in sizes.items()}
        some = ready.orderBy(F.xxhash64("id", "v"), "id").limit(sample).select("dim", "v").toArrow()
        self.tops = {}
        for d in sorted(set(some["dim"].to_pylist())):
            v = np.array([r for r, n in zip(some["v"].to_pylist(), some["dim"].to_pylist()) if n == d], float)
            a = augmented(v, self.m2[d])
            self.tops[d] = a[farthest_first(a, min(pivots, max(1, -(-sizes[d][0] * d * 8 // shard_bytes))))[0]]
        self.rows = checkpointed(_cells(ready, self.tops, self.m2))
        meta = (self.rows.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).collect())
        self.meta = {(r["dim"], r["cell"]): (-(-r["n"] * r["dim"] * 8 // shard_bytes), r["radius"]) for r in meta}

        def grow(table: pa.Table) -> pa.Table:
            dim = table["dim"][0].as_py()
            tree = build(table["id"].to_numpy(), table["label"].to_numpy(), _matrix(table["v"], dim), leaf, base)
            return pa.table({"dim": pa.array([dim], pa.int32()), "cell": pa.array([table["cell"][0].as_py()], pa.int32()),
                             "shard": pa.array([table["shard"][0].as_py()], pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

        counts = self.rows.sparkSession.createDataFrame([(*k, n) for k, (n, _) in self.meta.items()], "dim int, cell int, shards int")
        dealt = self.rows.join(F.broadcast(counts), ["dim", "cell"])     # bound: one row a pivot or vector length
        self.trees = checkpointed(dealt.select("dim", "cell", (F.col("salt") % F.col("shards")).alias("shard"), "id", "label", "v")
                                  .groupBy("dim", "cell", "shard").applyInArrow(grow, "dim int, cell int, shard int, tree binary"))

    def _route(self, queries: DataFrame, home: bool, groups: int) -> DataFrame:
        """One row a query and shard that it must visit."""
        meta, tops, m2 = self.meta, self.tops, self.m2
        kept = ["qid", "own", "label", "dim", "v", "low", "high"]

        def run(batches):
            for whole in batches:
                for d, b in _by_length(whole):
                    q = _matrix(b.column("v"), d)
                    low, high, cell, qid = (b.column(c).to_numpy() for c in ("low", "high", "cell", "qid"))
                    if d in tops and not home:
                        radius = np.array([meta.get((d, c), (0, 0.0))[1] for c in range(len(tops[d]))])
                        lower, upper = ball_bounds(q, tops[d], m2[d])(radius)
                        wide = SLACK * np.abs(low.astype(float))[:, None]    # bounds in doubles, windows in long
                        meets = (upper >= low[:, None] - wide) & (lower <= high[:, None].astype(float) + wide)
                    for c in range(len(tops[d])) if d in tops else (-1,):
                        shards = meta.get((d, c), (0, 0.0))[0]
                        some = np.flatnonzero(cell == c) if home or c < 0 else np.flatnonzero(meets[:, c])
                        if not shards or not len(some):
                            continue
                        part = b.take(pa.array(some))
                        for s in range(shards):
                            go = part.filter(pa.array(qid[some] % shards == s)) if home else part
                            if go.num_rows:
                                n = go.num_rows
                                yield pa.RecordBatch.from_arrays(
                                    [go.column(x) for x in kept] + [pa.array(np.full(n, y, np.int32)) for y in (c, s)]
                                    + [pa.array((go.column("qid").to_numpy() % groups).astype(np.int32))], [*kept, "cell", "shard", "part"])

        return queries.select(*kept, "cell").mapInArrow(
            run, "qid long, own long, label long, dim int, v binary, low long, high long, cell int, shard int, part int")

    def _visit(self, queries: DataFrame, k: int, same: bool, home: bool, groups: int) -> DataFrame:
        sent = self._route(queries, home, groups)
        keys = ["dim", "cell", "shard"]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = [np.zeros(0, np.int64)] * 3
            if left.num_rows and right.num_rows:
                tree, dim = pickle.loads(left["tree"][0].as_py()), left["dim"][0].as_py()
                col = {c: right[c].to_numpy() for c in ("qid", "own", "label", "low", "high")}
                out = search(tree, _matrix(right["v"], dim), col["own"], col["label"], col["low"], col["high"], k, same)
                out = col["qid"][out[0]], out[1], out[2]
            return pa.table([pa.array(c, pa.int64()) for c in out], ["qid", "cand", "score"])

        wanted = sent.select(*keys, "part").distinct()
        trees = self.trees.join(wanted, keys).select(*keys, "part", "tree").toDF("dim", "t_cell", "t_shard", "t_part", "tree")
        sent = sent.withColumnsRenamed({"dim": "q_dim"})
        return (trees.groupBy("dim", "t_cell", "t_shard", "t_part").cogroup(sent.groupBy("q_dim", "cell", "shard", "part"))
                .applyInArrow(run, "qid long, cand long, score long"))

    def nearest(self, queries: DataFrame, k: int, same: bool, group: int) -> DataFrame:
        """``queries`` (qid, own, label, dim, v, cell, low, high) -> qid, rank, cand, score: best ``k`` rows of the
        same or of other labels with a score in the window."""
        groups = max(1, -(-queries.count() // group))
        first = self._visit(queries, k, same, True, groups)
        kth = (first.groupBy("qid").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
               .select("qid", "least"))
        primed = queries.join(kth, "qid", "left").withColumn("low", F.greatest("low", F.coalesce("least", "low"))).drop("least")
        found = self._visit(primed, k, same, False, groups)
        order = Window.partitionBy("qid").orderBy(F.desc("score"), "cand")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor, *, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         scale: int = 256, pivots: int = 256, sample: int = 2048, shard_bytes: int = 2 << 20, leaf: int = 64, base: float = 1.3,
         group: int = 2048) -> DataFrame:
    """``rows`` (id, label, embedding) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    ``is_anchor`` is a condition on ``id``; a negative's score lies between ``low`` and ``high`` percent of the
    positive's.  ``sample`` rows (smallest hashes) bound what the driver sees of the table to choose pivots."""
    index = Index(rows, scale=scale, pivots=pivots, sample=sample, shard_bytes=shard_bytes, leaf=leaf, base=base)
    asked = index.rows.where(is_anchor).dropDuplicates(["id", "label", "v"]).select(
        F.monotonically_increasing_id().alias("anchor"), F.col("id").alias("own"), "label", "dim", "v", "cell")
    asked = checkpointed(asked)                       # fixes the anchors' numbers
    every = asked.select(F.col("anchor").alias("qid"), "own", "label", "dim", "v", "cell",
                         F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"))
    best = index.nearest(every, positives, True, group)
    best = best.select(F.col("qid").alias("anchor"), F.col("cand").alias("positive_id"), F.col("score").alias("positive_score"))
    s = F.col("positive_score")
    wide = "cast(positive_score as decimal(20, 0))"
    least, most = F.expr(f"({wide} * {low} + 99) div 100"), F.expr(f"({wide} * {high}) div 100")
    windows = checkpointed(asked.join(best, "anchor").where(s >= 0).withColumn("qid", F.monotonically_increasing_id()))
    found = index.nearest(windows.select("qid", "own", "label", "dim", "v", "cell", least.alias("low"), most.alias("high")),
                          negatives, False, group)
    return windows.join(found, "qid").select(
        F.col("own").alias("anchor_id"), "positive_id", "rank", F.col("cand").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op11_hardnegatives(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(e.select(F.col("vec_id").alias("id"), label.alias("label"), "embedding"), F.col("id") % 100 == 0)


OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, a.lab = b.lab AS same, b.vec_id AS id,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT pos.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN p ON p.anchor_id = pos.anchor_id AND NOT p.same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""
