"""Toxicity with class-conditional Kneser-Ney models.

One bigram model per class c (toxic, ordinary) over a shared vocabulary of V
words; n counts occurrences in the learning sample, t and k distinct right
and left neighbours there, K and T sum k and count the words that have one:

    p_c(w|u) = (max(n_c(u,w) - D, 0) + (P V + D t_c(u)) q_c(w)) / (n_c(u) + P V)
    q_c(w)   = (1 - g) (max(k_c(w) - D, 0) + D T_c r(w)) / K_c + g / V
    r(w)     = (s(w) + 1) / (sum of s + V)
    g        = W V / (W V + (K_0 + K_1) / 2)

with s(w) the distinct left neighbours of w over *all* documents.  A class's
discounted pairs back off to its continuation counts, those to the continuation
counts that both classes share and to a uniform base; every word weighs like
W = 1 context and P = 8 occurrences beforehand, so what is rare is drawn
towards no evidence and a word needs many different contexts, not many copies
of one passage.  Each p_c sums to one over the vocabulary (tested against a
plain dictionary implementation).  A word outside the learning sample is
symbol 0, which no text of the sample holds.

A text's evidence is the length-normalised difference of the two
log-likelihoods, over the whole text and over its strongest window of
``window`` words (1: its strongest word in context); a logistic curve over these two, fitted on labelled rows kept
apart from the counts, gives the score.  D, W, P and the window are constants,
chosen on the rows of fold 1, never on the held-out fold 0.

Bounds (a documented parameter): the models learn from at most
``train_per_class`` labelled documents of each class (smallest hashes first),
and from as many of either: a larger class would hold back less for words it
has not seen, and those would count as signs of the smaller.  In the curve
ordinary rows weigh as they stand in the labels.  The tables (12 bytes a pair,
24 a word of that sample) go to every task by one
broadcast.  The shared counts cover all documents: each task sends its distinct
(word, left neighbour) keys as sorted, compressed lists, one a bucket, and one
number per vocabulary word comes back.  Neighbours outside the vocabulary are
told apart by 40 bits of their hash.  Scoring covers whole texts.

Defined cases: a NULL or empty text has no words and gets the score of zero
evidence; without both classes among the labelled texts with words every score
is 0; the curve is fitted on the first of the folds 1 to 4 that has ``LEAST_TUNED``
texts of either class and leaves both to the counts, and if none does, all
four are counted and the score's log odds are the mean log ratio plus the log of
the toxic labels' share (smoothed, so a text of zero evidence stays below 0.5); rows
with NULL labels or ids are not learned from; repeated rows are scored each;
an empty table gives an empty result; extra columns are ignored or passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SMALL_BLOCK, as_rows, blocks, bytes_view, checkpointed, lower_ascii, mix64, row_schema, span_hashes, word_bytes, word_spans

IS_WORD = word_bytes(lambda b: b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122)
LOWER = lower_ascii()
DISCOUNT, WORD_WEIGHT, PAIR_WEIGHT = 0.75, 1.0, 8.0
LEAST_TUNED = 10        # texts of either class from which the curve is fitted
HELD_KEYS = 1 << 20     # (word, left neighbour) keys that a task holds before it sends them on
UNKNOWN, START = np.uint64(1 << 40), np.uint64(0)       # left neighbours: a hash above, a vocabulary place, the start


def fold(id_col="doc_id"):
    """0..4 by the id's text; 0 is never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def _tokens(column):
    """Blocks of (rows, row of each word, hash of each word)."""
    data, off = bytes_view(column)
    for i, j in blocks(off, SMALL_BLOCK):
        part, o = LOWER[data[off[i]:off[j]]], off[i:j + 1] - off[i]
        s, e, row = word_spans(part, o, IS_WORD)
        yield j - i, row, span_hashes(part, s, e)


class Places:
    """Places of sorted 64-bit hashes.  A table by their leading bits points at the one or two that share them, so a
    lookup reads a few words instead of searching the whole array."""

    def __init__(self, hashes: np.ndarray, room: float = 1, step: int = 1 << 18):
        self.hashes = hashes
        bits = max(1, int(room * len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.full((1 << bits) + 1, len(hashes), np.int32)
        for i in range(0, 1 << bits, step):                      # in steps: the table is the largest thing here
            heads = np.arange(i, min(i + step, 1 << bits), dtype=np.uint64)
            self.first[i:i + len(heads)] = np.searchsorted(hashes, heads << self.shift)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where it is not held."""
        if not len(self.hashes):
            return np.full(len(h), -1, np.int64)
        head = (h >> self.shift).view(np.int64)
        at = self.first[head]
        left = self.first[head + 1] - at
        hit = (left > 0) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == h)
        out = np.where(hit, at, np.int32(-1)).astype(np.int64)
        which = np.flatnonzero(~hit & (left > 1))
        at, left = at[which], left[which]
        while len(which):
            at, left = at + 1, left - 1
            hit = self.hashes[at] == h[which]
            out[which[hit]] = at[hit]
            on = ~hit & (left > 1)
            at, left, which = at[on], left[on], which[on]
        return out


def _ids(vocab: Places, h: np.ndarray) -> np.ndarray:
    """Place in the vocabulary plus 1; 0 for other words."""
    return vocab.find(h) + 1


def _left(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Each word's left neighbour; -1 at the start of a row."""
    left = np.full(len(ids), -1, np.int64)
    if len(ids) > 1:
        left[1:] = np.where(rows[1:] == rows[:-1], ids[:-1], -1)
    return left


def _worded(batches):
    """Class and fold of every text that has a word."""
    for b in batches:
        some, done = [np.zeros(0, np.int64)], 0
        for n, row, _ in _tokens(b.column("text")):
            some.append(done + np.unique(row))
            done += n
        rows = pa.array(np.concatenate(some))
        yield pa.RecordBatch.from_arrays([b.column("toxic").take(rows), b.column("part").take(rows)], ["toxic", "part"])


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct values (``np.unique`` hashes large arrays, which takes several times as long)."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _words(batches):
    """Each batch's distinct words."""
    for b in batches:
        some = [_distinct(h) for _, _, h in _tokens(b.column("text"))]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(_distinct(np.concatenate(some)).view(np.int64))], ["w"])


class Model:
    """Log ratios p_1 / p_0: of every pair of the learning sample (``delta`` by the sorted hashes ``keys`` of left symbol
    and word), of all others the sum of a left symbol's ``alpha`` and a word's ``beta``."""

    def __init__(self, vocab, alpha, beta, keys, delta, window, curve=(0.0, 0.0, 0.0)):
        self.vocab, self.alpha, self.beta, self.keys, self.delta = vocab, alpha, beta, keys, delta
        self.window, self.curve = window, curve
        self.places = None                                       # of words and pairs: made in the tasks, not on the driver
        self.sent = None

    def sent_to_tasks(self, spark):
        """One broadcast of the tables for all uses of the model."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast({"tables": (self.vocab, self.alpha, self.beta, self.keys, self.delta, self.window)})
        return self.sent

    def words(self, h: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Log ratio of every word after its left neighbour."""
        self.places = self.places or (Places(self.vocab, 4), Places(self.keys, 0.5))
        ids = _ids(self.places[0], h)
        left = _left(row, ids) + 1                               # 0: start of the text
        at = self.places[1].find(mix64((left * (len(self.vocab) + 1) + ids).view(np.uint64)))    # mix64 is one to one
        return np.where(at >= 0, self.delta[at], self.alpha[left] + self.beta[ids])

    def evidence(self, column) -> np.ndarray:
        """(rows, 2): mean log ratio, and the strongest window's."""
        parts = []
        for n, row, h in _tokens(column):
            out = np.zeros((n, 2))
            if len(h):
                x = self.words(h, row)
                begin = np.searchsorted(row, np.arange(n + 1))
                sums = np.concatenate([[0.0], np.cumsum(x)])
                count = begin[1:] - begin[:-1]
                some = count > 0
                out[some, 0] = ((sums[begin[1:]] - sums[begin[:-1]])[some]) / count[some]
                end = np.minimum(np.arange(len(x)) + self.window, begin[1:][row])
                best = np.maximum.reduceat(sums[end] - sums[:-1], begin[:-1][some])
                out[some, 1] = best / self.window
            parts.append(out)
        return np.concatenate(parts) if parts else np.zeros((0, 2))

    def scores(self, column) -> np.ndarray:
        e = self.evidence(column)
        a, b, c = self.curve
        return 1.0 / (1.0 + np.exp(-np.clip(a + b * e[:, 0] + c * e[:, 1], -40, 40)))


def _fit_curve(x: np.ndarray, y: np.ndarray, ordinary: float) -> tuple[float, ...]:
    """Two-variable logistic regression by Newton steps with a small ridge;
    ordinary rows weigh ``ordinary`` each, so that classes count as they stand in the labels."""
    k = np.where(y > 0, 1.0, ordinary)
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (k * (y - p)) - 1e-2 * w
        step = np.linalg.solve((z * (k * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(3), g)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as compressed differences, with their number in front."""
    first = np.diff(keys, prepend=np.uint64(0))
    return len(keys).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(first.view(np.uint8).reshape(-1, 8).T).tobytes(),
                                                         codec="zstd", asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.decompress(blob[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, n).T).view(np.uint64).reshape(-1), dtype=np.uint64)


def shared_contexts(corpus: DataFrame, vocab: np.ndarray) -> np.ndarray:
    """Distinct left neighbours of every vocabulary word (place 0: none) over all texts."""
    buckets = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches):
        held, size, places = [], 0, Places(vocab, 4)

        def out():
            keys = _distinct(np.concatenate(held))
            where = (mix64(keys) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
            by = np.argsort(where, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=buckets))])
            for n in range(buckets):
                if ends[n] < ends[n + 1]:
                    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([_packed(keys[by[ends[n]:ends[n + 1]]])], pa.binary())],
                                                     ["bucket", "keys"])

        for b in batches:
            for _, row, h in _tokens(b.column("text")):
                ids = _ids(places, h)
                word = ids.astype(np.uint64)
                known = np.where(ids > 0, word, (mix64(h) >> np.uint64(24)) | UNKNOWN)
                prev = np.full(len(h), START)
                if len(h) > 1:
                    prev[1:] = np.where(row[1:] == row[:-1], known[:-1], START)
                some = ids > 0
                held.append((word[some] << np.uint64(41)) | prev[some])
                size += len(held[-1])
                if size > HELD_KEYS:
                    held = [_distinct(np.concatenate(held))]
                    size = len(held[0])
                    if size > HELD_KEYS // 2:
                        yield from out()
                        held, size = [], 0
        if held:
            yield from out()

    def count(table: pa.Table) -> pa.Table:
        w = _distinct(np.concatenate([_unpacked(x) for x in table["keys"].to_pylist()])) >> np.uint64(41)
        ends = np.flatnonzero(np.append(w[1:] != w[:-1], True))              # keys are sorted by word
        return pa.table([pa.array(w[ends].astype(np.int64)), pa.array(np.diff(ends, prepend=-1))], ["w", "n"])

    texts = as_rows(corpus, [], "text").select("text")
    got = (texts.mapInArrow(send, "bucket int, keys binary").groupBy("bucket").applyInArrow(count, "w long, n long")
           .groupBy("w").agg(F.sum("n").alias("n")).toArrow())                     # at most one row a vocabulary word
    shared = np.zeros(len(vocab) + 1)
    shared[got["w"].to_numpy()] = got["n"].to_numpy()
    return shared


def continuation(k: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """q_c of both classes from their distinct left neighbours per symbol (two rows) and the shared ones."""
    size = len(shared)
    r = (shared + 1) / (shared.sum() + size)
    total = k.sum(axis=1, keepdims=True)
    own = (np.maximum(k - DISCOUNT, 0) + DISCOUNT * (k > 0).sum(axis=1, keepdims=True) * r) / total
    base = WORD_WEIGHT * size / (WORD_WEIGHT * size + total.mean())
    return (1 - base) * own + base / size


def backoff_mass(t: np.ndarray, size: int) -> np.ndarray:
    """What q_c is multiplied by after left symbols with ``t`` distinct right neighbours, before the division by
    their occurrences plus P V."""
    return PAIR_WEIGHT * size + DISCOUNT * t


def train(docs: DataFrame, labels: DataFrame, corpus: DataFrame, *, train_per_class: int = 10000,
          window: int = 1) -> Model | None:
    """Learn from ``labels`` (doc_id, toxic; fold 0 left out) over ``docs``; shared counts over ``corpus``."""
    spark = docs.sparkSession
    usable = labels.where("doc_id is not null and toxic is not null").where(fold() != 0).select("doc_id", "toxic")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    have = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    each = min(train_per_class, have.get(0, 0), have.get(1, 0))      # as many of either class
    some = [usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for c in (0, 1)]
    picked = F.broadcast(some[0].unionAll(some[1]))      # bound: 2 x train_per_class ids
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    texts = checkpointed(texts.join(picked, "doc_id").withColumn("part", fold()))
    worded = (texts.select("text", "toxic", F.col("part").cast("int")).mapInArrow(_worded, "toxic int, part int")
              .groupBy("toxic", "part").agg(F.count(F.lit(1)).alias("n")).collect())          # at most 8 rows
    folds = [{r["part"]: r["n"] for r in worded if r["toxic"] == c} for c in (0, 1)]
    if not (folds[0] and folds[1]):
        return None
    part = next((p for p in range(1, 5) if all(f.get(p, 0) >= LEAST_TUNED and len(f) > 1 for f in folds)), None)
    learn = texts.where(F.lit(True) if part is None else F.col("part") != part).select("text", "toxic")
    tune = texts.where(F.lit(False) if part is None else F.col("part") == part).select("text", "toxic")
    words = learn.mapInArrow(_words, "w long").distinct()
    vocab = np.sort(words.toArrow()["w"].to_numpy().view(np.uint64))
    size = len(vocab) + 1

    def pairs(batches):
        places = Places(vocab, 4)
        for b in batches:
            label = b.column("toxic").to_numpy(zero_copy_only=False)
            keys, ones, done = [np.zeros(0, np.int64)], [np.zeros(0, bool)], 0
            for n, row, h in _tokens(b.column("text")):
                ids = _ids(places, h)
                keys.append((_left(row, ids) + 1) * size + ids)
                ones.append(label[done + row] == 1)
                done += n
            key, which = np.unique(np.concatenate(keys), return_inverse=True)
            n1 = np.bincount(which, weights=np.concatenate(ones), minlength=len(key)).astype(np.int64)
            n0 = np.bincount(which, minlength=len(key)) - n1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, n0, n1)], ["key", "n0", "n1"])

    seen = checkpointed(learn.mapInArrow(pairs, "key long, n0 long, n1 long").groupBy("key")
                        .agg(F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1")))
    left = seen.groupBy(F.expr(f"key div {size}").alias("u")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count_if(F.col("n0") > 0).alias("t0"),
        F.count_if(F.col("n1") > 0).alias("t1")).toArrow()                       # a row a symbol, as the next
    right = seen.groupBy((F.col("key") % size).alias("w")).agg(
        F.count_if(F.col("n0") > 0).alias("k0"), F.count_if(F.col("n1") > 0).alias("k1")).toArrow()
    shared = shared_contexts(corpus, vocab)
    n, t, k = np.zeros((2, size + 1)), np.zeros((2, size + 1)), np.zeros((2, size))
    for c in (0, 1):
        n[c, left["u"].to_numpy()], t[c, left["u"].to_numpy()] = left[f"n{c}"].to_numpy(), left[f"t{c}"].to_numpy()
        k[c, right["w"].to_numpy()] = right[f"k{c}"].to_numpy()
    q = continuation(k, shared)
    mass = backoff_mass(t, size)
    whole = np.log(n + PAIR_WEIGHT * size)                       # the two classes' denominators after a left symbol
    sent = spark.sparkContext.broadcast((mass, whole, q))        # 72 bytes a word

    def ratios(batches):
        mass, whole, q = sent.value
        for b in batches:
            key = b.column("key").to_numpy()
            u, w = key // size, key % size
            logs = [np.log(np.maximum(b.column(f"n{c}").to_numpy() - DISCOUNT, 0) + mass[c, u] * q[c, w]) - whole[c, u] for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array((logs[1] - logs[0]).astype(np.float32))], ["key", "delta"])

    got = seen.mapInArrow(ratios, "key long, delta float").toArrow()                # 12 bytes a pair of the sample
    keys, delta = mix64(got["key"].to_numpy().view(np.uint64)), got["delta"].to_numpy()
    del got
    by = np.argsort(keys).astype(np.uint32 if len(keys) < 1 << 32 else np.int64)
    alpha, beta = np.log(mass[1] / mass[0]) - (whole[1] - whole[0]), np.log(q[1] / q[0])
    model = Model(vocab, alpha, beta, keys[by], delta[by], window)
    del by, delta, keys, left, right, mass, whole, n, t, k, q
    sent.destroy()

    if part is None:                                           # the smoothed share of toxic labels is below 1
        model.curve = (float(np.log((have[1] + 1) / (have[0] + have[1] + 2))), 1.0, 0.0)
        return model
    spread = model.sent_to_tasks(spark)

    def tuned(batches):
        model = of_worker(spread)
        for b in batches:
            e = model.evidence(b.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1]), b.column("toxic")], ["a", "b", "y"])

    fit = tune.mapInArrow(tuned, "a double, b double, y int").toPandas()   # at most 2 x train_per_class rows
    model.curve = _fit_curve(fit[["a", "b"]].to_numpy(), fit["y"].to_numpy(float),
                             have[0] / have[1])
    return model


def of_worker(sent) -> Model:
    """The broadcast model with its lookup tables, built once in a worker process."""
    held = sent.value
    if "model" not in held:
        held["model"] = Model(*held["tables"])
    return held["model"]


def score(docs: DataFrame, model: Model | None, *, keep=None, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``row`` (kept columns) and ``score``; ``with_text`` adds ``text`` as bytes, so that a kept text travels once."""
    src = as_rows(docs, keep, text_col)
    names = ["row", "text"] if with_text else ["row"]
    if model is None:
        return src.select(*names, F.lit(0.0).alias("score"))
    sent, curve = model.sent_to_tasks(docs.sparkSession), model.curve

    def run(batches):
        model = of_worker(sent)
        model.curve = curve
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):                 # what goes back is held again by the JVM
                b = whole.slice(i, 1000)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(model.scores(b.column("text")))],
                                                 [*names, "score"])

    more = {"text": T.BinaryType()} if with_text else {}
    return src.mapInArrow(run, row_schema(src, **more, score=T.DoubleType()))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, train(docs, labels, docs), keep=["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
