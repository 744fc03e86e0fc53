"""Document quality from a linear-chain conditional random field over lines.

A text's lines (those with a visible character) form a chain whose labels are
good or bad.  A line's emission is linear in the features of the line itself
and of the lines before and after it; a 2 x 2 table scores neighbouring labels.
Every line of a learning document carries the document's quality as its label.
Forward and backward messages are segmented prefix products of 2 x 2 matrices
(log2 of the longest chain many vector steps, no loop over lines); a
document's quality is the mean of its lines' marginals, weighted by their bytes.

Learning takes at most ``train_per_class`` labelled documents of each quality
(smallest hashes of the id; ids of fold 0 never); a class beyond the bound is
weighted up to its true number, and each document counts alike whatever its
number of lines.  Their line features are written once as blocks of about
``BLOCK_BYTES`` of text; every step of the fit is a Spark pass over these
blocks that sends one gradient a task to the driver, which holds the weights.
Scoring covers whole texts of all documents.

Defined cases: a NULL or empty text, and one of blank characters only, has no
lines and gets the smoothed share of good labels, as has every text where the
learning documents with lines lack a class; a single line is a chain of one;
labels that disagree for an id count as good, repeated labels once; learning
rows repeated under one id count each; an empty table gives an empty result; extra columns are
ignored or passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_rows, blocks, bytes_view, checkpointed, mix64, row_schema, span_hashes, word_bytes, word_spans

VISIBLE = word_bytes(lambda b: b > 32 and b != 127)
NOT_BREAK = word_bytes(lambda b: b not in (10, 13))
WORD = word_bytes(lambda b: b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)
CLASSES = [word_bytes(lambda b, s=s: chr(b) in s if b < 128 else False) for s in
           ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", ".,;:?'\"-", "!", "|", "#$%&*@^~=+_",
            "<>/\\", "()[]{}")] + [word_bytes(lambda b: b >= 0x80)]
N_FEATURES = len(CLASSES) + 14


def fold(id_col="doc_id"):
    """0..4 by the id's text; 0 is never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def _repeats(key: np.ndarray) -> np.ndarray:
    """How often each value stands in the array."""
    _, which, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[which]


def lines(data: np.ndarray, off: np.ndarray):
    """Starts, ends and row of every line with a visible character."""
    s, e, row = word_spans(data, off, NOT_BREAK)
    seen = np.concatenate([[0], np.cumsum(VISIBLE[data])])
    keep = seen[e] > seen[s]
    return s[keep], e[keep], row[keep]


def features(data: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray) -> np.ndarray:
    """(lines, N_FEATURES) of each line by itself and of its place in its text."""
    n = len(s)
    size = (e - s).astype(float)
    cols = []
    for table in CLASSES:                                    # shares of character classes
        sums = np.concatenate([[0], np.cumsum(table[data])])
        cols.append((sums[e] - sums[s]) / size)
    off = np.concatenate([s, [len(data)]])
    ws, we, wl = word_spans(data, off, WORD)
    inside = (wl >= 0) & (we <= e[np.clip(wl, 0, max(n - 1, 0))]) if n else np.zeros(len(ws), bool)
    ws, we, wl = ws[inside], we[inside], wl[inside]
    h = span_hashes(data, ws, we)
    words = np.bincount(wl, minlength=n).astype(float)
    some = np.maximum(words, 1)
    length = (we - ws).astype(float)
    longest = np.zeros(n)
    np.maximum.at(longest, wl, length)
    per_line = lambda x: np.bincount(wl, weights=x, minlength=n) / some                        # noqa: E731
    in_line = mix64(h ^ mix64(wl.astype(np.uint64)))
    in_text = mix64(h ^ mix64(row[wl].astype(np.uint64) + np.uint64(1 << 40))) if n else h
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (wl[1:] == wl[:-1])
    after = np.concatenate([data, [32]])[we] if len(data) else np.zeros(0, np.uint8)
    line_again = _repeats(mix64(span_hashes(data, s, e) ^ mix64(row.astype(np.uint64)))) > 1
    first = np.concatenate([[True], row[1:] != row[:-1]]) if n else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    count = np.bincount(row, minlength=int(row.max()) + 1 if n else 0)[row].astype(float) if n else np.zeros(0)
    cols += [np.log1p(size), np.log1p(words), per_line(length) / 10, np.log1p(longest), per_line(1.0 / _repeats(in_line)) if n else size,
             per_line((_repeats(in_text) > 1).astype(float)) if n else size, per_line(again), per_line((length == 1).astype(float)),
             per_line(((after > 32) & ~WORD[after] & ~CLASSES[4][after]).astype(float)),
             CLASSES[4][data[e - 1]].astype(float) if n else size, CLASSES[1][data[s]].astype(float) if n else size,
             line_again.astype(float), (np.arange(n) - begin) / np.maximum(count, 1), np.log1p(count)]
    return np.stack(cols, 1).astype(np.float32) if n else np.zeros((0, N_FEATURES), np.float32)


def beside(x: np.ndarray, first: np.ndarray, step: int) -> np.ndarray:
    """Values of the line before (step 1) or after (-1); zero beyond the text's ends."""
    out = np.zeros_like(x)
    if step == 1:
        out[1:] = np.where(first[1:].reshape(-1, *[1] * (x.ndim - 1)), 0, x[:-1])
    else:
        out[:-1] = np.where(first[1:].reshape(-1, *[1] * (x.ndim - 1)), 0, x[1:])
    return out


def _products(m: np.ndarray, room: np.ndarray, step: int):
    """Segmented running products of 2 x 2 matrices (scaled, with their logs): ``room`` is how many matrices of the
    same chain lie before (step 1) or after (-1) each."""
    at, n, k = np.arange(len(m)), len(m), 1
    p, logs = m, np.zeros(n)
    while True:
        j = np.flatnonzero(room >= k)
        if not len(j):
            return p, logs
        other = at[j] - step * k
        new = p[other] @ p[j] if step == 1 else p[j] @ p[other]
        top = new.max(axis=(1, 2))
        p, logs = p.copy(), logs.copy() + 0.0
        grown = logs[other] + logs[j] + np.log(top)
        p[j], logs[j] = new / top[:, None, None], grown
        k *= 2


def messages(emission: np.ndarray, table: np.ndarray, first: np.ndarray):
    """Marginals of good, pair marginals (zero at a chain's first line) and each chain's log sum over labelings."""
    n = len(emission)
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    last = np.append(first[1:], True)
    end = np.minimum.accumulate(np.where(last, np.arange(n), n)[::-1])[::-1]
    logs = np.stack([np.zeros(n), emission], 1)[:, None, :] + np.where(first[:, None, None], 0.0, table[None])
    top = logs.max(axis=(1, 2))
    m = np.exp(logs - top[:, None, None])
    forward, scale = _products(m, np.arange(n) - begin, 1)
    alpha = forward[:, 0]
    back, _ = _products(m, end - np.arange(n), -1)
    beta = np.ones((n, 2))
    beta[:-1] = np.where(last[:-1, None], 1.0, back[1:].sum(2))
    both = alpha * beta
    p = both[:, 1] / both.sum(1)
    pair = np.zeros((n, 2, 2))
    pair[1:] = alpha[:-1, :, None] * m[1:] * beta[1:, None, :]
    pair[first] = 0
    pair /= np.maximum(pair.sum(axis=(1, 2)), 1e-300)[:, None, None]
    sums = np.add.reduceat(top, np.flatnonzero(first)) if n else np.zeros(0)
    return p, pair, sums + scale[last] + np.log(alpha[last].sum(1))


class Model:
    def __init__(self, mean, spread, weights, share):
        self.mean, self.spread, self.weights, self.share = mean, spread, weights, share

    def emission(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        w = self.weights[5:].reshape(3, -1)
        z = (x - self.mean) / self.spread
        return self.weights[4] + z @ w[0] + beside(z @ w[1], first, 1) + beside(z @ w[2], first, -1)

    def scores(self, column) -> np.ndarray:
        data, off = bytes_view(column)
        parts = []
        for i, j in blocks(off):
            out = np.full(j - i, self.share)
            part = data[off[i]:off[j]]
            s, e, row = lines(part, off[i:j + 1] - off[i])
            if len(s) and self.weights is not None:
                first = np.concatenate([[True], row[1:] != row[:-1]])
                p, _, _ = messages(self.emission(features(part, s, e, row), first), self.weights[:4].reshape(2, 2), first)
                size = np.bincount(row, weights=e - s, minlength=j - i)
                good = np.bincount(row, weights=p * (e - s), minlength=j - i)
                out[size > 0] = good[size > 0] / size[size > 0]
            parts.append(np.clip(out, 0, 1))
        return np.concatenate(parts) if parts else np.zeros(0)


def _blocked(batches):
    """Learning texts -> blocks of line features with first-line marks, labels and weights per line."""
    for b in batches:
        data, off = bytes_view(b.column("text"))
        y, k = b.column("quality").to_numpy(zero_copy_only=False), b.column("weight").to_numpy(zero_copy_only=False)
        for i, j in blocks(off):
            part = data[off[i]:off[j]]
            s, e, row = lines(part, off[i:j + 1] - off[i])
            if not len(s):
                continue
            first = np.concatenate([[True], row[1:] != row[:-1]])
            texts = np.unique(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([features(part, s, e, row).tobytes()], pa.binary()), pa.array([first.tobytes()], pa.binary()),
                 pa.array([y[i + texts].astype(np.int8).tobytes()], pa.binary()), pa.array([k[i + texts].astype(float).tobytes()], pa.binary())],
                ["x", "first", "y", "weight"])


def _opened(b):
    for x, first, y, k in zip(*(b.column(c).to_pylist() for c in ("x", "first", "y", "weight"))):
        yield (np.frombuffer(x, np.float32).reshape(-1, N_FEATURES), np.frombuffer(first, bool), np.frombuffer(y, np.int8),
               np.frombuffer(k, float))


def _summed(spread: DataFrame, f, size: int) -> np.ndarray:
    """Sum of ``f(block)`` (a vector) over all blocks; one vector a task comes back."""
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            for block in _opened(b):
                total += f(*block)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    got = spread.mapInArrow(run, "v binary").collect()
    return sum((np.frombuffer(r["v"], float) for r in got), np.zeros(size))


def _minimise(f, w: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """L-BFGS with backtracking; ``f`` gives value and gradient."""
    value, grad = f(w)
    past = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, y in reversed(past):
            a = s @ q / (s @ y)
            alphas.append(a)
            q -= a * y
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(np.linalg.norm(grad), 1)
        for (s, y), a in zip(past, reversed(alphas)):
            q += (a - y @ q / (s @ y)) * s
        size = 1.0
        for _ in range(12):
            trial = w - size * q
            new, new_grad = f(trial)
            if new <= value - 1e-4 * size * (grad @ q):
                break
            size /= 3
        else:
            return w
        if (trial - w) @ (new_grad - grad) > 1e-12:
            past = [*past[-memory + 1:], (trial - w, new_grad - grad)]
        done = value - new < 1e-5 * max(abs(value), 1e-9)
        w, value, grad = trial, new, new_grad
        if done:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, *, train_per_class: int = 4000, ridge: float = 1e-3, steps: int = 25) -> Model:
    """Learn from ``labels`` (doc_id, quality; fold 0 left out) over ``docs`` (doc_id, text)."""
    usable = labels.where("doc_id is not null and quality is not null").where(fold() != 0).select("doc_id", "quality")
    usable = usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    have = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = have.get(0, 0), have.get(1, 0)
    share = (n1 + 1) / (n0 + n1 + 2)
    some = [usable.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_per_class)
            .withColumn("weight", F.lit(max(n, 1) / max(min(n, train_per_class), 1))) for c, n in ((0, n0), (1, n1))]
    picked = F.broadcast(some[0].unionAll(some[1]))          # bound: 2 x train_per_class ids
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).join(picked, "doc_id")
    learn = checkpointed(texts.select("text", "quality", "weight").mapInArrow(_blocked, "x binary, first binary, y binary, weight binary"))
    size = N_FEATURES

    def moments(x, first, y, k):
        x = x.astype(float)
        return np.concatenate([[len(x), (k * (y == 0)).sum(), (k * (y == 1)).sum()], x.sum(0), (x * x).sum(0)])

    m = _summed(learn, moments, 3 + 2 * size)
    if not (m[1] and m[2]):
        return Model(None, None, None, share)
    mean = m[3:3 + size] / m[0]
    spread = np.sqrt(np.maximum(m[3 + size:] / m[0] - mean ** 2, 0)) + 1e-6
    total = m[1] + m[2]

    def value(w):
        model = Model(mean, spread, w, share)

        def part(x, first, y, k):
            z = (x - mean) / spread
            begin = np.flatnonzero(first)
            count = np.diff(np.append(begin, len(x)))
            each, label = np.repeat(k / count, count), np.repeat(y, count)
            e, table = model.emission(x, first), w[:4].reshape(2, 2)
            p, pair, logs = messages(e, table, first)
            rest, inner = each * (label - p), ~first
            gold = (each * label * e).sum() + (each * inner * table[label, label]).sum() - (k / count * logs).sum()
            g = np.zeros((2, 2))
            for c in (0, 1):
                g[c, c] = (each * inner * (label == c)).sum()
            g -= (each[:, None, None] * pair).sum(0)
            return np.concatenate([[gold], g.ravel(), [rest.sum()], rest @ z, rest @ beside(z, first, 1), rest @ beside(z, first, -1)])

        got = _summed(learn, part, len(w) + 1) / total
        return -got[0] + ridge / 2 * (w @ w), -got[1:] + ridge * w

    return Model(mean, spread, _minimise(value, np.zeros(5 + 3 * size), steps), share)


def score(docs: DataFrame, model: Model, *, keep=None, text_col: str = "text") -> DataFrame:
    """``row`` (kept columns) and ``score``."""
    src = as_rows(docs, keep, text_col)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(model.scores(b.column("text")))], ["row", "score"])

    return src.mapInArrow(run, row_schema(src, score=T.DoubleType()))


def op13_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, train(docs, labels), keep=["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
