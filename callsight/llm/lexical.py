"""Ranked lexical search with per-term geometric blocking.

A document is a sparse vector of impacts: for a term that stands tf times in
it, (10^9 tf) div (1000 tf + 8 m), m its length norm; an item asks for the
documents with the largest sums of weight x impact over its terms.

Documents stay where they are read; a task holds a block of at most
``block_rows`` of them at a time.  In a block a posting list that some item
has to visit is cut into groups of similar documents: centres are drawn from the list, every document
goes to the centre whose random projection is most like its own.  Each group
keeps the coordinatewise maximum of its documents' impacts (in steps of
``STEP``, rounded up, over those terms that some item asks together with the
list's term).  An item goes through its terms' lists, heaviest weight first.  A
document that it has not met yet holds none of the terms before, so the
product of the remaining weights with a group's summary is at least its score;
groups are visited best bound first, their documents scored exactly by whole
numbers, and a group is skipped only where its bound is below the item's k-th
score so far, which a task carries from block to block.  A task returns its best ``k`` per item, and
the best of these are the result.

Documents, terms and document frequencies are counted over the whole corpus;
of the term counts per document those of the asked terms are kept (a
checkpoint).  Items come in rounds of about ``round_terms`` (item, term) rows,
which is all that reaches the driver and the tasks; each round reads the
corpus once.

Defined cases: a NULL or empty text has no terms, counts nowhere and matches
nothing; rows repeated under one id are documents each; a NULL document id
counts and is ranked behind equal scores; an item repeated with its text is
asked once; items without a term of the corpus, or with a NULL text, have no
rows; empty tables give none; a text of any length is read in pieces; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import checkpointed

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
OTHER = re.compile(rb"[^0-9a-z\x80-\xff]")
PIECE = 1 << 20
STEP = 4096                      # summaries hold impacts (below 10^6) in 245 steps of one byte


def term_counts(text: bytes | None) -> Counter:
    """Terms of a text (only A-Z lower-cased) with their numbers."""
    found, at, text = Counter(), 0, text or b""
    while at < len(text):
        end = at + PIECE
        if end < len(text):                           # pieces end where a term ends
            cut = OTHER.search(text[end:end + PIECE].lower())
            while cut is None and end + PIECE < len(text):
                end += PIECE
                cut = OTHER.search(text[end:end + PIECE].lower())
            end = len(text) if cut is None else end + cut.start()
        found.update(TERM.findall(text[at:end].lower()))
        at = end
    return found


def _item_terms(batches):
    for b in batches:
        rows = [(i, t, n) for i, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist())
                for t, n in term_counts(text).items()]
        cols = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64()))],
                                         ["item", "term", "times"])


def _vectors(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """Documents with a term: id, number of terms, and the asked terms' places and numbers as packed arrays."""
    def run(batches):
        for b in batches:
            ids, sizes, places_, numbers = [], [], [], []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                c = term_counts(text.as_py())
                if c:
                    hit = sorted((places[t], n) for t, n in c.items() if t in places)
                    ids.append(i)
                    sizes.append(sum(c.values()))
                    places_.append(np.array([p for p, _ in hit], "<i4").tobytes())
                    numbers.append(np.array([n for _, n in hit], "<i8" if hit and max(n for _, n in hit) >> 31 else "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(places_, pa.binary()),
                                              pa.array(numbers, pa.binary())], ["doc_id", "n", "places", "numbers"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, places binary, numbers binary")


def _statistics(vectors: DataFrame, size: int):
    """N, L and the document frequency of every asked term; a task sends one row a term at most."""
    def run(batches):
        df, n, total = np.zeros(size, np.int64), 0, 0
        for b in batches:
            n, total = n + b.num_rows, total + int(b.column("n").to_numpy().sum())
            df += np.bincount(np.frombuffer(b"".join(b.column("places").to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1, -2]), pa.array(np.r_[df[at], n, total])], ["place", "n"])

    got = vectors.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    all_ = dict(zip(got["place"].to_pylist(), got["n"].to_pylist()))
    df = np.array([all_.get(i, 0) for i in range(size)], np.int64)
    return all_.get(-1, 0), all_.get(-2, 0), df


class Search:
    """The items of a round and, per item, the best documents met so far."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], size: int, n_docs: int, n_terms: int, *, k: int,
                 group: int, dims: int = 32):
        by = [np.argsort(-weights, kind="stable") for _, weights in items]
        self.items = items = [(terms[o], weights[o]) for (terms, weights), o in zip(items, by)]      # heaviest term first
        self.size, self.n_docs, self.n_terms = size, n_docs, n_terms
        self.k, self.group_rows = k, group
        self.asked = [[] for _ in range(size)]                      # items of each term
        for i, (terms, _) in enumerate(items):
            for t in terms:
                self.asked[t].append(i)
        self.beside = [np.unique(np.concatenate([items[i][0] for i in own])) if own else np.zeros(0, np.int64)
                       for own in self.asked]                       # terms asked together with it
        self.at = [[np.searchsorted(self.beside[t], terms) for t in terms] for terms, _ in items]
        self.project = np.where(np.random.default_rng(12).random((size, dims)) < 0.5, -1, 1).astype(np.float32)
        none = np.zeros(0, np.int64)
        self.best = [(none, none, none.astype(bool)) for _ in items]   # scores, ids, whether the id is NULL
        self.visited = self.skipped = self.scored = 0

    def impacts(self, n, row, place, number) -> np.ndarray:
        """(documents, terms) matrix of impacts, all below 10^6."""
        m = 25 + np.array([75 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        out = np.zeros((len(n), self.size), np.int32)
        out[row, place] = 1000000000 * number // (1000 * number + 8 * m[row])
        return out

    def group(self, t: int, docs: np.ndarray, z: np.ndarray, rough: np.ndarray):
        """A term's documents group by group, where groups start, and the groups' summaries."""
        starts = np.zeros(1, np.int64)
        if len(docs) > self.group_rows:
            centres = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // self.group_rows)).astype(int)]
            near = (z[docs] @ z[centres].T).argmax(1)
            order = np.argsort(near, kind="stable")
            docs, near = docs[order], near[order]
            starts = np.flatnonzero(np.r_[True, near[1:] != near[:-1]])
        beside = self.beside[t]
        part = rough[docs] if 2 * len(beside) > self.size else rough[np.ix_(docs, beside)]
        top = np.maximum.reduceat(part, starts, axis=0)
        return docs, np.r_[starts, len(docs)], top if part.shape[1] == len(beside) else top[:, beside]

    def add(self, ids, is_null, n, row, place, number):
        """One block of documents, searched for every item.  A list is cut into groups when an item first visits it."""
        x = self.impacts(n, row, place, number)
        rough = (-(-x // STEP)).astype(np.uint8)
        z = x.astype(np.float32) @ self.project
        z /= np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-9)
        most = STEP * rough.max(axis=0).astype(np.int64)            # largest impact of each list
        by = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[by], np.arange(self.size + 1))
        lists = {}
        for i, (terms, weights) in enumerate(self.items):
            rest = np.cumsum((most[terms] * weights)[::-1])[::-1]
            seen = np.zeros(len(ids), bool)
            for a, t in enumerate(terms):
                if rest[a] < self.floor(i):
                    break                                           # no document without an earlier term can reach the floor
                if ends[t] < ends[t + 1]:
                    if t not in lists:
                        lists[t] = self.group(t, row[by[ends[t]:ends[t + 1]]], z, rough)
                    self.visit(i, a, lists[t], x, seen, ids, is_null)

    def visit(self, i, a, groups, x, seen, ids, is_null):
        """An item's ``a``-th list.  Its new documents hold none of the terms before, so only the summaries of this
        term and those after it bound their scores."""
        terms, weights = self.items[i]
        docs, starts, top = groups
        bounds = STEP * (top[:, self.at[i][a][a:]].astype(np.int64) @ weights[a:])
        order, at, step = np.argsort(-bounds, kind="stable"), 0, 4
        while at < len(order) and bounds[order[at]] >= self.floor(i):
            some = order[at:at + step]
            some = some[bounds[some] >= self.floor(i)]
            new = np.concatenate([docs[starts[g]:starts[g + 1]] for g in some])
            new = new[~seen[new]]
            seen[new] = True
            self.merge(i, x[np.ix_(new, terms)].astype(np.int64) @ weights, ids[new], is_null[new])
            at, step, self.visited, self.scored = at + step, step * 2, self.visited + len(some), self.scored + len(new)
        self.skipped += max(len(order) - at, 0)

    def floor(self, i: int) -> int:
        return int(self.best[i][0][-1]) if len(self.best[i][0]) == self.k else 1

    def merge(self, i: int, scores, ids, is_null):
        ok = scores >= self.floor(i)
        s, d, z = (np.concatenate(c) for c in zip(self.best[i], (scores[ok], ids[ok], is_null[ok])))
        by = np.lexsort((d, z, -s))[:self.k]
        self.best[i] = s[by], d[by], z[by]


def _unpacked(b, lo: int, hi: int):
    """A slice of vectors as flat arrays: row of each entry, place, number."""
    places = [np.frombuffer(x, "<i4") for x in b.column("places").slice(lo, hi - lo).to_pylist()]
    numbers = [np.frombuffer(x, "<i4" if len(x) == 4 * len(p) else "<i8").astype(np.int64)
               for x, p in zip(b.column("numbers").slice(lo, hi - lo).to_pylist(), places)]
    row = np.repeat(np.arange(hi - lo), [len(p) for p in places])
    return row, np.concatenate(places).astype(np.int64), np.concatenate(numbers)


def _ranked(vectors: DataFrame, make, block_rows: int) -> DataFrame:
    """Every task's best documents per item."""
    def run(batches):
        search, wait, size = make(), [], 0

        def flush():
            b = pa.Table.from_batches(wait).combine_chunks()
            ids = b.column("doc_id")
            row, place, number = _unpacked(b, 0, b.num_rows)
            search.add(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(), b.column("n").to_numpy(), row, place, number)

        for b in batches:
            for lo in range(0, b.num_rows, block_rows):
                part = b.slice(lo, block_rows)
                if size + part.num_rows > block_rows:
                    flush()
                    wait, size = [], 0
                wait, size = [*wait, part], size + part.num_rows
        if size:
            flush()
        for i, (s, d, z) in enumerate(search.best):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i)), pa.array(d, mask=z), pa.array(s)], ["i", "doc_id", "score"])

    return vectors.mapInArrow(run, "i long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, *, k: int = 10, round_terms: int = 1 << 15, block_rows: int = 4096,
         block_cells: int = 1 << 24, group: int = 128) -> DataFrame:
    """``docs`` (doc_id, text) ranked for each of ``items`` (item_id, text) -> item_id, rank, doc_id, score.
    A block has at most ``block_rows`` documents and about ``block_cells`` impacts (documents x asked terms)."""
    spark = docs.sparkSession
    asked = checkpointed(items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
                         .withColumn("item", F.monotonically_increasing_id()))
    terms = checkpointed(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary, times long"))
    rounds = max(1, -(-terms.count() // round_terms))
    found = []
    for r in range(rounds):
        own = terms.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r).toArrow().to_pydict()    # a round's rows
        if not own["item"]:
            continue
        places = {t: p for p, t in enumerate(sorted(set(own["term"])))}
        vectors = checkpointed(_vectors(docs, places))
        n_docs, n_terms, df = _statistics(vectors, len(places))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)
        by_item = {}
        for i, t, times in zip(own["item"], own["term"], own["times"]):
            if weight[places[t]] > 0:
                by_item.setdefault(i, []).append((places[t], times * int(weight[places[t]])))
        names = sorted(by_item)
        if not names:
            continue
        lists = [tuple(np.array(c, np.int64) for c in zip(*sorted(by_item[i]))) for i in names]
        size = len(places)

        def make(lists=lists, size=size, n_docs=n_docs, n_terms=n_terms):
            return Search(lists, size, n_docs, n_terms, k=k, group=group)

        best = _ranked(vectors, make, max(16, min(block_rows, block_cells // size)))
        order = Window.partitionBy("i").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        which = spark.createDataFrame(list(enumerate(names)), "i long, item long")
        found.append(best.join(F.broadcast(which), "i").select("item", "rank", "doc_id", "score"))   # bound: a round's items
    if not found:
        found = [spark.createDataFrame([], "item long, rank int, doc_id long, score long")]
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    return every.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return rank(docs, items)


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
tot AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM len),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, tot),
m AS (SELECT doc_id, 100 - 75 + ((75 * n * nn) // ll) AS m FROM len, tot),
ask AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM ask JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
