"""Hard negatives, ranked lexical search and line quality: brute force, odd rows, held-out accuracy."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsight.llm import hardnegatives as hn
from callsight.llm import lexical, linequality

from test_corpus import SCHEMA, odd_rows

VECTORS = "id long, label int, embedding array<float>, cell int, tree string, dim string"


def vector_rows():
    rng = np.random.default_rng(8)
    v = np.round(rng.normal(size=(500, 5)) + 3 * (np.arange(500) % 4)[:, None] * np.eye(5)[np.arange(500) % 5], 1).astype(np.float32)
    rows = [(i, int(i % 3), [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(500 + i, i % 3, rows[i % 10][2]) for i in range(60)]                     # equal vectors: ties
    rows += [(560, 1, [0.0] * 5), (561, 2, [-x for x in rows[0][2]]), (580, 0, [1.0, 2.0]), (581, 1, [1.0, 1.9]), (600, 0, [1.0, 2.1]),
             (20, 2, rows[20][2]), (20, 2, rows[20][2]), (40, 1, rows[41][2])]         # repeated ids, another length
    odd = [(None, 1, rows[3][2]), (700, None, rows[3][2]), (720, 1, None), (740, 1, []), (760, 2, [1.0, None, 1.0, 1.0, 1.0]),
           (780, 2, [float("nan")] * 5), (781, 1, [float("inf")] * 5)]
    return rows, [(*r, 1, "t", "d") for r in rows + odd]


def mined(rows, step=20, k=5):
    w = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in rows]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))                                # noqa: E731
    out = []
    for own, lab, q in {(i, lab, tuple(v)) for i, lab, v in w if i % step == 0}:
        scored = [(-dot(q, v), i, b) for i, b, v in w if i != own and len(v) == len(q)]
        for p, pid, _ in sorted(x for x in scored if x[2] == lab)[:k]:
            fits = sorted(x for x in scored if x[2] != lab and 80 * -p <= 100 * -x[0] <= 100 * -p)[:k]
            out += [(own, pid, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("shard_bytes,group", [(2 << 20, 2048), (2000, 7)])
def test_hard_negatives_equal_brute_force(spark, shard_bytes, group):
    rows, all_ = vector_rows()
    df = spark.createDataFrame(all_, VECTORS)
    got = hn.mine(df, F.col("id") % 20 == 0, shard_bytes=shard_bytes, group=group, leaf=8, sample=100)
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_hard_negatives_odd_tables(spark):
    df = spark.createDataFrame(vector_rows()[1], VECTORS)
    assert hn.mine(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert hn.mine(df.where("label = 1 and id < 500"), F.col("id") % 20 == 0).count() == 0      # no other label
    big = spark.createDataFrame([(0, 0, [3e6, 1.0]), (1, 0, [3e6, 3.0]), (2, 1, [3e6, 2.0]), (3, 1, [3e6, 2.5])],
                                "id long, label int, embedding array<double>")
    got = [tuple(r) for r in hn.mine(big, F.col("id") == 0).collect()]
    s = lambda b: 768000000 ** 2 + int(256 * b * 256)                                  # noqa: E731  beyond doubles
    assert sorted(got) == [(0, 1, 1, 3, s(3), s(2.5)), (0, 1, 2, 2, s(3), s(2))]


def test_cover_tree_bounds_and_pruning():
    rng = np.random.default_rng(1)
    v = np.floor(256 * (rng.normal(size=(3000, 8)) * 0.1 + 4 * rng.normal(size=(12, 8))[np.arange(3000) % 12]))
    tree = hn.build(np.arange(3000), np.arange(3000) % 5, v, leaf=32)
    q = v[:40]
    s = q @ v.T
    x = hn.augmented(tree["v"], tree["m2"])
    bounds = hn.ball_bounds(q, tree["centres"], tree["m2"])
    leaf_of = np.searchsorted(tree["ends"], np.arange(3000), side="right") - 1
    at = leaf_of
    for n in range(len(tree["levels"]) - 1, -1, -1):
        parent, radius, low, high = tree["levels"][n]
        assert (np.sqrt(((x - tree["centres"][at]) ** 2).sum(1)) <= radius[at] + 1e-9).all()
        assert (tree["labels"] >= low[at]).all() and (tree["labels"] <= high[at]).all()
        lower, upper = bounds(radius)
        real = q @ tree["v"].T
        assert (real <= upper[:, at]).all() and (real >= lower[:, at]).all()
        gaps = np.sqrt(((tree["centres"][:len(radius), None] - tree["centres"][None, :len(radius)]) ** 2).sum(2))
        assert len(radius) == 1 or gaps[~np.eye(len(radius), dtype=bool)].min() > 0
        at = parent[at] if n else at
    wide = np.full(40, 10.0 ** 15).astype(np.int64)
    row, cand, score = hn.search(tree, q, np.arange(40), np.arange(40) % 5, -wide, wide, 5, False)
    for a in range(40):
        want = sorted((-s[a, b], b) for b in range(3000) if b % 5 != a % 5)[:5]
        assert list(zip(-score[row == a], cand[row == a])) == want
    _, upper = bounds(tree["levels"][-1][1])
    kth = np.array([score[row == a].min() for a in range(40)])
    assert (upper >= kth[:, None]).mean() < 0.3            # most leaves miss the k-th score


def ranked(docs, items, k=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    count = lambda t: Counter(word.findall((t or "").translate({i: i + 32 for i in range(65, 91)})))
    c = [(i, count(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, x in c if x), sum(sum(x.values()) for _, x in c)
    df = Counter(t for _, x in c for t in x)
    out = []
    for item, text in set(items):
        ask, found = count(text), []
        for i, x in c:
            if x:
                m = 25 + 75 * sum(x.values()) * n_docs // n_terms
                s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * x[t] // (1000 * x[t] + 8 * m))
                        for t, q in ask.items() if t in x)
                if s > 0:
                    found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if z else i, -s) for r, (s, z, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


ITEMS = [(1, "the MIT license"), (2, None), (3, ""), (4, "w7 W9 w9 ñandú short passage"), (5, "unheard"), (6, "passage passage of x"),
         (6, "license"), (1, "the MIT license"), (None, "several documents"), (7, " ".join(f"w{i}" for i in range(300)))]


@pytest.mark.parametrize("size", [{}, {"round_terms": 40, "block_rows": 5, "group": 2}, {"block_cells": 1, "group": 3}])
def test_lexical_search_equals_brute_force(spark, size):
    rng = np.random.default_rng(3)
    rows = odd_rows()
    rows += [(100 + i, " ".join(f"w{x}" for x in rng.zipf(1.4, rng.integers(1, 60)) % 400), "r", "f", "k", "s", "c", "g") for i in range(80)]
    rows += [rows[20], (None, "The license passage w7", "r", "f", "k", "s", "c", "g"), (None, None, "r", "f", "k", "s", "c", "g")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    items = spark.createDataFrame([(*x, 1, 2) for x in ITEMS], "item_id long, text string, item int, rank int")
    got = sorted(map(tuple, lexical.rank(docs, items, **size).collect()), key=str)
    assert got == ranked([r[:2] for r in rows], ITEMS)


def test_lexical_search_empty_tables_and_pieces(spark, monkeypatch):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.rank(docs.limit(0), items).count() == 0 == lexical.rank(docs, items.limit(0)).count()
    text = ("Ab,ñ12 " * 50 + "x" * 100 + " ") * 3
    whole = lexical.term_counts(text.encode())
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert lexical.term_counts(text.encode()) == whole == Counter({b"ab": 150, "ñ12".encode(): 150, b"x" * 100: 3})


def test_lexical_search_skips_groups():
    rng = np.random.default_rng(2)                         # one common term (0, the heaviest) and 15 terms a topic
    size, n = 301, 2000
    topic = np.arange(n) % 20
    own = 1 + topic.repeat(30) * 15 + rng.integers(0, 15, n * 30)
    row, place = np.unique(np.stack([np.r_[np.repeat(np.arange(n), 30), np.arange(n)], np.r_[own, np.zeros(n, int)]]), axis=1)
    s = lexical.Search([(np.r_[0, 1 + t * 15 + np.arange(8)], np.r_[9, rng.integers(5, 9, 8)]) for t in range(20)], size, n, n * 30,
                       k=10, group=16)
    for lo in range(0, n, 500):
        ok = (row >= lo) & (row < lo + 500)
        s.add(np.arange(lo, lo + 500), np.zeros(500, bool), np.full(500, 30), row[ok] - lo, place[ok], np.ones(ok.sum(), np.int64))
    x = s.impacts(np.full(n, 30), row, place, np.ones(len(row), np.int64)).astype(np.int64)
    for i, (terms, weights) in enumerate(s.items):
        score = x[:, terms] @ weights
        want = sorted((-v, d) for d, v in enumerate(score) if v > 0)[:10]
        assert list(zip((-s.best[i][0]).tolist(), s.best[i][1].tolist())) == want
    assert s.scored < 0.5 * 20 * n and s.skipped > s.visited


def test_crf_messages_equal_enumeration():
    rng = np.random.default_rng(0)
    sizes = [1, 5, 2, 8, 1, 3]
    first = np.concatenate([[True] + [False] * (s - 1) for s in sizes])
    e, table = rng.normal(size=len(first)) * 3, rng.normal(size=(2, 2)) * 2
    p, pair, logs = linequality.messages(e, table, first)
    at = 0
    for c, s in enumerate(sizes):
        weight = {y: math.exp(sum(e[at + i] * y[i] for i in range(s)) + sum(table[y[i - 1], y[i]] for i in range(1, s)))
                  for y in itertools.product((0, 1), repeat=s)}
        z = sum(weight.values())
        assert abs(math.log(z) - logs[c]) < 1e-9
        for i in range(s):
            assert abs(sum(w for y, w in weight.items() if y[i]) / z - p[at + i]) < 1e-9
            for a, b in itertools.product((0, 1), repeat=2) if i else ():
                assert abs(sum(w for y, w in weight.items() if (y[i - 1], y[i]) == (a, b)) / z - pair[at + i, a, b]) < 1e-9
        at += s
    far, _, _ = linequality.messages(np.full(200000, 500.0), table, np.arange(200000) == 0)     # long chains, large scores
    assert np.isfinite(far).all() and far.min() > 0.999


def test_line_features_see_lines_and_neighbours():
    text = "\n \n Good line here.\r\nA | B | C\n\n\tsame same same\nA | B | C".encode()
    data = np.frombuffer(text, np.uint8)
    s, e, row = linequality.lines(data, np.array([0, len(data)]))
    assert [text[a:b].strip() for a, b in zip(s, e)] == [b"Good line here.", b"A | B | C", b"same same same", b"A | B | C"]
    x = linequality.features(data, s, e, row)
    k = len(linequality.CLASSES)
    assert x.shape == (4, linequality.N_FEATURES) and np.isfinite(x).all()
    assert x[:, k + 11].tolist() == [0, 1, 0, 1] and abs(x[2, k + 4] - 1 / 3) < 1e-6      # lines that come again; distinct words
    first = np.array([True, False, True, False])
    assert linequality.beside(np.arange(4.0), first, 1).tolist() == [0, 0, 0, 2]
    assert linequality.beside(np.arange(4.0), first, -1).tolist() == [1, 0, 3, 0]


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = linequality.train(docs, labels, train_per_class=1000, steps=15)
    held = docs.join(labels, "doc_id").where(linequality.fold() == 0)
    p = linequality.score(held, model, keep=["doc_id", "quality"]).select("row.quality", "score").toPandas()
    good = p[p.quality == 1].score
    assert (good >= 0.3).mean() > 0.99 and (p[p.quality == 0].score < 0.3).mean() > 0.9


def test_quality_defined_cases(spark):
    odd = spark.createDataFrame(odd_rows(), SCHEMA)
    labels = spark.createDataFrame([(r[0], int(r[0] % 2), 0) for r in odd_rows()] + [(3, 1, 0), (None, 1, 0), (4, None, 0)],
                                   "doc_id long, quality int, score int")
    model = linequality.train(odd.unionAll(odd), labels, steps=3)
    got = {r.row.doc_id: r.score for r in linequality.score(odd, model).collect()}
    assert len(got) == 15 and all(0 <= s <= 1 for s in got.values()) and got[0] == got[1] == got[2] == model.share
    assert got[7] == got[8]
    one = linequality.train(odd, labels.where("quality = 1"))
    assert {r.score for r in linequality.score(odd, one).collect()} == {one.share} and one.share > 0.5
    empty = linequality.train(odd.limit(0), labels.limit(0))
    assert empty.share == 0.5 and linequality.score(odd.limit(0), empty).count() == 0
