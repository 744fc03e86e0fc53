"""Word pairs of the cloud against a plain computation; AUC of a continuous score against MLlib."""

import math
import random
from collections import Counter

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from callsight.operators import collocations as coll
from callsight.operators import evaluation

STOP = ("de", "la", "y")


def plain(texts, threshold=30.0):
    """Terms and frequencies of one class, word by word."""
    words, pairs = Counter(), Counter()
    for text, n in texts:
        w = [x for x in text.split(" ") if len(x) >= 2]
        for x in w:
            words[x] += n * (x not in STOP)
        for a, b in zip(w, w[1:]):
            if a not in STOP and b not in STOP:
                pairs[a, b] += n
    words = +words
    form = {w: w[:-1] if w.endswith("s") and not w.endswith("ss") and w[:-1] in words else w for w in words}
    folded = Counter()
    for w, n in words.items():
        folded[form[w]] += n
    two = Counter()
    for (a, b), n in pairs.items():
        two[a, b[:-1] if b.endswith("s") and not b.endswith("ss") and (a, b[:-1]) in pairs else b] += n
    total, out = sum(words.values()), Counter(folded)

    def part(k, m, x):
        return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (m - k)

    for (a, b), n in two.items():
        c1, c2 = folded[form[a]], folded[form[b]]
        if total <= c1 or total <= c2:
            continue
        p, p1, p2 = c2 / total, n / c1, (c2 - n) / (total - c1)
        if -2 * (part(n, c1, p) + part(c2 - n, total - c1, p) - part(n, c1, p1) - part(c2 - n, total - c1, p2)) > threshold:
            out[form[a]] -= n
            out[form[b]] -= n
            out[f"{a} {b}"] = n
    return {t: n for t, n in out.items() if n > 0}


def corpus():
    rng = random.Random(4)
    w = ["red", "redes", "plan", "planes", "plans", "fibra", "fibras", "optica", "opticas", "de", "la", "x", "gas", "gass", "movil"]
    texts = []
    for i in range(60):
        t = [rng.choice(w) for _ in range(rng.randint(0, 30))]
        texts.append((i, " ".join(t + (["fibra", "optica"] * (i % 3) if i % 2 else ["plan", "movil", "plans"]))))
    refs = [(i % 60 if i % 11 else None, ["si", "no"][i % 4 == 0]) for i in range(500)] + [(999, "si"), (7, None)]
    return texts + [(-1, "sin nota de la red")], refs


def test_cloud_pairs_equal_plain_computation(spark):
    texts, refs = corpus()
    t = spark.createDataFrame(texts, "note_ref long, note_clean string")
    r = spark.createDataFrame(refs, "note_ref long, agent_result string")
    by = dict(texts)
    for hot in (1000, 3):
        got = {}
        for x in coll.cloud_words_and_pairs(coll.class_pairs(r, t), STOP, threshold=30.0, hot=hot).collect():
            got.setdefault(x.agent_result, {})[x.term] = x.frequency
            assert x.is_pair == (" " in x.term)
        for c in ("si", "no"):
            own = Counter(k if k in by else -1 for k, lab in refs if lab == c)
            want = plain([(by[k], n) for k, n in own.items()])
            assert got[c] == want and any(" " in k for k in want) and "fibra" in want and "fibras" not in want
    top = coll.cloud_pairs(coll.class_pairs(r, t), STOP, max_words=5).where("agent_result = 'si'").orderBy("rank").collect()
    assert [x["rank"] for x in top] == [1, 2, 3, 4, 5] and top[0].weight == 1.0
    assert [x.frequency for x in top] == sorted((x.frequency for x in top), reverse=True)


def test_pairs_are_counted_from_texts_in_one_exchange_and_held_as_files(spark):
    texts, refs = corpus()
    t = spark.createDataFrame(texts, "note_ref long, note_clean string")
    r = spark.createDataFrame(refs, "note_ref long, agent_result string")
    rows, summed = coll.pair_rows(r, t), coll.class_pairs(r, t)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(note_ref#" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(note_ref" in x and "word" in x]       # texts are shuffled, not their words
    for pairs in (rows, summed):
        terms = coll.cloud_words_and_pairs(pairs, STOP)
        assert "Scan ExistingRDD" not in terms._jdf.queryExecution().executedPlan().toString()            # no row checkpoint
    a, b = (sorted(map(str, coll.cloud_words_and_pairs(x, STOP).collect())) for x in (rows, summed))
    assert a == b and a


def test_cloud_pairs_of_nothing(spark):
    t = spark.createDataFrame([(1, ""), (2, "de la"), (-1, "")], "note_ref long, note_clean string")
    r = spark.createDataFrame([(1, "si"), (2, "si"), (3, "no")], "note_ref long, agent_result string")
    assert coll.cloud_pairs(coll.class_pairs(r, t), STOP).count() == 0


def test_auc_of_a_continuous_score_equals_mllib(spark):
    rng = random.Random(2)
    rows = [(float(rng.random() < 0.3), rng.gauss(0, 1)) for _ in range(5000)]
    rows = [(y, s + 0.7 * y) for y, s in rows] + [(1.0, 0.5), (0.0, 0.5), (0.0, 0.5)]
    df = spark.createDataFrame(rows, "label double, score double")
    hist = evaluation.score_histogram(df, "label", "score")
    got = evaluation.auc_from_histogram(hist)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    row = got.first()
    assert abs(row.auc - want) < 1e-9 and row.distinct_scores == 5001
    assert abs(row.auc - rank_auc(rows)) < 1e-9
    assert evaluation.auc_from_histogram(hist.where("pos > 5")).first().auc is None
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(range" in plan


def rank_auc(rows):
    pos, neg = [s for y, s in rows if y], sorted(s for y, s in rows if not y)
    import bisect
    return sum(bisect.bisect_left(neg, s) + (bisect.bisect_right(neg, s) - bisect.bisect_left(neg, s)) / 2 for s in pos) / (len(pos) * len(neg))


def test_classes_share_a_row_and_pairs_are_exchanged_once(spark):
    texts, refs = corpus()
    t = spark.createDataFrame(texts, "note_ref long, note_clean string")
    r = spark.createDataFrame(refs, "note_ref long, agent_result string")
    classes = coll.class_values(r)
    assert classes == ["no", "si", None]
    wide = coll.pair_rows(r, t, classes=classes)
    assert wide.columns == ["word", "next", "n_0", "n_1", "n_2"]
    long = {(x.agent_result, x.word, x.next): x.n for x in coll.class_pairs(r, t).collect()}
    sums = Counter()
    for x in wide.collect():
        for c, n in zip(classes, x[2:]):
            sums[c, x.word, x.next] += n
    assert dict(+sums) == long
    for hot in (50000, 3, 1):
        one, two = (sorted(map(str, df.collect()) if df.columns == ["agent_result", "term", "is_pair", "frequency"] else []) for df in (
            coll.cloud_words_and_pairs(wide, STOP, hot=hot, classes=classes), coll.cloud_words_and_pairs(coll.pair_rows(r, t), STOP, hot=hot)))
        assert one == two and one
    plan = coll.cloud_words_and_pairs(wide, STOP, classes=classes)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(agent_result" not in plan                        # no exchange of pairs of a class
    assert not [x for x in plan.splitlines() if "hashpartitioning(stem" in x and "word" in x]


def test_pairs_of_no_class_and_of_no_rows(spark):
    t = spark.createDataFrame([(1, "redes red"), (-1, "")], "note_ref long, note_clean string")
    for refs, want in (([(1, None)], {"redes": 1, "red": 1}), ([], {})):
        r = spark.createDataFrame(refs, "note_ref long, agent_result string")
        got = coll.cloud_words_and_pairs(coll.pair_rows(r, t, classes=coll.class_values(r)), STOP, classes=coll.class_values(r))
        assert {x.term: x.frequency for x in got.collect()} == want


def test_bounds_decide_as_the_ratio_does(spark):
    rng = random.Random(7)

    def ratio(k, c1, c2, n):
        def part(k, m, x):
            return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (m - k)
        p, p1, p2 = c2 / n, k / c1, (c2 - k) / (n - c1)
        return -2 * (part(k, c1, p) + part(c2 - k, n - c1, p) - part(k, c1, p1) - part(c2 - k, n - c1, p2))

    totals, decided = (10 ** 4, 10 ** 8, 3 * 10 ** 10), Counter()
    for kind, total in enumerate(totals):
        least, rows = max(3, total // 20000), []
        for _ in range(1500):
            which = rng.randrange(3)
            c1, c2 = (max(1, int(10 ** rng.uniform(0, math.log10(total * 0.1 if which == i else least)))) for i in (0, 1))
            n = rng.randint(1, max(1, min(c1, c2, int(10 ** rng.uniform(0, math.log10(min(c1, c2) + 1))))))
            rows.append((kind, "a", "b", n, c1 if which == 0 else None, c2 if which == 1 else None, c1, c2))
        df = spark.createDataFrame(rows, "kind int, stem1 string, stem string, n long, f1 long, f2 long, c1 long, c2 long")
        for x in coll.judge(df, totals, least, 30.0).collect():
            decided[x.strong] += 1
            assert x.strong in (None, ratio(x.n, x.c1, x.c2, total) > 30.0)
    assert min(decided[True], decided[False], decided[None]) > 100
