"""Training on distinct notes with weights, model signatures, the model cache, NFKD without Python."""

import random
import re
import tempfile
import threading
import unicodedata

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from callsight.functions import text as tx
from callsight.operators import words as W
from callsight.plans import model_cache, order_model, text_model
from callsight.sources import load_model, save_model
from callsight.sources.models import ModelMismatch, model_signature

NOTES = ["pide fibra optica", "no desea nada", "quiere plan movil y fibra", "llamar luego", "no contesta", "compra hoy", "fibra fibra fibra", ""]


def noted(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        k = None if i % 97 == 0 else rng.randrange(9)                     # 8 is an unknown key
        good = k in (0, 2, 5, 6) if rng.random() < 0.85 else rng.random() < 0.5
        rows.append((i, k, "interesado" if good else "no_interesado"))
    refs = spark.createDataFrame(rows, "interaction_id long, note_ref long, agent_result string")
    texts = spark.createDataFrame([*enumerate(NOTES), (-1, "sin nota")], "note_ref long, note_clean string")
    whole = (refs.withColumn("note_ref", F.when(F.col("note_ref").isNull() | (F.col("note_ref") == 8), -1).otherwise(F.col("note_ref")))
             .join(texts, "note_ref"))
    return refs, texts, whole


def test_weighted_rows_give_the_model_of_the_repeated_ones(spark):
    refs, texts, whole = noted(spark)
    lr = {"regParam": 0.01, "tol": 1e-12, "standardization": False}
    m1, c1, one, labels1 = text_model.train_text_model(whole, max_iter=300, lr=lr)
    m2, c2, two, labels2 = text_model.train_text_model_by_ref(refs, texts, max_iter=300, lr=lr)
    assert labels1 == labels2
    vocab = [next(s for s in m.stages if hasattr(s, "vocabulary")).vocabulary for m in (one, two)]
    assert set(vocab[0]) == set(vocab[1])
    coef = [dict(zip(v, m.stages[-1].coefficients.toArray())) for v, m in zip(vocab, (one, two))]
    assert max(abs(coef[0][t] - coef[1][t]) for t in vocab[0]) < 1e-6
    assert abs(one.stages[-1].intercept - two.stages[-1].intercept) < 1e-6
    assert sorted(map(tuple, c1.collect())) == sorted(map(tuple, c2.collect()))
    assert {r.metric: round(r.value, 9) for r in m1.collect()} == {r.metric: round(r.value, 9) for r in m2.collect()}
    scored = [text_model.classify_notes(m, texts.withColumnRenamed("note_ref", "interaction_id"), labels1, "note_clean")
              .orderBy("interaction_id").collect() for m in (one, two)]
    assert [r.predicted_label for r in scored[0]] == [r.predicted_label for r in scored[1]]


def test_vocabulary_coverage(spark):
    tf = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "a", 2), (2, "c", 1), (3, "d", 4)], "doc_id long, word string, tf long")
    got = {r.metric: r.value for r in W.vocabulary_coverage(W.term_counts(tf), 2).collect()}
    assert got == {"terms_left_out": 2.0, "occurrences_left_out": 2.0}
    got = {r.metric: r.value for r in W.vocabulary_coverage(W.term_counts(tf), 10, min_df=2).collect()}
    assert got == {"terms_left_out": 3.0, "occurrences_left_out": 6.0}
    assert {r.value for r in W.vocabulary_coverage(W.term_counts(tf.limit(0)), 2).collect()} == {0.0}


def test_signature_is_checked_on_load(spark):
    _, _, whole = noted(spark)
    path = tempfile.mkdtemp(prefix="callsight-model-") + "/m"
    _, _, model, labels = text_model.train_text_model(whole, max_iter=3, model_path=path)
    assert model_signature(path)["labels"] == labels
    assert isinstance(load_model(path, whole, labels), PipelineModel)
    with pytest.raises(ModelMismatch, match="note_clean is missing"):
        load_model(path, whole.drop("note_clean"))
    with pytest.raises(ModelMismatch, match="note_clean is bigint"):
        load_model(path, whole.withColumn("note_clean", F.lit(1).cast("long")))
    with pytest.raises(ModelMismatch, match="labels"):
        load_model(path, labels=labels[::-1])
    save_model(model, path, whole.select("note_clean").schema, labels, stamp="day 1")
    assert load_model(path, stamp="day 1") and load_model(path)
    with pytest.raises(ModelMismatch, match="other data"):
        load_model(path, stamp="day 2")


def test_order_model_is_stored_and_scores_text_times(spark, golden):
    from callsight.operators import clean
    df = clean.normalize_contacts(golden.unionAll(golden).unionAll(golden)).withColumn("interaction_id", F.monotonically_increasing_id())
    path = tempfile.mkdtemp(prefix="callsight-order-") + "/m"
    _, _, model = order_model.train_order_model(df, sample_fraction=None, model_path=path)
    back = load_model(path)
    as_text = df.withColumn("contact_ts", F.date_format("contact_ts", "yyyy-MM-dd HH:mm:ss"))
    a, b = (sorted(map(tuple, order_model.predict_orders(m, x).collect())) for m, x in ((model, df), (back, as_text)))
    assert a == b and len(a) == 36


def test_cache_keeps_rows_and_fits_once(spark):
    model_cache.clear()
    calls = []

    def fit():
        calls.append(1)
        return spark.createDataFrame([("accuracy", 0.5)], "metric string, value double"), {"w": 1}

    got = []
    threads = [threading.Thread(target=lambda: got.append(model_cache.fitted(spark, ("k",), fit))) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(calls) == 1 and all(g[0].first().value == 0.5 and g[1] == {"w": 1} for g in got)
    assert all(not hasattr(x, "rdd") for k in model_cache._CACHE.values() for x, _ in k)
    model_cache.clear()


def test_nfkd_cleaner_equals_unicodedata_without_python_workers(spark):
    rng = random.Random(1)
    odd = list(tx.expansions()) + list(tx.accent_table("NFKD")[0])
    texts = [None, "", "plain text 12", "ﬁbra ½ ℡ Ǆ ㎏ x² 𝐀𝐛𝟗 ñandú", " private", "á⃝ b"]
    texts += ["".join(rng.choice(odd + list("abc ñé.")) for _ in range(60)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = df.select("id", tx.clean_nb_nfkd("t").alias("c"), F.lower("t").alias("low"))
    for r in out.collect():
        dec = "".join(x for x in unicodedata.normalize("NFKD", r.low or "") if not unicodedata.combining(x))
        assert r.c == re.sub("[^a-z0-9]+", " ", dec).strip()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_training_by_reference_holds_nothing_large_in_memory(spark, monkeypatch):
    from collections import Counter

    from pyspark.sql import functions as F

    from callsight.plans import text_model
    from callsight.plans.features import text_feature_stages

    texts = [(i, " ".join(["fibra", "movil", f"w{i % 9}"] * (1 + i % 3))) for i in range(40)] + [(3, "otra fibra"), (None, "nada"), (-1, "sin nota")]
    refs = [(i, i % 44 if i % 7 else None, ["si", "no"][i % 3 == 0]) for i in range(600)]
    t = spark.createDataFrame(texts, "note_ref long, note_clean string")
    r = spark.createDataFrame(refs, "interaction_id long, note_ref long, agent_result string")
    frame, levels, regression, partitions = type(t), [], text_model.LogisticRegression, []
    persist, fit = frame.persist, regression.fit
    monkeypatch.setattr(frame, "persist", lambda self, level=None: (levels.append(level), persist(self, level))[1])
    monkeypatch.setattr(regression, "fit", lambda self, df, *a: (partitions.append(df.rdd.getNumPartitions()), fit(self, df, *a))[1])
    monkeypatch.setattr(text_model, "FIT_BYTES", 256)           # by the length of the texts, so many partitions for as few rows
    one = text_model.train_text_model_by_ref(r, t, max_iter=3)
    assert levels and not any(x.useMemory for x in levels)
    assert partitions[0] > spark.sparkContext.defaultParallelism
    monkeypatch.undo()
    two = text_model.train_text_model_by_ref(r, t, max_iter=3)
    assert [sorted(map(str, x.collect())) for x in one[:2]] == [sorted(map(str, x.collect())) for x in two[:2]]

    rows = spark.createDataFrame([(1, "si", "train", 2.0), (1, "no", "test", 1.0), (3, "si", "train", 5.0), (77, "si", "train", 1.0)],
                                 "note_ref long, agent_result string, part string, w double")
    *words, counter, _ = text_feature_stages("note_clean")
    held = text_model.dealt_tokens(rows, t, words, "note_ref", counter.getInputCol())
    assert "ExistingRDD" not in held._jdf.queryExecution().executedPlan().toString()
    got = held.select("*", F.col(counter.getInputCol()).alias("k")).collect()
    assert sorted((x.note_ref, x.counted, x.fitted, len(x._rows)) for x in got) == [(1, True, True, 2), (3, False, True, 1), (3, False, True, 1), (3, True, False, 1)]
    assert all(x.n_tokens == len(x.k) > 0 for x in got)
    shared = [x for x in got if x.note_ref == 3]
    assert sorted(w for x in shared if x.fitted for w in x.k) == sorted(w for x in shared if x.counted for w in x.k)
