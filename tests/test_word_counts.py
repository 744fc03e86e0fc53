"""Words counted per class from texts shuffled whole; counts of (document, word) held as files."""

import random
from collections import Counter

from pyspark.sql import functions as F

from callsight.functions import text as tx
from callsight.operators import words as W
from callsight.sources.contacts import materialize_files


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_class_words_shuffle_texts_not_words(spark):
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 20)))) for i in range(40)] + [(3, "a a z"), (None, "y"), (-1, "none")]
    refs = [(rng.choice([*range(45), None]), rng.choice(["si", "no"])) for _ in range(500)]
    t = spark.createDataFrame(texts, "note_ref long, note_clean string")
    got = W.class_word_counts_by_ref(spark.createDataFrame(refs, "note_ref long, agent_result string"), t)
    known = Counter(k for k, _ in texts if k is not None)
    n = Counter()
    for k, c in refs:
        n[(k if k in known else -1), c] += known.get(k, 1)           # a key that two texts hold counts twice, for both
    want = Counter()
    for k, text in texts:
        for (ref, c), m in n.items():
            for w in text.split(" ") if ref == k else []:
                want[c, w] += m * (w != "")
    assert {(r.agent_result, r.word): r.frequency for r in got.collect()} == dict(+want)
    assert not [x for x in plan(got).splitlines() if "hashpartitioning(note_ref" in x and "word" in x]


def test_accents_are_looked_for_in_other_than_ascii_texts_only(spark):
    df = spark.createDataFrame([(0, None), (1, "plain 12"), (2, "señal débil"), (3, "á x"), (4, "")], "i int, t string")
    assert [r.c for r in df.select("i", tx.strip_accents("t").alias("c")).orderBy("i").collect()] == [None, "plain 12", "senal debil", "a x", ""]
    assert "octet_length" in plan(df.select(tx.strip_accents("t")))


def test_files_hold_what_a_checkpoint_holds(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 2), (None, "ñ", 3)], "doc_id long, word string, tf long")
    for x in (df, df.limit(0)):
        held = materialize_files(x)
        assert held.schema == x.schema and sorted(map(str, held.collect())) == sorted(map(str, x.collect()))
        assert "parquet" in plan(held) and "ExistingRDD" not in plan(held)


def test_tfidf_counts_are_files(spark, tmp_path):
    from callsight.catalog import QUERIES

    rows = [(1, "fibra dos dos"), (2, "dos tres"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["tfidf"](spark, str(tmp_path))
    assert "ExistingRDD" not in plan(out)
    assert {(r.doc_id, r.word): r.tf for r in out.collect()} == {(1, "dos"): 2, (2, "dos"): 1, (1, "fibra"): 1, (2, "tres"): 1}


def test_vocabulary_counts_take_one_exchange_by_word(spark):
    rows = [(["a", "b", "a"], 2.0), ([], 1.0), (["b"], 3.0), (None, 1.0), (["c", "a"], 1.0)]
    got = W.vocabulary_counts(spark.createDataFrame(rows, "tokens array<string>, w double"))
    assert {r.word: (r.term_freq, r.doc_freq) for r in got.collect()} == {"a": (5.0, 3.0), "b": (5.0, 5.0), "c": (1.0, 1.0)}
    assert plan(got).count("Exchange hashpartitioning(word") == plan(got).count("Exchange ") > 0


def test_fitted_stages_are_those_of_the_pipeline(spark):
    from pyspark.ml.feature import CountVectorizer

    from callsight.plans import text_model

    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["red", "plan", "fibra", "movil", "hogar", f"w{i % 40}"]) for _ in range(12)), ["si", "no"][i % 3 == 0]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, note_clean string, agent_result string")
    for notebook in (False, True):
        pipeline = text_model.text_pipeline(max_iter=3, notebook=notebook)
        one, two = pipeline.fit(df), text_model.fit_stages(pipeline, df)
        assert [type(s) for s in one.stages] == [type(s) for s in two.stages]
        vocab = [next(s for s in m.stages if hasattr(s, "vocabulary")).vocabulary for m in (one, two)]
        assert sorted(vocab[0]) == sorted(vocab[1])
        a, b = ([r.probability[0] for r in m.transform(df).orderBy("id").collect()] for m in (one, two))
        assert max(abs(x - y) for x, y in zip(a, b)) < 1e-9
    stats = spark.createDataFrame([("a", 5, 1), ("b", 7, 1), ("c", 5, 1), ("d", 9, 1)], "word string, term_freq long, doc_freq long")
    counter = CountVectorizer(inputCol="t", outputCol="tf", minDF=2.0)
    assert sorted(text_model.fit_terms(counter, text_model.top_terms(stats, 3)).vocabulary) == ["a", "b", "d"]
