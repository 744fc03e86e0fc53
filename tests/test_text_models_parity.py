"""Tokenizer equivalences, n-gram edges and the T5 hour-encoding switch."""

from pyspark.ml.feature import NGram, RegexTokenizer
from pyspark.sql import functions as F

from callsight.catalog import contacts
from callsight.functions import text as tx
from callsight.operators import words as W
from callsight.plans import order_model, recommend
from callsight.sources.adapter import table
from conftest import SF

SF2 = "/root/testdata/sf0.01"


def test_tokenize_cleaned_equals_regex_tokenizer(spark):
    docs = table(spark, SF, "documents").select("doc_id", tx.clean_basic("text").alias("c"))
    ours = docs.select("doc_id", W.tokenize_cleaned("c").alias("ours"))
    ml = RegexTokenizer(inputCol="c", outputCol="ml", pattern=W.UNICODE_NONWORD, minTokenLength=2).transform(docs)
    joined = ours.join(ml.select("doc_id", "ml"), "doc_id")
    assert joined.where(F.col("ours") != F.col("ml")).count() == 0


def test_ngrams_match_mllib(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"]), (3, [])], "id int, t array<string>")
    for n in (1, 2, 3):
        ours = {r.id: r.g for r in df.select("id", W.ngrams("t", n).alias("g")).collect()}
        ml = {r.id: r.g for r in NGram(n=n, inputCol="t", outputCol="g").transform(df).collect()}
        assert ours == ml, n


def _hour_curve(spark, model):
    reqs = spark.createDataFrame([("llamada", "interesado")], "channel string, agent_result string")
    scored = recommend.score_hours(reqs, recommend.model_scorer(model))
    return [r.p for r in scored.orderBy("hour").collect()]


def test_hour_encoding_switch(spark):
    """T5: with one numeric hour the fitted probability is monotone in the
    hour; one-hot hours let each hour have its own effect."""
    df = contacts(spark, SF2)
    _, _, numeric = order_model.train_order_model(df, hour_encoding="numeric")
    _, _, onehot = order_model.train_order_model(df, hour_encoding="onehot")
    p = _hour_curve(spark, numeric)
    assert len(p) == 13
    assert p == sorted(p) or p == sorted(p, reverse=True)
    q = _hour_curve(spark, onehot)
    assert len(q) == 13 and all(0.0 <= x <= 1.0 for x in q)
    assert q != p
