"""SQL-form metrics and tables equal MLlib's own stages and evaluators."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StopWordsRemover, StringIndexer
from pyspark.sql import functions as F

from callsight.catalog import contacts
from callsight.catalog.scoring import rule_predictions
from callsight.functions import stopwords as sw
from callsight.operators import evaluation
from callsight.plans.features import label_index_table
from conftest import SF


def test_metrics_equal_evaluators(spark):
    pred = rule_predictions(spark, SF).cache()
    ours = {r.metric: r.value for r in evaluation.metrics_from_confusion(evaluation.confusion_matrix(pred)).collect()}
    for name, key in (("accuracy", "accuracy"), ("f1", "f1"), ("precisionByLabel", "precision"),
                      ("recallByLabel", "recall"), ("weightedPrecision", "weighted_precision"),
                      ("weightedRecall", "weighted_recall")):
        v = MulticlassClassificationEvaluator(metricName=name).evaluate(pred)
        assert abs(v - ours[key]) < 1e-12, name
    for lbl in (0.0, 1.0):
        v = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=lbl).evaluate(pred)
        assert abs(v - ours[f"precision_{int(lbl)}"]) < 1e-12


def test_auc_equals_evaluator(spark):
    pred = rule_predictions(spark, SF).withColumn("score", F.round("propensity", 4))
    ours = evaluation.auc_from_histogram(evaluation.score_histogram(pred, "label", "score")).first().auc
    v = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(pred)
    assert abs(v - ours) < 1e-9


def test_label_index_equals_string_indexer(spark):
    df = contacts(spark, SF)
    tab = {(r.column_name, r.value): r.label_index for r in label_index_table(df, ["channel", "agent_result"]).collect()}
    for c in ("channel", "agent_result"):
        labels = StringIndexer(inputCol=c, outputCol="i").fit(df).labels
        assert {v: float(i) for i, v in enumerate(labels)} == {v: i for (cc, v), i in tab.items() if cc == c}


def test_stopwords_equal_mllib(spark):
    assert list(sw.default_stopwords("spanish")) == StopWordsRemover.loadDefaultStopWords("spanish")
    assert list(sw.default_stopwords("english")) == StopWordsRemover.loadDefaultStopWords("english")
    assert "no" not in sw.text_model_stopwords() and "de" in sw.text_model_stopwords()
