"""Fitted pipelines: shapes and invariants (their coefficients have no SQL oracle)."""

import os
import tempfile

from pyspark.sql import functions as F

from callsight.catalog import QUERIES, contacts
from callsight.plans import order_model, recommend, text_model
from callsight.sources import load_model, save_model
from callsight.sources.adapter import labelled_notes
from conftest import SF

SF2 = "/root/testdata/sf0.01"


def test_text_model_and_classify(spark):
    notes = labelled_notes(spark, SF2).withColumnRenamed("doc_id", "interaction_id")
    metrics, cm, model, labels = text_model.train_text_model(notes, "note", "quality", "interaction_id")
    m = {r.metric: r.value for r in metrics.collect()}
    assert 0.0 <= m["accuracy"] <= 1.0
    assert sum(r["count"] for r in cm.collect()) == m["num_test"]
    assert sorted(labels) == ["0", "1"]
    out = text_model.classify_notes(model, notes.limit(20), labels, "note", "interaction_id", "quality")
    for r in out.collect():
        probs = [p.probability for p in r.class_probabilities]
        assert len(probs) == 2 and abs(sum(probs) - 1) < 1e-9 and probs == sorted(probs, reverse=True)
        assert r.predicted_label in labels
    path = os.path.join(tempfile.mkdtemp(prefix="callsight-model-"), "text")
    save_model(model, path)
    assert load_model(path).transform(notes.limit(3).withColumn("note_clean", F.lower("note"))).count() == 3


def test_order_model(spark):
    df = contacts(spark, SF2)
    metrics, cm, model = order_model.train_order_model(df)
    m = {r.metric: r.value for r in metrics.collect()}
    assert 0.5 <= m["auc"] <= 1.0
    assert sum(r["count"] for r in cm.collect()) == m["num_test"]
    pred = order_model.predict_orders(model, df)
    assert pred.count() == df.count()
    assert pred.where((F.col("p_order") < 0) | (F.col("p_order") > 1)).count() == 0
    reqs = recommend.requests_from_contacts(df)
    rec = recommend.recommend_actions(reqs, recommend.model_scorer(model))
    assert rec.count() == df.count()


def test_rows_only_queries_run(spark):
    for name in ("random_forest_orders",):
        assert QUERIES[name](spark, SF2).count() > 0
