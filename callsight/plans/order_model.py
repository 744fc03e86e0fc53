"""Order probability model.

Structured features only (channel, result, hour, weekday, month).  The
40 % sample and the 80/20 split are hashes of the id, so the same rows are
drawn whatever the partitioning.  Metrics come from the confusion table and
the score histogram (see :mod:`callsight.operators.evaluation`).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import prob_at
from ..operators.evaluation import (
    auc_from_histogram, confusion_matrix, metrics_from_confusion, sample_rows, split_train_test,
)
from ..sources.contacts import as_literals
from ..sources.models import save_model
from .features import order_feature_pipeline, with_time_features
from .text_model import split_size_metrics


def order_model_pipeline(classifier: str = "lr", max_iter: int = 30, hour_encoding: str = "numeric",
                         num_trees: int = 20, seed: int = 42) -> Pipeline:
    """M7 features followed by logistic regression (or a random forest, R7)."""
    feats = order_feature_pipeline(hour_encoding).getStages()
    if classifier == "rf":
        clf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees, seed=seed)
    else:
        clf = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter)
    return Pipeline(stages=[*feats, clf])


def prepare_orders(df: DataFrame, id_col: str = "interaction_id") -> DataFrame:
    """Label = order flag as double (NULL flags dropped), time features."""
    x = df.withColumn("label", F.col("has_order").try_cast("int").cast("double"))
    x = with_time_features(x).where(F.col("label").isNotNull() & F.col("contact_ts").isNotNull())
    return x.select(id_col, "channel", "agent_result", "hour", "weekday", "month", "label")


def train_order_model(df: DataFrame, id_col: str = "interaction_id", sample_fraction: float | None = 0.4,
                      classifier: str = "lr", max_iter: int = 30, hour_encoding: str = "numeric",
                      first_n: int | None = None, model_path: str | None = None):
    """M19 (M20: ``sample_fraction=None, max_iter=20``, optionally ``first_n``):
    returns (metrics (metric, value), confusion, fitted PipelineModel).
    Metrics: accuracy, weighted F1, precision/recall of class 0 (the
    evaluators' default) and of each class, AUC, sizes."""
    data = prepare_orders(df, id_col)
    if first_n is not None:                       # notebook variant: first rows by id (S11)
        data = data.orderBy(id_col).limit(first_n)
    if sample_fraction is not None and sample_fraction < 1.0:
        data = sample_rows(data, id_col, sample_fraction)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = split_train_test(data, id_col, 80)
        model = order_model_pipeline(classifier, max_iter, hour_encoding).fit(train)
        pred = model.transform(test).select(
            "label", "prediction", prob_at("probability", 1).alias("p_order"))
        pred = pred.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cm = as_literals(confusion_matrix(pred))
            auc = auc_from_histogram(_histogram(pred)).select(F.lit("auc").alias("metric"),
                                                              F.col("auc").alias("value"))
            metrics = as_literals(metrics_from_confusion(cm).unionByName(auc)
                                  .unionByName(split_size_metrics(data, id_col)))
        finally:
            pred.unpersist()
    finally:
        data.unpersist()
    if model_path:
        save_model(model, model_path, data.drop(id_col, "label").schema, [0.0, 1.0])
    return metrics, cm, model


def _histogram(pred: DataFrame) -> DataFrame:
    # the score takes one value per feature combination: the histogram is small
    return (pred.groupBy(F.col("p_order").alias("score"))
                .agg(F.count_if(F.col("label") == 1.0).alias("pos"),
                     F.count_if(F.col("label") == 0.0).alias("neg")))


def predict_orders(model: PipelineModel, df: DataFrame, id_col: str = "interaction_id",
                   ts_col: str = "contact_ts") -> DataFrame:
    """M27 in batch: predicted class and P(order) for every row of ``df``
    (any number of contacts or candidate times in one job)."""
    pred = model.transform(with_time_features(df, ts_col))
    return pred.select(id_col, F.col("prediction").cast("int").alias("predicted_order"),
                       prob_at("probability", 1).alias("p_order"))
