"""Model persistence (S5): a fitted pipeline with what it was fitted on.

Beside the pipeline's own files a folder ``signature`` holds one JSON line:
the input columns and their types, the class labels and a stamp of the
training data.  Loading against other columns fails before any job runs.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class ModelMismatch(ValueError):
    """A stored model does not fit the input it should score."""


def save_model(model: PipelineModel, path: str, inputs: T.StructType | None = None, labels=None, stamp: str | None = None) -> str:
    """Write a fitted pipeline and its signature, replacing what is there."""
    model.write().overwrite().save(path)
    if inputs is not None:
        kept = {"inputs": {f.name: f.dataType.simpleString() for f in inputs.fields}, "labels": list(labels or []), "stamp": stamp}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(kept),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/signature")
    return path


def model_signature(path: str) -> dict:
    """The signature stored with a model."""
    return json.loads(SparkSession.active().read.text(f"{path}/signature").first()["value"])


def load_model(path: str, scores: DataFrame | None = None, labels=None, stamp: str | None = None) -> PipelineModel:
    """Load a pipeline.  ``scores``: a frame it shall score, whose columns must have the stored names and types;
    ``labels`` and ``stamp`` must equal the stored ones where given."""
    if scores is not None or labels is not None or stamp is not None:
        kept = model_signature(path)
        have = dict(scores.dtypes) if scores is not None else kept["inputs"]
        wrong = [f"{c} is {have.get(c, 'missing')}, not {t}" for c, t in kept["inputs"].items() if have.get(c) != t]
        if wrong:
            raise ModelMismatch(f"the model at {path} was fitted on other columns: " + "; ".join(wrong))
        if labels is not None and list(labels) != kept["labels"]:
            raise ModelMismatch(f"the model at {path} has the labels {kept['labels']}, not {list(labels)}")
        if stamp is not None and stamp != kept["stamp"]:
            raise ModelMismatch(f"the model at {path} was fitted on other data ({kept['stamp']}, not {stamp})")
    return PipelineModel.load(path)
