"""Classification metrics as tables.

Metrics are computed from aggregates: the confusion matrix (one row per
label/prediction pair) and the score histogram (one row per distinct score,
ordered by ranges, never in one task).  The
values equal MLlib's evaluators (checked in the tests).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.contacts import materialize
from .rules import hash_bucket


# --- sampling and splitting (T7: deterministic by id hash) -------------------------

def sample_rows(df: DataFrame, id_col: str, fraction: float = 0.4, salt: str = "sample:") -> DataFrame:
    """M1: Bernoulli-like sample that does not depend on partitioning."""
    return df.where(hash_bucket(id_col, 100, salt) < int(round(fraction * 100)))


def split_column(id_col: str, train_pct: int = 80) -> Column:
    """M2: 'train' when the md5 bucket of the id is below ``train_pct``."""
    return F.when(hash_bucket(id_col, 100) < train_pct, F.lit("train")).otherwise(F.lit("test"))


def split_train_test(df: DataFrame, id_col: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(id_col, 100)
    return df.where(b < train_pct), df.where(b >= train_pct)


def split_sizes(df: DataFrame, id_col: str, train_pct: int = 80) -> DataFrame:
    """Rows per part, in one aggregate."""
    return df.groupBy(split_column(id_col, train_pct).alias("split")).agg(F.count(F.lit(1)).alias("rows"))


# --- confusion matrix ------------------------------------------------------------

def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """Count per (label, prediction), ordered; ``weight``: how many rows a row stands for."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    return (pred.groupBy(F.col(label).cast("double").alias("label"),
                         F.col(prediction).cast("double").alias("prediction"))
                .agg(n.alias("count")).orderBy("label", "prediction"))


def confusion_pivot(cm: DataFrame, classes=(0.0, 1.0)) -> DataFrame:
    """Wide matrix, one column per predicted class, missing -> 0."""
    names = {c: f"pred_{int(c)}" for c in classes}
    wide = cm.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("count")).na.fill(0)
    return wide.withColumnsRenamed({str(c): names[c] for c in classes}).orderBy("label")


def metrics_from_confusion(cm: DataFrame, metric_label: float = 0.0) -> DataFrame:
    """M22-M24, M26 as a long table (metric, value): accuracy, weighted F1,
    weighted precision/recall, and precision/recall of ``metric_label``
    (the evaluators' default label is 0.0, see T4) and of every class."""
    # one row per class from one pass over the matrix: each cell counts
    # once as support of its label and once as prediction of its class
    cell = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("support"),
                 F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
                  .cast("long").alias("tp"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), F.col("count").alias("predicted"))))
    cls = (cm.select(cell.alias("c")).select("c.*").groupBy("cls")
             .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted")))
    # one row per class: every metric row below reuses its exchange
    cls = cls.withColumn("n", F.sum("support").over(Window.partitionBy()))
    cls = cls.withColumns({
        "precision": F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0),
        "recall": F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0),
    })
    cls = cls.withColumn("f1", F.when((F.col("precision") + F.col("recall")) > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    weighted = cls.agg(
        (F.sum("tp") / F.max("n")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.max("n")).alias("f1"),
        (F.sum(F.col("precision") * F.col("support")) / F.max("n")).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.max("n")).alias("weighted_recall"),
        F.max("n").cast("double").alias("n"),
    )
    overall = weighted.unpivot([], ["accuracy", "f1", "weighted_precision", "weighted_recall", "n"],
                               "metric", "value")
    per = cls.select(F.explode(F.array(
        F.struct(F.concat(F.lit("precision_"), F.col("cls").cast("int").cast("string")).alias("metric"),
                 F.col("precision").alias("value")),
        F.struct(F.concat(F.lit("recall_"), F.col("cls").cast("int").cast("string")).alias("metric"),
                 F.col("recall").alias("value")))).alias("m")).select("m.metric", "m.value")
    lbl = int(metric_label)
    default = per.where(F.col("metric").isin(f"precision_{lbl}", f"recall_{lbl}")).select(
        F.regexp_replace("metric", r"_\d+$", "").alias("metric"), "value")
    return overall.unionByName(per).unionByName(default)


# --- AUC ---------------------------------------------------------------------------

def score_histogram(pred: DataFrame, label: str, score, decimals: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score (partial aggregation; the
    result has one row per distinct score)."""
    s = F.col(score) if isinstance(score, str) else score
    if decimals is not None:
        s = F.round(s, decimals)
    y = F.col(label).cast("double")
    return (pred.where(y.isNotNull() & s.isNotNull())
                .groupBy(s.alias("score"))
                .agg(F.count_if(y == 1.0).alias("pos"), F.count_if(y == 0.0).alias("neg")))


def auc_from_histogram(hist: DataFrame) -> DataFrame:
    """Area under ROC, ties counted half (equals the rank-sum formula
    and MLlib's trapezoid over distinct thresholds).

    A continuous score has as many distinct values as rows, so the prefix sum
    of the negatives has two levels: the histogram is dealt into ranges of
    the score and fixed there by a checkpoint; a window per range counts the
    negatives below within it, and a window over one row a range those of the
    ranges before.  No task sees more than its range."""
    part = materialize(hist.select("score", "pos", "neg").repartitionByRange("score")
                       .withColumn("range", F.spark_partition_id()))
    sums = part.groupBy("range").agg(F.sum("neg").alias("own"), F.min("score").alias("first"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    h = part.withColumn("inside", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    h = h.join(F.broadcast(sums), "range")            # bound: one row a shuffle partition
    below = (F.col("before") + F.col("inside")).cast("double")
    return h.agg(
        F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.count(F.lit(1)).alias("distinct_scores"))
