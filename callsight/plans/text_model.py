"""Note classifier.

TF-IDF + logistic regression over cleaned notes.  The train/test split is
a hash of the id (independent of partitioning); the training part is
persisted across the passes of the fit (vocabulary, IDF, iterations).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct, StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stopwords as sw
from ..functions.scalar import decode_label
from ..functions.text import clean_basic, clean_nb_nfkd
from ..operators.evaluation import (
    confusion_matrix, metrics_from_confusion, split_column, split_sizes, split_train_test,
)
from ..operators.words import idf_weights, vocabulary_counts
from ..sources.contacts import as_literals, materialize_files
from ..sources.models import save_model
from .features import text_feature_stages


def text_pipeline(label_col: str = "agent_result", max_iter: int = 20, ascii_tokens: bool = False,
                  notebook: bool = False, lr: dict | None = None) -> Pipeline:
    """M15 (app) or M16 (notebook: space tokenizer, notebook stop words,
    minDF 5): label index -> tokens -> stop words -> [n-grams] -> TF -> IDF -> LR."""
    if notebook:
        feats = text_feature_stages("note_clean", stop_words=sw.notebook_stopwords(), min_df=5.0,
                                    space_tokenizer=True)
    else:
        feats = text_feature_stages("note_clean", ascii_tokens=ascii_tokens)
    return Pipeline(stages=[StringIndexer(inputCol=label_col, outputCol="label"), *feats,
                            LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                                               **{"aggregationDepth": DEPTH, **(lr or {})})])


# levels of the sums over tasks (vectors as long as the vocabulary): with three, few reach the driver from many tasks
DEPTH = 3
TERM_BYTES = 12             # of a term of a text in the regression's blocks: its number and its weight
FIT_BYTES = 128 << 20       # of a partition of these blocks


def fit_terms(counter: CountVectorizer, terms: DataFrame) -> CountVectorizerModel:
    """A model whose vocabulary is the column ``word`` of ``terms`` (each once), of which only these reach the driver."""
    return counter.copy({counter.minDF: 1.0}).fit(terms.select(F.array("word").alias(counter.getInputCol())))


def top_terms(stats: DataFrame, vocab_size: int) -> DataFrame:
    """The ``vocab_size`` most frequent words of ``stats`` (ties by word)."""
    return stats.orderBy(F.desc("term_freq"), "word").limit(vocab_size)


def fit_stages(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """``pipeline.fit`` with the vocabulary found by :func:`top_terms`; ``CountVectorizer.fit`` sends every task's
    share of all terms, which grows with the corpus, to the driver."""
    done = []
    for stage in pipeline.getStages():
        if isinstance(stage, CountVectorizer):
            stats = vocabulary_counts(df.select(F.col(stage.getInputCol()).alias("tokens"), F.lit(1).cast("long").alias("w")))
            least = stage.getMinDF() if stage.getMinDF() >= 1.0 else stage.getMinDF() * df.count()
            stage = fit_terms(stage, top_terms(stats.where(F.col("doc_freq") >= least), stage.getVocabSize()))
        elif isinstance(stage, Estimator):
            stage = stage.fit(df)
        df = stage.transform(df)
        done.append(stage)
    return PipelineModel(done)


def prepare_notes(df: DataFrame, note_col: str = "note", label_col: str = "agent_result",
                  id_col: str = "interaction_id", notebook: bool = False) -> DataFrame:
    """Clean the note (P10: only when missing) and drop rows with NULLs."""
    if "note_clean" not in df.columns:
        df = df.withColumn("note_clean", clean_nb_nfkd(note_col) if notebook else clean_basic(note_col))
    return df.select(id_col, "note_clean", label_col).na.drop()


def train_text_model(df: DataFrame, note_col: str = "note", label_col: str = "agent_result",
                     id_col: str = "interaction_id", max_iter: int = 20, ascii_tokens: bool = False,
                     notebook: bool = False, model_path: str | None = None, first_n: int | None = None,
                     lr: dict | None = None):
    """Returns (metrics DataFrame (metric, value), confusion DataFrame,
    fitted PipelineModel, labels).  ``lr``: further parameters of the regression."""
    data = prepare_notes(df, note_col, label_col, id_col, notebook)
    if first_n is not None:                       # notebook variant: first rows by id (S11)
        data = data.orderBy(id_col).limit(first_n)
    # the cleaned notes feed the split, every fit pass and the sizes; the
    # test predictions feed every metric: each is computed once
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = split_train_test(data, id_col, 80)
        model = fit_stages(text_pipeline(label_col, max_iter, ascii_tokens, notebook, lr), train)
        labels = list(model.stages[0].labels)
        # a label never seen in training has no index (the indexer would
        # fail): such test rows are left out of the evaluation
        pred = model.transform(test.where(F.col(label_col).isin(labels)))
        pred = pred.select("label", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cm = as_literals(confusion_matrix(pred))
            metrics = as_literals(metrics_from_confusion(cm).unionByName(split_size_metrics(data, id_col)))
        finally:
            pred.unpersist()
    finally:
        data.unpersist()
    if model_path:
        save_model(model, model_path, data.select("note_clean", label_col).schema, labels)
    return metrics, cm, model, labels


def train_text_model_by_ref(refs: DataFrame, texts: DataFrame, label_col: str = "agent_result", id_col: str = "interaction_id",
                            ref_col: str = "note_ref", missing_ref: int = -1, max_iter: int = 20, ascii_tokens: bool = False,
                            vocab_size: int = 1 << 18, lr: dict | None = None):
    """M18 where rows refer to shared texts by key: the same results as ``train_text_model`` over the rows with
    their texts, without repeating a text.

    Rows are counted per (text, class, part) first and dealt to the texts by key, once; the tokens are kept with them
    as files (:func:`dealt_tokens`), their vectors on disk, and nothing large in memory but the regression's own blocks.  Vocabulary and
    document frequencies are sums of a text's counts times its rows, the regression takes (text, class) rows with the
    count as ``weightCol``, and the confusion counts are sums of it.  Rows whose key is NULL or unknown refer to
    ``missing_ref``."""
    known = texts.select(F.col(ref_col).alias("_known"))
    rows = refs.where(F.col(label_col).isNotNull()).select(ref_col, label_col, split_column(id_col).alias("part"))
    rows = rows.groupBy(ref_col, label_col, "part").agg(F.count(F.lit(1)).alias("w"))
    rows = (rows.join(known, rows[ref_col] == known["_known"], "left")
            .select(F.coalesce("_known", F.lit(missing_ref).cast("long")).alias(ref_col), label_col, "part", "w")
            .groupBy(ref_col, label_col, "part").agg(F.sum("w").cast("double").alias("w")))
    rows = materialize_files(rows)
    *words, counter, _ = text_feature_stages("note_clean", ascii_tokens=ascii_tokens, vocab_size=vocab_size)
    tokens = dealt_tokens(rows, texts, words, ref_col, counter.getInputCol())
    in_train = rows.where("part = 'train'")
    labels = [r[label_col] for r in in_train.groupBy(label_col).agg(F.sum("w").alias("n"))
              .orderBy(F.desc("n"), label_col).collect()]                                  # one row a class
    total = in_train.select(F.sum("w")).scalar()

    def of(part: str) -> Column:
        return F.filter("_rows", lambda r: (r["part"] == part) & r[label_col].isin(labels))

    weight = F.aggregate(of("train"), F.lit(0.0), lambda s, r: s + r["w"])
    each = tokens.where("counted").select(F.col(counter.getInputCol()).alias("tokens"), weight.alias("w")).where("w > 0")
    top = top_terms(idf_weights(vocabulary_counts(each), total), vocab_size).select("word", "idf").toArrow()
    # the vocabulary, as every fitted model holds it: columns, not values of Python
    found, idf = (top["word"].cast(pa.string()).combine_chunks(), top["idf"].to_numpy()) if top.num_rows else (pa.array([""]), np.zeros(1))
    vocabulary = fit_terms(counter, refs.sparkSession.createDataFrame(pa.table({"word": found})))
    place = pc.index_in(pa.array(vocabulary.vocabulary, pa.string()), value_set=found).to_numpy(zero_copy_only=False)
    weigh = ElementwiseProduct(inputCol="tf", outputCol="features", scalingVec=Vectors.dense(idf[place]))
    indexer = StringIndexerModel.from_labels(labels, inputCol=label_col, outputCol="label")

    size = tokens.where("fitted").agg(F.coalesce(F.sum(F.col("n_tokens") * F.size(of("train"))), F.lit(0))).first()[0]
    # the regression keeps its rows in blocks of its own, a partition's as one: these are bounded by the texts' length,
    # not their number.  It plans its input several times, so the vectors wait on disk and not behind an exchange.
    parts = max(refs.sparkSession.sparkContext.defaultParallelism, -(-size * TERM_BYTES // FIT_BYTES))
    vectors = weigh.transform(vocabulary.transform(tokens.where("fitted"))).select(ref_col, "features", "_rows")
    vectors = vectors.repartition(parts, ref_col).persist(StorageLevel.DISK_ONLY)

    def data(part: str) -> DataFrame:
        return indexer.transform(vectors.select("features", F.explode(of(part)).alias("_r")).select("features", "_r.*")).select("label", "features", "w")

    try:
        model = LogisticRegression(featuresCol="features", labelCol="label", weightCol="w", maxIter=max_iter, **(lr or {})).fit(data("train"))
        cm = as_literals(confusion_matrix(model.transform(data("test")).select("label", "prediction", "w"), weight="w"))
    finally:
        vectors.unpersist()
    sizes = rows.groupBy(F.concat(F.lit("num_"), F.col("part")).alias("metric")).agg(F.sum("w").alias("value"))
    metrics = as_literals(metrics_from_confusion(cm).unionByName(sizes))
    return metrics, cm, PipelineModel([indexer, *words, vocabulary, weigh, model]), labels


def dealt_tokens(rows: DataFrame, texts: DataFrame, words: Sequence[Transformer], ref_col: str, tokens_col: str) -> DataFrame:
    """The texts that some of ``rows`` (key, class, part, w) refer to, as files: their tokens, ``n_tokens``, and ``_rows``,
    a list of their (class, part, w).  Texts are shuffled once, as text.

    Texts that share a key are one where documents are counted and many where rows are fitted: such a key's texts are
    ``fitted`` each and ``counted`` as one more row with all their tokens; a text with a key of its own is both."""
    lists = rows.groupBy(ref_col).agg(F.collect_list(F.struct(*[c for c in rows.columns if c != ref_col])).alias("_rows"))   # bound: two entries a class
    some = texts.select(ref_col, "note_clean").where(F.col("note_clean").isNotNull() & F.col(ref_col).isNotNull())
    some = some.join(lists.hint("shuffle_hash"), ref_col).groupBy(ref_col).agg(F.collect_list("note_clean").alias("_texts"), F.first("_rows").alias("_rows"))

    def entry(text: Column, counted: bool, fitted: bool) -> Column:
        return F.struct(text.alias("note_clean"), F.lit(counted).alias("counted"), F.lit(fitted).alias("fitted"))

    shared = F.concat(F.transform("_texts", lambda t: entry(t, False, True)), F.array(entry(F.array_join("_texts", " "), True, False)))
    each = F.when(F.size("_texts") == 1, F.array(entry(F.get("_texts", F.lit(0)), True, True))).otherwise(shared)
    each = some.select(ref_col, "_rows", F.explode(each).alias("_t")).select(ref_col, "_rows", "_t.*")
    out = PipelineModel(list(words)).transform(each).select(ref_col, "_rows", "counted", "fitted", tokens_col)
    return materialize_files(out.withColumn("n_tokens", F.size(tokens_col)))


def split_size_metrics(data: DataFrame, id_col: str) -> DataFrame:
    """A27 as metric rows ``num_train`` / ``num_test`` (one aggregate)."""
    return split_sizes(data, id_col).select(F.concat(F.lit("num_"), F.col("split")).alias("metric"),
                                            F.col("rows").cast("double").alias("value"))


def classify_notes(model: PipelineModel, df: DataFrame, labels: Sequence[str],
                   note_col: str = "note", id_col: str = "interaction_id",
                   label_col: str = "agent_result") -> DataFrame:
    """M28 in batch: predicted label, its probability and all class
    probabilities (label, probability) sorted descending (K7)."""
    # the label indexer stage needs its input column: a placeholder label
    x = df.select(id_col, clean_basic(note_col).alias("note_clean"), F.lit(labels[0]).alias(label_col))
    x = x.where(F.length(F.trim("note_clean")) > 0)        # F5: blank notes are not scored
    pred = model.transform(x)
    lab = F.array(*[F.lit(s) for s in labels])
    probs = vector_to_array("probability")
    pairs = F.arrays_zip(lab.alias("label"), probs.alias("probability"))
    ranked = F.array_sort(pairs, lambda a, b: F.when(a["probability"] > b["probability"], -1)
                          .when(a["probability"] < b["probability"], 1).otherwise(0))
    idx = F.col("prediction").cast("int")
    return pred.select(
        id_col,
        decode_label("prediction", labels).alias("predicted_label"),     # P12
        F.element_at(probs, idx + 1).alias("confidence"),
        ranked.alias("class_probabilities"),
    )
