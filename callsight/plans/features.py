"""Feature stages (M3-M7, M9-M14 as MLlib stages, X10 feature columns)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    CountVectorizer, IDF, NGram, OneHotEncoder, RegexTokenizer, StopWordsRemover, StringIndexer,
    Tokenizer, VectorAssembler,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stopwords as sw
from ..functions.calendar import parse_ts, weekday_sun1
from ..operators.words import ASCII_NONWORD, UNICODE_NONWORD


def label_index_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M3/M4 as a table: the index ``StringIndexer`` gives each value
    (frequency descending, ties alphabetical), one row per (column, value).
    One scan: the columns are stacked and counted together; the ranking
    window runs over the distinct values only."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("x")).select("x.column_name", "x.value").where(F.col("value").isNotNull())
    counts = stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("frequency"))
    w = Window.partitionBy("column_name").orderBy(F.desc("frequency"), F.asc("value"))
    return counts.withColumn("label_index", (F.row_number().over(w) - 1).cast("double"))


def with_time_features(df: DataFrame, ts: str = "contact_ts") -> DataFrame:
    """Hour, weekday (1 = Sunday, as the studied model) and month; a time given as text is parsed (X11)."""
    if dict(df.dtypes)[ts] == "string":
        df = df.withColumn(ts, parse_ts(ts))
    return df.withColumns({"hour": F.hour(ts), "weekday": weekday_sun1(ts), "month": F.month(ts)})


def order_feature_pipeline(hour_encoding: str = "numeric") -> Pipeline:
    """M7: index channel and result (unseen/NULL -> extra index), one-hot
    them (last category dropped), assemble with hour, weekday and month.
    ``hour_encoding='onehot'`` one-hot encodes the hour too (T5: a single
    numeric hour makes the fitted probability monotone in the hour)."""
    stages = [
        StringIndexer(inputCol="channel", outputCol="channel_idx", handleInvalid="keep"),
        StringIndexer(inputCol="agent_result", outputCol="result_idx", handleInvalid="keep"),
    ]
    ins, outs = ["channel_idx", "result_idx"], ["channel_vec", "result_vec"]
    hour_col = "hour"
    if hour_encoding == "onehot":
        ins.append("hour")
        outs.append("hour_vec")
        hour_col = "hour_vec"
    stages.append(OneHotEncoder(inputCols=ins, outputCols=outs, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=["channel_vec", "result_vec", hour_col, "weekday", "month"],
                                  outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def text_feature_stages(text_col: str = "note_clean", ascii_tokens: bool = False,
                        stop_words: Sequence[str] | None = None, ngram_n: int = 1,
                        min_df: float = 1.0, space_tokenizer: bool = False, vocab_size: int = 1 << 18) -> list:
    """M8/M9 -> M11 -> M12 -> M13 -> M14: tokens, stop words, n-grams,
    term counts, TF-IDF ``features``.

    The default stop words also match with accents left out or added (T3;
    not with ``ascii_tokens``, which reproduces the studied model).
    ``vocab_size`` bounds the model: the most frequent terms only (MLlib's
    default number); the long form ``term_counts`` has no such bound."""
    if space_tokenizer:
        tok = Tokenizer(inputCol=text_col, outputCol="tokens")
    else:
        tok = RegexTokenizer(inputCol=text_col, outputCol="tokens", minTokenLength=2,
                             pattern=ASCII_NONWORD if ascii_tokens else UNICODE_NONWORD)
    if stop_words is None:
        stop_words = sw.text_model_stopwords() if ascii_tokens else sw.accent_variants(sw.text_model_stopwords())
    stop = list(stop_words)
    stages = [tok, StopWordsRemover(inputCol="tokens", outputCol="tokens_clean", stopWords=stop)]
    last = "tokens_clean"
    if ngram_n != 1 or not space_tokenizer:
        stages.append(NGram(n=ngram_n, inputCol="tokens_clean", outputCol="tokens_ngram"))
        last = "tokens_ngram"
    stages += [CountVectorizer(inputCol=last, outputCol="tf", minDF=min_df, vocabSize=vocab_size),
               IDF(inputCol="tf", outputCol="features")]
    return stages
