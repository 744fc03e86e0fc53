"""Word statistics over notes (A25, A26, J6, K5, M8, M9, M11-M14 long form).

Texts are processed whole.  Counting is always two-level so that a very
frequent word never lands as one huge group in one task: first per
(document, word) -- spread evenly by the hash of both -- then per word,
where partial aggregation leaves one row per word per map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip_accents

UNICODE_NONWORD = r"(?U)\W+"
ASCII_NONWORD = r"\W+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(c, pattern: str = UNICODE_NONWORD, min_len: int = 2, lower: bool = True) -> Column:
    """M8 as a column: lower-case, split on ``pattern``, keep tokens of at
    least ``min_len`` characters (``RegexTokenizer`` semantics).  The
    default pattern is Unicode-aware; ``ASCII_NONWORD`` reproduces the
    studied model, which cuts accented words apart."""
    s = F.lower(_col(c)) if lower else _col(c)
    return F.filter(F.split(s, pattern), lambda t: F.length(t) >= min_len)


def tokenize_cleaned(c, min_len: int = 2) -> Column:
    """M8 with the default pattern on the output of ``clean_basic`` (lower
    case letters and single spaces): the Unicode non-word runs are exactly
    the single spaces, so a one-character split gives the same tokens."""
    return F.filter(F.split(_col(c), " "), lambda t: F.length(t) >= min_len)


def ngrams(tokens, n: int = 2) -> Column:
    """N-grams joined by a space; n = 1 is the identity; fewer than n
    tokens give an empty array."""
    t = _col(tokens)
    if n == 1:
        return t
    starts = F.sequence(F.lit(0), F.size(t) - n)
    return F.when(F.size(t) >= n, F.transform(
        starts, lambda i: F.array_join(F.slice(t, i + 1, n), " "))).otherwise(F.array().cast("array<string>"))


def stopword_frame(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """A fixed, small word list as a DataFrame (size bounded by the list)."""
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")


def remove_stopwords(words: DataFrame, stop: DataFrame, case_sensitive: bool = False,
                     fold_accents: bool = False) -> DataFrame:
    """J6/M11 in long form: left-anti join against a fixed stop-word list.
    The list is bounded, so it is broadcast.  ``fold_accents`` compares both
    sides without accents (T3); the words themselves keep theirs."""
    key = F.col("word") if case_sensitive else F.lower(F.col("word"))
    listed = F.lower("word")
    if fold_accents:                               # a word of ASCII letters is its own folded form
        key = F.when(F.octet_length(key) == F.length(key), key).otherwise(strip_accents(key))
        listed = strip_accents(listed)
    s = stop.select(listed.alias("_stop")).distinct()
    return words.join(F.broadcast(s), key == F.col("_stop"), "left_anti")


def term_frequencies(words: DataFrame, id_col: str) -> DataFrame:
    """Per (document, term) count: ``tf``."""
    return words.groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("tf"))


def term_counts(tf: DataFrame, min_df: float = 1.0) -> DataFrame:
    """M13 vocabulary statistics: total count and document frequency per
    term, terms in at least ``min_df`` documents (a fraction when < 1)."""
    stats = tf.groupBy("word").agg(F.sum("tf").alias("term_freq"), F.count(F.lit(1)).alias("doc_freq"))
    if min_df < 1.0:
        n_docs = tf.select(F.count_distinct(tf.columns[0])).scalar()
        return stats.where(F.col("doc_freq") >= F.lit(min_df) * n_docs)
    return stats.where(F.col("doc_freq") >= F.lit(min_df))


def vocabulary_counts(texts: DataFrame, tokens: str = "tokens", weight: str = "w") -> DataFrame:
    """``word``, ``term_freq`` and ``doc_freq`` over weighted token lists.  In a sorted list a word's first place is the
    one after another word, so lists become counts without an exchange of (text, word) rows."""
    words = F.sort_array(tokens)
    place = F.arrays_zip(words.alias("word"), F.concat(F.array(F.lit(None).cast("string")), words).alias("before"))
    each = texts.select(weight, F.explode(place).alias("p")).select(weight, "p.word", "p.before").where(F.col("word").isNotNull())
    first = F.col("before").isNull() | (F.col("before") != F.col("word"))
    return each.groupBy("word").agg(F.sum(weight).alias("term_freq"), F.coalesce(F.sum(F.when(first, F.col(weight))), F.lit(0)).alias("doc_freq"))


def vocabulary_coverage(stats: DataFrame, vocab_size: int, min_df: float = 1.0) -> DataFrame:
    """What a vocabulary of the ``vocab_size`` most frequent terms (in at least ``min_df`` texts) leaves out of
    ``stats`` (:func:`term_counts`), as metric rows: terms and occurrences.  The kept terms are a distributed top-k;
    of them and of all terms one row each is added up."""
    sums = (F.count(F.lit(1)).alias("terms"), F.coalesce(F.sum("term_freq"), F.lit(0)).cast("long").alias("occurrences"))
    kept = stats.where(F.col("doc_freq") >= min_df).orderBy(F.desc("term_freq"), "word").limit(vocab_size).agg(*sums)
    both = stats.agg(*sums).select(F.lit(1).alias("sign"), "*").unionByName(kept.select(F.lit(-1).alias("sign"), "*"))
    left = both.agg(*[F.sum(F.col("sign") * F.col(c)).cast("double").alias(f"{c}_left_out") for c in ("terms", "occurrences")])
    return left.unpivot([], ["terms_left_out", "occurrences_left_out"], "metric", "value")


def idf_weights(stats: DataFrame, n_docs) -> DataFrame:
    """``ln((N + 1) / (df + 1))`` per term (MLlib's smoothing)."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return stats.withColumn("idf", F.ln((n.cast("double") + 1.0) / (F.col("doc_freq").cast("double") + 1.0)))


def tfidf(tf: DataFrame, idf: DataFrame, hot: int = 1000) -> DataFrame:
    """Long-form TF-IDF: one row per (document, term), joined on the term.
    A common term has a row in most documents, so the ``hot`` terms of the
    largest ``doc_freq`` (at most that many rows) are broadcast and their
    rows never meet in one task.  The rest of the vocabulary grows with the
    corpus and is never broadcast: a shuffle hash join builds each
    partition's share of it (one row per term) and streams the (document,
    term) rows past it."""
    weights = idf.select("word", "idf")
    top = F.broadcast(idf.orderBy(F.desc("doc_freq"), "word").limit(hot).select("word", "idf"))
    often = tf.join(top, "word")
    seldom = tf.join(top.select("word"), "word", "left_anti").join(weights.hint("shuffle_hash"), "word")
    return often.unionByName(seldom).withColumn("tfidf", F.col("tf") * F.col("idf"))


def top_k_per_group(counts: DataFrame, group: str, value: str = "frequency",
                    k: int = 30, tie: str = "word") -> DataFrame:
    """K5: the ``k`` largest per group, ties by ``tie``.  Spark inserts a
    per-partition group limit before the exchange, so each group ships at
    most ``k`` rows per partition."""
    w = Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def explode_cleaned(df: DataFrame, text_col: str, keep: Sequence[str], min_len: int = 1) -> DataFrame:
    """One row per word of a cleaned text (single spaces only).  The length
    filter runs after ``explode`` as a plain predicate, inside whole-stage
    codegen (a lambda ``filter`` on the array would be interpreted)."""
    return (df.select(*keep, F.explode(F.split(F.col(text_col), " ")).alias("word"))
              .where(F.length("word") >= min_len))


def class_word_counts(df: DataFrame, text_col: str, class_col: str = "agent_result",
                      min_len: int = 1, stop: DataFrame | None = None) -> DataFrame:
    """(class, word, frequency) over rows that carry their cleaned text."""
    words = explode_cleaned(df, text_col, [class_col], min_len)
    if stop is not None:
        words = remove_stopwords(words, stop, case_sensitive=True)   # cleaned text is lower case
    return words.groupBy(class_col, "word").agg(F.count(F.lit(1)).alias("frequency"))


def weighted_texts(refs: DataFrame, texts: DataFrame, class_col: str = "agent_result", ref_col: str = "note_ref",
                   text_col: str = "note_clean", missing_ref: int = -1) -> DataFrame:
    """(text, ``_classes``) of the texts that rows refer to by key: per class the number of rows, as (class, ``_n``).

    Aggregation before the join: rows are counted per (text, class) first, so a key shared by a third of all rows is
    one aggregated row here.  The join takes whole texts, so each is shuffled once, as text and not as its words.
    Rows whose key is NULL or not among the texts count as ``missing_ref``."""
    w = refs.groupBy(ref_col, class_col).agg(F.count(F.lit(1)).alias("_n"))
    known = texts.select(F.col(ref_col).alias("_known"))
    w = (w.join(known, w[ref_col] == known["_known"], "left")
          .select(F.coalesce("_known", F.lit(missing_ref).cast("long")).alias(ref_col), class_col, "_n")
          .groupBy(ref_col, class_col).agg(F.sum("_n").alias("_n")))
    # bound: one entry a class.  Shuffle hash join, built per partition from the row counts; they grow with the corpus
    # and must not be broadcast.
    w = w.groupBy(ref_col).agg(F.collect_list(F.struct(F.col(class_col).alias("c"), "_n")).alias("_classes"))
    some = texts.where(F.col(ref_col).isNotNull()).select(ref_col, text_col)
    return some.join(w.hint("shuffle_hash"), ref_col).select(text_col, "_classes")


def class_word_counts_by_ref(refs: DataFrame, texts: DataFrame, class_col: str = "agent_result",
                             ref_col: str = "note_ref", text_col: str = "note_clean",
                             missing_ref: int = -1, min_len: int = 1,
                             stop: DataFrame | None = None) -> DataFrame:
    """(class, word, frequency) when rows reference shared texts by key: every word of a text counts as often as
    rows of the class refer to it (:func:`weighted_texts`).  The work follows the number of distinct texts, not the
    number of rows."""
    words = explode_cleaned(weighted_texts(refs, texts, class_col, ref_col, text_col, missing_ref), text_col, ["_classes"], min_len)
    if stop is not None:
        words = remove_stopwords(words, stop, case_sensitive=True)
    each = words.select("word", F.explode("_classes").alias("_c"))
    return each.groupBy(F.col("_c.c").alias(class_col), "word").agg(F.sum("_c._n").alias("frequency"))


def top_words(df: DataFrame, text_col: str | None = None, class_col: str = "agent_result", n: int = 30,
              counts: DataFrame | None = None) -> DataFrame:
    """Per class the ``n`` most common whitespace tokens of a text
    column already cleaned by one of the cleaners (word, frequency).
    ``counts`` may be given precomputed (e.g. ``class_word_counts_by_ref``)."""
    if counts is None:
        counts = class_word_counts(df, text_col, class_col, 1)
    return top_k_per_group(counts, class_col, "frequency", n)


def cloud_terms(df: DataFrame | None, text_col: str | None, stop: DataFrame | None,
                class_col: str = "agent_result", max_words: int = 100, min_len: int = 2,
                counts: DataFrame | None = None) -> DataFrame:
    """Term weights of a word cloud per class: tokens of at least
    ``min_len`` characters, stop words removed, the ``max_words`` most
    frequent, weight = frequency / largest frequency of the class."""
    if counts is None:
        counts = class_word_counts(df, text_col, class_col, min_len, stop)
    top = top_k_per_group(counts, class_col, "frequency", max_words)
    w = Window.partitionBy(class_col)
    return top.withColumn("weight", F.col("frequency") / F.max("frequency").over(w))
