"""Word pairs of the cloud (A26): contingency counts, plural folding, Dunning's log-likelihood ratio.

The cloud counts words and pairs of neighbouring words per class.  A plural
(a word on one ``s`` whose singular also occurs in the class) counts as its
singular, in pairs for the second word.  A pair is shown as a term of its own
when its log-likelihood ratio exceeds a threshold; its occurrences are then
taken off both of its words.

One pass over the texts gives the rows (word, next word) with a count per class: every
occurrence of a word stands in exactly one of them, so words and pairs are
aggregates of the same table.  Rows that refer to shared texts by key are
counted per (text, class) first and weigh that text's counts, so a text
shared by a third of all rows is read once.  Pairs do not cross texts.

There are far more pairs than words, so each pair is exchanged once, with the
counts of all classes in one row.  Its ratio needs the frequencies of both words:
those of the most frequent words are broadcast, and for the others the frequency
of the least of these is a bound.  Between bounds the ratio has its largest
value at a corner and, below the expected count, its least value at the upper
corner, so most pairs are decided where they are; only the others are joined with
the words.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.contacts import materialize_files
from .words import weighted_texts

CLASS = "agent_result"


def class_values(rows: DataFrame, class_col: str = CLASS) -> list:
    """The classes that occur, NULL last (bound: few, each is a column of counts)."""
    return [r[0] for r in rows.select(class_col).distinct().orderBy(F.asc_nulls_last(class_col)).collect()]


def pair_rows(refs: DataFrame, texts: DataFrame, class_col: str = CLASS, ref_col: str = "note_ref",
              text_col: str = "note_clean", missing_ref: int = -1, min_len: int = 2, classes: Sequence | None = None) -> DataFrame:
    """(class, word, next, n) of cleaned texts that rows refer to by key (NULL or unknown keys: ``missing_ref``): one
    row per place of a word and class, with the next word of its text (NULL: at the end) and the class's rows; words
    shorter than ``min_len`` are left out before neighbours are looked for.

    With ``classes`` (:func:`class_values`) one row per place: (word, next, n_0, n_1, ...), the rows of each of them."""
    words = F.filter(F.split(F.col(text_col), " "), lambda w: F.length(w) >= min_len)
    rows = weighted_texts(refs, texts, class_col, ref_col, text_col, missing_ref).select("_classes", words.alias("w")).where(F.size("w") > 0)
    pair = F.arrays_zip(F.col("w").alias("word"), F.slice("w", 2, F.size("w")).alias("next"))
    if classes is not None:
        def count(x) -> Column:
            return F.aggregate("_classes", F.lit(0).cast("long"), lambda s, c: s + F.when(c["c"].eqNullSafe(F.lit(x)), c["_n"]).otherwise(0))

        counts = [count(x).alias(f"n_{i}") for i, x in enumerate(classes)]
        each = rows.select(*counts, F.explode(pair).alias("p"))
        return each.select("p.word", "p.next", *[f"n_{i}" for i in range(len(classes))])
    each = rows.select("_classes", F.explode(pair).alias("p")).select("p.word", "p.next", F.explode("_classes").alias("c"))
    return each.select(F.col("c.c").alias(class_col), "word", "next", F.col("c._n").alias("n"))


def class_pairs(refs: DataFrame, texts: DataFrame, class_col: str = CLASS, ref_col: str = "note_ref",
                text_col: str = "note_clean", missing_ref: int = -1, min_len: int = 2) -> DataFrame:
    """:func:`pair_rows` added up: one row per (class, word, next)."""
    return (pair_rows(refs, texts, class_col, ref_col, text_col, missing_ref, min_len)
            .groupBy(class_col, "word", "next").agg(F.sum("n").alias("n")))


def log_likelihood_ratio(both, first, second, total) -> Column:
    """Dunning's ratio of a pair seen ``both`` times, whose words are seen ``first`` and ``second`` times among
    ``total`` words; 0 where a word is all there is."""
    c12, c1, c2, n = (F.col(x).cast("double") if isinstance(x, str) else x.cast("double") for x in (both, first, second, total))

    def part(k, m, x):
        return F.ln(F.greatest(x, F.lit(1e-10))) * k + F.ln(F.greatest(1 - x, F.lit(1e-10))) * (m - k)

    p, p1, p2 = c2 / n, c12 / c1, (c2 - c12) / F.nullif(n - c1, F.lit(0.0))
    ratio = part(c12, c1, p) + part(c2 - c12, n - c1, p) - part(c12, c1, p1) - part(c2 - c12, n - c1, p2)
    return F.when((n <= c1) | (n <= c2), F.lit(0.0)).otherwise(-2 * ratio)


def _singular(c: str) -> Column:
    """The word without its plural s; NULL where it has none."""
    return F.when(F.col(c).endswith("s") & ~F.col(c).endswith("ss"), F.substring(c, F.lit(1), F.length(c) - 1))


def _stem(c: str) -> Column:
    """What a plural and its singular share: the word without its plural s, or the word itself.  Two words at most
    have the same stem, since no plural is a singular."""
    return F.coalesce(_singular(c), F.col(c))


def _form(stem: str = "stem", single: str = "single") -> Column:
    """The word that stands for a stem: the stem where it occurs as a word (``single``), else its plural."""
    return F.when(F.col(single), F.col(stem)).otherwise(F.concat(F.col(stem), F.lit("s")))


def ratio_bound(both: Column, first: Column, second: Column, total: Column, log_total: Column) -> Column:
    """:func:`log_likelihood_ratio` by the logarithms of counts, for bounds: without divisions, equal up to rounding."""
    eps, rest, other = F.lit(1e-10), total - first, second - both

    def part(k, m, log_m):
        return k * (F.ln(F.greatest(k, m * eps)) - log_m)

    log_first, log_rest = F.ln(first), F.ln(F.greatest(rest, F.lit(1.0)))
    together = part(second, total, log_total) + part(total - second, total, log_total)
    apart = part(both, first, log_first) + part(first - both, first, log_first) + part(other, rest, log_rest) + part(rest - other, rest, log_rest)
    return (apart - together) * 2


def judge(rows: DataFrame, totals: Sequence[int], least: int, threshold: float) -> DataFrame:
    """``rows`` (kind, stem1, stem, n, f1, f2) with ``strong``: whether the ratio of a pair of class ``kind`` exceeds
    ``threshold``, NULL where that is open.

    ``f1`` and ``f2`` are the frequencies of its words or NULL, which says: between n and ``least``.  With the pair's
    count and one frequency fixed, the ratio falls until the other one makes the count the expected one and rises from
    there.  So it exceeds what it is at the upper bounds while these expect fewer, and with one frequency known it
    exceeds neither end's.  One is left for rounding.  Two words of one stem overlap, and no bound holds for them."""
    def by_kind(values) -> Column:
        return F.coalesce(F.get(F.array(*[F.lit(float(x)) for x in values]), F.col("kind")), F.lit(0.0))

    def number(*c) -> Column:
        return F.coalesce(*[F.col(x).cast("double") if isinstance(x, str) else x for x in c], F.lit(0.0))

    def once(df: DataFrame, **cols: Column) -> DataFrame:                  # as a generator's row, so that no later expression repeats them
        return df.select("*", F.explode(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))).alias("_x")).select(*df.columns, "_x.*")

    low = F.lit(float(least))
    x = once(rows, _n=number("n"), _a=number("f1", "n"), _b=number("f1", low), _c=number("f2", "n"), _d=number("f2", low),
             _t=by_kind(totals), _l=by_kind([math.log(max(t, 1)) for t in totals]))
    n, a, b, c, d, t, log_t = (F.col(f"_{k}") for k in "nabcdtl")
    x = once(x, _high=ratio_bound(n, b, d, t, log_t), _low=ratio_bound(n, a, c, t, log_t))
    bound = (F.col("stem1") != F.col("stem")) & (b + d < t)
    one_known = F.col("f1").isNotNull() | F.col("f2").isNotNull()
    strong = (F.when(bound & (b * d < n * t) & (F.col("_high") > threshold + 1), F.lit(True))
              .when(bound & one_known & (F.greatest("_high", "_low") <= threshold - 1), F.lit(False)))
    return x.select(*rows.columns, strong.alias("strong"))


def join_words(rows: DataFrame, words: DataFrame, on: str, to: str) -> DataFrame:
    """``rows`` whose ``to`` is NULL with the frequency of the word whose stem is in column ``on``; the others as they
    are.  Each partition's share of the words is built as a shuffle hash join."""
    known = rows.where(F.col(to).isNotNull())
    w = words.select(F.col("stem").alias("_stem"), F.col("f").alias("_f"))
    found = rows.where(F.col(to).isNull()).join(w.hint("shuffle_hash"), F.col(on) == F.col("_stem"))
    return known.unionByName(found.withColumn(to, F.get("_f", F.col("kind"))).select(*rows.columns))


def cloud_words_and_pairs(pairs: DataFrame, stop: Sequence[str], class_col: str = CLASS, threshold: float = 30.0,
                          hot: int = 50000, classes: Sequence | None = None) -> DataFrame:
    """(class, term, is_pair, frequency) of all terms with a positive frequency.  ``pairs`` (:func:`pair_rows`) may
    hold a pair in several rows, which add up: they are counted here, at once by the second word's stem, in one
    exchange.  ``classes`` says that it has a count for each of these classes in a row; without it, its classes are
    looked up first.  The frequencies of the ``hot`` most frequent words are broadcast (at most that many rows)."""
    kind_type = pairs.schema[class_col].dataType if class_col in pairs.columns else "string"
    if classes is None:
        classes = class_values(pairs, class_col)
        pairs = pairs.select("word", "next", *[F.when(F.col(class_col).eqNullSafe(F.lit(x)), F.col("n")).otherwise(0).alias(f"n_{i}")
                                               for i, x in enumerate(classes)])
    if not classes:                                                                            # no rows at all
        classes, pairs = [None], pairs.withColumn("n_0", F.lit(0).cast("long"))
    kinds = range(len(classes))
    rows = pairs.where(~F.col("word").isin(*stop)).withColumn("next", F.when(~F.col("next").isin(*stop), F.col("next")))
    rows = rows.withColumn("stem", _stem("next")).withColumn("key", F.concat_ws(" ", "word", "stem"))     # words hold no space
    counted = rows.groupBy("key").agg(*[F.sum(f"n_{i}").alias(f"n_{i}") for i in kinds], *[
        F.bool_or((F.col("next") == F.col("stem")) & (F.col(f"n_{i}") > 0)).alias(f"s_{i}") for i in kinds])
    word, cut = F.substring_index("key", " ", 1), F.instr("key", " ")
    pairs = materialize_files(counted.select(                                                  # read by the words and the pairs
        word.alias("word"), F.when(cut > 0, F.substring(F.col("key"), cut + 1, F.length("key"))).alias("stem"),
        *[f"n_{i}" for i in kinds], *[F.coalesce(f"s_{i}", F.lit(False)).alias(f"s_{i}") for i in kinds]))
    named = [i for i in kinds if classes[i] is not None]
    names = F.array(*[F.lit(classes[i]).cast(kind_type) for i in named])
    unnamed = [pairs.groupBy("word").agg(F.sum(f"n_{i}").alias("frequency")).where(F.col("frequency") > 0).select(     # not folded, not paired
        F.lit(None).cast(kind_type).alias(class_col), F.col("word").alias("term"), F.lit(False).alias("is_pair"), "frequency")
        for i in kinds if classes[i] is None]
    if not named:
        return unnamed[0]

    def per_class(make, of: str) -> Column:
        return F.array(*[make(i) for i in named]).cast(f"array<{of}>")

    words = pairs.select("word", _stem("word").alias("stem"), *[f"n_{i}" for i in named]).groupBy("stem").agg(
        per_class(lambda i: F.sum(f"n_{i}"), "bigint").alias("f"),
        per_class(lambda i: F.bool_or((F.col("word") == F.col("stem")) & (F.col(f"n_{i}") > 0)), "boolean").alias("single"))
    words = materialize_files(words)
    largest = F.array_max("f")
    top = materialize_files(words.orderBy(F.desc(largest), "stem").limit(hot).select("stem", "f"))
    sums = words.agg(*[F.coalesce(F.sum(F.get("f", F.lit(j))), F.lit(0)) for j in range(len(named))], F.count(F.lit(1))).first()   # one row
    totals = [int(x) for x in sums[:-1]]
    total = F.get(F.array(*[F.lit(x).cast("long") for x in totals]), F.col("kind"))
    least = top.agg(F.coalesce(F.min(largest), F.lit(0))).first()[0]                           # no other word is more frequent

    two = pairs.where(F.col("stem").isNotNull()).withColumn("stem1", _stem("word"))
    for on, to in (("stem1", "_f1"), ("stem", "_f2")):
        t = F.broadcast(top.select(F.col("stem").alias("_stem"), F.col("f").alias(to)))
        two = two.join(t, F.col(on) == F.col("_stem"), "left").drop("_stem")
    each = F.array(*[F.struct(F.col(f"n_{i}").alias("n"), F.col(f"s_{i}").alias("single"), F.get("_f1", F.lit(j)).alias("f1"),
                              F.get("_f2", F.lit(j)).alias("f2")) for j, i in enumerate(named)])
    known = F.col("_f1").isNotNull() & F.col("_f2").isNotNull()
    both, two = (x.select("word", "stem1", "stem", F.posexplode(each).alias("kind", "x")).select("kind", "word", "stem1", "stem", "x.*")
                 .where(F.col("n") > 0) for x in (two.where(known), two.where(~known)))
    exceeds = log_likelihood_ratio(F.col("n"), F.col("f1"), F.col("f2"), total) > threshold
    seen = ["kind", "word", "stem1", "stem", "n", "single"]
    judged = judge(two, totals, least, threshold)
    rest = materialize_files(judged.where(F.col("strong").isNull()).drop("strong"))
    rest = materialize_files(join_words(join_words(rest, words, "stem1", "f1"), words, "stem", "f2").where(exceeds).select(*seen))
    strong = both.where(exceeds).select(*seen).unionByName(judged.where("strong").select(*seen)).unionByName(rest)
    taken = strong.select("kind", "n", F.explode(F.array("stem1", "stem")).alias("stem")).groupBy("stem").agg(
        *[F.sum(F.when(F.col("kind") == j, F.col("n")).otherwise(0)).alias(f"t_{j}") for j in range(len(named))])
    single = words.join(taken, "stem", "left").select("stem", F.posexplode(F.array(*[
        F.struct((F.get("f", F.lit(j)) - F.coalesce(f"t_{j}", F.lit(0))).alias("frequency"), F.get("single", F.lit(j)).alias("single"))
        for j in range(len(named))]).cast("array<struct<frequency:bigint,single:boolean>>")).alias("kind", "x")).select("kind", "stem", "x.*")
    class_of = F.get(names, F.col("kind")).alias(class_col)
    out = single.where(F.col("frequency") > 0).select(class_of, _form().alias("term"), F.lit(False).alias("is_pair"), "frequency").unionByName(
        strong.select(class_of, F.concat_ws(" ", F.col("word"), _form()).alias("term"), F.lit(True).alias("is_pair"), F.col("n").alias("frequency")))
    for x in unnamed:
        out = out.unionByName(x)
    return out


def cloud_pairs(pairs: DataFrame, stop: Sequence[str], class_col: str = CLASS, max_words: int = 100,
                threshold: float = 30.0, hot: int = 50000, classes: Sequence | None = None) -> DataFrame:
    """A26 with pairs: the ``max_words`` most frequent words and strong pairs of each class with their rank and their
    weight, frequency / largest frequency of the class (ties by term)."""
    terms = cloud_words_and_pairs(pairs, stop, class_col, threshold, hot, classes)
    w = Window.partitionBy(class_col).orderBy(F.desc("frequency"), F.asc("term"))
    top = terms.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_words)
    return top.withColumn("weight", F.col("frequency") / F.max("frequency").over(Window.partitionBy(class_col)))
