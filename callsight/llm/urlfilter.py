"""URL filter: host rules first, gradient-boosted trees for the rest.

A rule is a host with a path prefix (``example.org/es/``); it fits its host
and all subdomains if the URL's path starts with the rule's; the longest
fitting rule decides.  URLs with a rule are the labelled ones: the trees learn
allow/block from their lexical features (length, depth, digit ratio, entropy,
parameter counts, suffix statistics) and decide the URLs without a rule.

The trees learn from at most ``train_rows`` distinct labelled URLs of each class
(smallest hashes of the URL first), weighted by their copies; the suffix
statistics are counted over all rows and all suffixes.  Without both classes
among the labelled URLs every other URL is allowed.  Defined cases: a NULL
URL or one without ``://`` has empty host and path and no rule; repeated rows
are judged each; an empty table gives an empty result; only id and URL are read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

# The rules of the contract, (rule, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "params",
            "fragment", "extension", "hyphens", "suffix_share")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(urls: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``."""
    after = r"^(?s).*?://"
    u = F.coalesce("url", F.lit(""))
    return urls.withColumn("host", F.translate(F.regexp_extract(u, after + "([^/?#]*)", 1), UPPER, LOWER)).withColumn(
        "path", F.regexp_extract(u, after + "[^/?#]*([^?#]*)", 1))


def with_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` (NULL: none fits) and ``decided``."""
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, verdict in sorted(rules, key=lambda r: len(r[0])):     # the longest is outermost
        host, _, path = text.partition("/")
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path))
        rule, decided = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(decided)
    return urls.withColumn("rule", rule).withColumn("decided", decided)


def with_suffix_share(urls: DataFrame) -> DataFrame:
    """Adds ``suffix_share``, the share of the rows with the host's suffix: the 1000 most frequent suffixes are
    broadcast, so that none meets in one task; rows of the others go to their counts by a shuffle."""
    urls = urls.withColumn("suffix", F.substring_index("host", ".", -1))
    counts = checkpointed(urls.groupBy("suffix").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 1
    shares = counts.select("suffix", (F.col("n") / total).alias("suffix_share"))
    common = F.broadcast(shares.orderBy(F.desc("suffix_share"), "suffix").limit(1000))
    out = urls.join(common, "suffix")
    if counts.count() > 1000:
        rare = urls.join(common, "suffix", "left_anti").join(shares.hint("shuffle_hash"), "suffix")
        out = out.unionByName(rare)
    return out.drop("suffix")


def with_features(urls: DataFrame) -> DataFrame:
    u = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    chars = F.array_distinct(F.split(u, ""))
    entropy = F.aggregate(chars, F.lit(0.0), lambda t, c: t + F.when(
        F.length(c) > 0, F.lit(-1.0) * (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / n
        * F.log2(F.greatest((F.length(u) - F.length(F.replace(u, c, F.lit("")))) / n, F.lit(1e-12)))).otherwise(0.0))

    def number(pattern, of=u):
        return F.length(of) - F.length(F.regexp_replace(of, pattern, ""))

    return urls.select(
        "*", F.length(u).alias("url_length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        number("/", F.col("path")).alias("depth"), number("[.]", F.col("host")).alias("labels"),
        (number("[0-9]") / n).alias("digit_ratio"), entropy.alias("entropy"),
        F.when(u.contains("?"), number("[&]") + 1).otherwise(0).alias("params"),
        u.contains("#").cast("int").alias("fragment"), F.col("path").rlike(r"\.[a-z]+$").cast("int").alias("extension"),
        number("-").alias("hyphens"))


def judge(urls: DataFrame, *, rules=RULES, train_rows: int = 20000, trees: int = 10, depth: int = 4) -> DataFrame:
    """``urls`` (id columns and ``url``) plus host, path, rule, verdict and ``block_score`` (NULL where a rule decides)."""
    known = with_rule(with_parts(urls), rules)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    shared = with_suffix_share(known)
    ready = checkpointed(assembler.transform(with_features(shared)).drop(*FEATURES))
    labelled = checkpointed(shared.where("decided is not null").groupBy("url", "decided", "suffix_share")
                            .agg(F.count(F.lit(1)).alias("n"))
                            .withColumn("label", (F.col("decided") == "block").cast("double")))
    rows = {r["label"]: r["rows"] for r in labelled.groupBy("label").agg(F.sum("n").alias("rows")).collect()}
    if len(rows) < 2:
        out = ready.withColumn("block_score", F.lit(0.0))
    else:
        some = [checkpointed(labelled.where(F.col("label") == c).orderBy(F.xxhash64("url"), "url").limit(train_rows)) for c in rows]
        # a class weighs as many rows as it has, however many of its URLs are in the sample
        part = [s.withColumn("weight", F.col("n") * F.lit(rows[c] / s.agg(F.sum("n")).first()[0])) for c, s in zip(rows, some)]
        sample = checkpointed(assembler.transform(with_features(with_parts(part[0].unionByName(part[1]))))
                              .select("features", "label", "weight"))
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, weightCol="weight").fit(sample)
        from pyspark.ml.functions import vector_to_array
        out = model.transform(ready).withColumn("block_score", vector_to_array("probability")[1])
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return out.select(*urls.columns, "host", "path", "rule", F.coalesce("decided", learned).alias("verdict"),
                      F.when(F.col("rule").isNull(), F.col("block_score")).alias("block_score"))


def op8_urls(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "block_score")
