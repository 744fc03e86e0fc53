"""Document fingerprints: a Merkle tree over spans, paragraphs and sections.

A paragraph ends at a line break; inside it a span ends after a word whose
hash is divisible by ``span_words`` (content-defined, so an edit moves no
later boundary).  Spans cover every byte.  A paragraph's digest hashes its
spans', a section (paragraphs up to one whose digest is divisible by
``section_paragraphs``) hashes its paragraphs', the root hashes the
sections'.  Equal roots mean equal texts; otherwise equal sections and
paragraphs are skipped and the likeness is the share of bytes in common
spans (Dice, spans counted with repeats); ``changed_at`` is the first byte of
the first differing branch (-1: none).

Defined cases: a NULL text is empty; two empty texts have likeness 1, an
empty and another 0; repeated ids are ordered by the text's hash; an empty
table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLOCK_BYTES, blocks, bytes_view, mix64, span_hashes, word_bytes, word_spans

SPACE = (9, 10, 11, 12, 13, 32)


def trees(data: np.ndarray, off: np.ndarray, span_words: int, section_paragraphs: int):
    """For every row: (root hex, [(section digest, [(paragraph digest, span hashes, span sizes)])])."""
    is_word = word_bytes(lambda b: b not in SPACE)
    for i, j in blocks(off, BLOCK_BYTES // 2):
        part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        s, e, row = word_spans(part, o, is_word)
        cut = (mix64(span_hashes(part, s, e) + np.uint64(1)) % np.uint64(span_words)) == 0
        lines = np.flatnonzero(part == 10) + 1
        ends = np.unique(np.concatenate([e[cut], lines, o[1:]]))
        ends = ends[ends > 0]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        h = span_hashes(part, starts, ends)
        closes = np.isin(ends, lines)
        first = np.searchsorted(starts, o[:-1])
        last = np.searchsorted(starts, o[1:])
        for k in range(j - i):
            a, b = first[k], last[k]
            hs, sizes, close = h[a:b], (ends[a:b] - starts[a:b]), closes[a:b]
            bounds = [0, *(np.flatnonzero(close) + 1).tolist()]
            if bounds[-1] != b - a:
                bounds.append(b - a)
            sections, group = [], []
            for x, y in zip(bounds, bounds[1:]):
                digest = hashlib.blake2b(hs[x:y].tobytes(), digest_size=16).digest()
                group.append((digest, hs[x:y].tolist(), sizes[x:y].tolist()))
                if digest[0] % section_paragraphs == 0:
                    sections.append(group)
                    group = []
            if group:
                sections.append(group)
            done = [(hashlib.blake2b(b"".join(p[0] for p in g), digest_size=16).digest(), g) for g in sections]
            yield hashlib.sha256(b"".join(d for d, _ in done)).hexdigest()[:32], done


def compare(x, y) -> tuple[float, int]:
    """Likeness of two trees (0 to 1) and the first differing byte of the first one."""
    if x[0] == y[0]:
        return 1.0, -1
    same = total = at = 0
    left, right, changed = Counter(), Counter(), -1
    others = Counter(p[0] for _, g in y[1] for p in g)
    kept = Counter()
    ours = [p for _, g in x[1] for p in g]
    theirs = [p for _, g in y[1] for p in g]
    for n, p in enumerate(ours):
        size = sum(p[2])
        total += size
        if changed < 0 and (n >= len(theirs) or theirs[n][0] != p[0]):
            changed = at
        at += size
        if others[p[0]] > kept[p[0]]:        # an equal branch is not descended into
            kept[p[0]] += 1
            same += size
        else:
            left.update(zip(p[1], p[2]))
    for p in theirs:
        total += sum(p[2])
        if kept[p[0]] > 0:
            kept[p[0]] -= 1
        else:
            right.update(zip(p[1], p[2]))
    same += sum(size * min(c, right[(h, size)]) for (h, size), c in left.items() if (h, size) in right)
    return (2.0 * same / total if total else 1.0), (changed if changed >= 0 else at)


def fingerprints(pairs: DataFrame, *, span_words: int = 4, section_paragraphs: int = 4) -> DataFrame:
    """``pairs`` (doc_id, text, edited, following: strings) -> roots and likenesses of text to the other two."""
    src = pairs.select("doc_id", *[F.coalesce(F.col(c).cast("binary"), F.lit(b"")).alias(c)
                                   for c in ("text", "edited", "following")])
    schema = T.StructType([src.schema["doc_id"], T.StructField("fingerprint", T.StringType()),
                           T.StructField("edited_fingerprint", T.StringType()),
                           T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
                           T.StructField("changed_at", T.LongType()), T.StructField("n_sections", T.IntegerType())])

    def run(batches):
        for b in batches:
            sides = [trees(*bytes_view(b.column(c)), span_words, section_paragraphs)
                     for c in ("text", "edited", "following")]
            out = []
            for x, y, z in zip(*sides):
                near, at = compare(x, y)
                out.append((x[0], y[0], near, compare(x, z)[0], at, len(x[1])))
            cols = list(zip(*out)) if out else [()] * 6
            kinds = [pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             schema.names)

    return src.mapInArrow(run, schema)


def with_following(docs: DataFrame, *, rows_per_bucket: int = 2000) -> DataFrame:
    """``doc_id``, ``text`` and ``following``: the text of the next document by id (after the last: the first).

    Ids are dealt into ranges of about ``rows_per_bucket`` rows (their
    boundaries are the only thing the driver sees: one id per range); the next text
    is a window value inside a range, and the first text of the next range
    that has rows at its end.  Both use one exchange of the texts."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = d.count()
    k = max(1, n // rows_per_bucket)
    cuts = []
    if k > 1:
        cuts = d.select(F.percentile_approx("doc_id", [i / k for i in range(1, k)], 10 * k)).first()[0] or []
    cuts = sorted(set(cuts))
    edges = F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    bucket = F.coalesce(F.size(F.filter(edges, lambda c: c < F.col("doc_id"))), F.lit(0))
    d = d.withColumn("bucket", bucket).withColumn("tie", F.xxhash64("text"))
    order = Window.partitionBy("bucket").orderBy("doc_id", "tie")
    led = d.withColumn("following", F.lead("text").over(order))
    heads = (d.withColumn("n", F.row_number().over(order)).where("n = 1").select("bucket", F.col("text").alias("head")))
    here = [r[0] for r in heads.select("bucket").orderBy("bucket").collect()]     # one number per range
    before = {b: here[i - 1] for i, b in enumerate(here)}
    if before:
        prev = F.element_at(F.create_map(*[F.lit(v) for kv in before.items() for v in kv]), F.col("bucket"))
    else:
        prev = F.col("bucket")
    heads = heads.select(prev.alias("bucket"), "head")
    return (led.join(heads, "bucket", "left")
            .select("doc_id", "text", F.coalesce("following", "head").alias("following")))


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = with_following(docs)
    q = F.floor(F.length("text") / 4).cast("int")
    pairs = pairs.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - q),
                                                F.substring("following", F.lit(1), q)))
    pairs = pairs.withColumn("doc_id", F.struct("doc_id", F.length("text").cast("long").alias("n_chars"),
                                                F.sha2(F.col("edited"), 256).alias("edited_sha256")))
    out = fingerprints(pairs)
    return out.select("doc_id.doc_id", "doc_id.n_chars", "doc_id.edited_sha256", "fingerprint", "edited_fingerprint",
                      "near_edited", "near_next", "changed_at", "n_sections")
