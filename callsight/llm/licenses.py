"""License scan with a positional index of rare words.

Templates are word sequences.  Their words' document frequencies are counted
over all documents; each template is indexed by its ``rare`` highest-IDF
words with their positions (a base phrase by all of its words).  A file's
occurrence of an indexed word at position p votes for the template starting
at p minus the word's position; votes are intersected by that start.  A base
phrase needs every word; a template needs ``least`` of its indexed words at
one start and then one of its mandatory key phrases, word for word, inside
the span it covers.

Defined cases: a NULL or empty text has no words, no label and score 0;
words are judged by their bytes after A-Z are lower-cased; repeated rows are
judged each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_rows, blocks, bytes_view, lower_ascii, row_schema, span_hashes, word_bytes, word_spans

# The phrases of the contract.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Notices from the public licence texts: label, words, mandatory key phrases.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
     " associated documentation files", ("permission is hereby granted free of charge",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in"
     " compliance with the license", ("may not use this file except in compliance",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"
     " that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license version 3",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
     " general public license", ("gnu general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("released into the public domain",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution",)),
)
IS_WORD = word_bytes(lambda b: b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122)
LOWER = lower_ascii()


def _hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def _words(batch):
    """Blocks of (first row, rows, lower-cased bytes, word starts, ends, rows, hashes) of a batch."""
    data, off = bytes_view(batch.column("text"))
    for i, j in blocks(off):
        part, o = LOWER[data[off[i]:off[j]]], off[i:j + 1] - off[i]
        s, e, row = word_spans(part, o, IS_WORD)
        yield i, j, part, s, e, row, span_hashes(part, s, e)


def document_frequencies(docs: DataFrame, words: list[str], text_col: str = "text") -> dict[str, int]:
    """In how many documents each of the given words stands (a fixed list; one number per word to the driver)."""
    keys = np.array([_hash(w) for w in words], np.uint64)
    by = np.argsort(keys)
    ordered = keys[by]

    def run(batches):
        total = np.zeros(len(ordered) + 1, np.int64)
        for b in batches:
            for i, j, _, _, _, row, h in _words(b):
                at = np.minimum(np.searchsorted(ordered, h), len(ordered) - 1)
                hit = ordered[at] == h
                pair = np.unique(row[hit] * len(ordered) + at[hit])
                total[:-1] += np.bincount(pair % len(ordered), minlength=len(ordered))
                total[-1] += j - i
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["w", "n"])

    found = as_rows(docs, [], text_col).select("text").mapInArrow(run, "w int, n long")
    got = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.sum("n").alias("n")).collect()}
    out = {words[by[k]]: got.get(k, 0) or 0 for k in range(len(words))}
    out[""] = got.get(len(words), 0) or 0
    return out


def scan(docs: DataFrame, *, id_cols=("doc_id",), text_col: str = "text", rare: int = 6, least: float = 0.67) -> DataFrame:
    """``row`` (id columns) and n_words, n_base, first_word, last_word, base_labels, labels, score,
    spans (label, first word, last word) of every match."""
    notices = [(label, text.split(), [k.split() for k in keys]) for label, text, keys in NOTICES]
    vocabulary = sorted({w for _, ws, _ in notices for w in ws} | {w for p, _ in BASE for w in p.split()})
    df = document_frequencies(docs, vocabulary, text_col)
    n_docs = df.pop("")
    idf = {w: math.log((n_docs + 1) / (c + 1)) for w, c in df.items()}
    templates = [(label, p.split(), list(range(len(p.split()))), None) for p, label in BASE]
    for label, ws, keys in notices:
        first = {w: k for k, w in reversed(list(enumerate(ws)))}
        chosen = sorted(first, key=lambda w: (-idf[w], first[w]))[:rare]
        templates.append((label, ws, sorted(first[w] for w in chosen), keys))
    postings: dict[int, list[tuple[int, int]]] = {}
    for t, (_, ws, at, _) in enumerate(templates):
        for k in at:
            postings.setdefault(_hash(ws[k]), []).append((t, k))
    need = [len(at) if keys is None else math.ceil(least * len(at)) for _, _, at, keys in templates]
    src = as_rows(docs, list(id_cols), text_col)
    span_type = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
                                          T.StructField("last", T.LongType())]))
    schema = row_schema(src, n_words=T.LongType(), n_base=T.LongType(), first_word=T.LongType(),
                        last_word=T.LongType(), base_labels=T.StringType(), labels=T.StringType(),
                        score=T.DoubleType(), spans=span_type)

    def run(batches):
        keys = np.array(sorted(postings), np.uint64)
        for b in batches:
            out = []
            for i, j, part, s, e, row, h in _words(b):
                begin = np.searchsorted(row, np.arange(j - i + 1))
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hits = np.flatnonzero(keys[at] == h)
                votes: dict[int, dict[tuple[int, int], int]] = {}
                for p in hits.tolist():
                    r = int(row[p])
                    mine = votes.setdefault(r, {})
                    for t, k in postings[int(h[p])]:
                        start = (t, p - int(begin[r]) - k)
                        mine[start] = mine.get(start, 0) + 1

                def word(x):
                    return part[s[x]:e[x]].tobytes().decode("utf-8", "replace")

                for r in range(j - i):
                    a, z = int(begin[r]), int(begin[r + 1])
                    base, found, score = [], [], 0.0
                    for (t, start), n in sorted(votes.get(r, {}).items()):
                        label, ws, index, must = templates[t]
                        if n < need[t]:
                            continue
                        if must is None:
                            if start >= 0 and all(word(a + start + k) == w for k, w in enumerate(ws)):
                                base.append((label, start, start + len(ws) - 1))
                                score = 1.0
                            continue
                        lo, hi = max(a, a + start), min(z, a + start + len(ws))
                        text = [word(x) for x in range(lo, hi)]
                        if any(text[x:x + len(m)] == m for m in must for x in range(len(text) - len(m) + 1)):
                            found.append((label, lo - a, hi - a - 1))
                            score = max(score, n / len(index))
                    places = [x[1] for x in base]
                    out.append((z - a, len(base), min(places, default=None), max(places, default=None),
                                ",".join(sorted({x[0] for x in base})),
                                ",".join(sorted({x[0] for x in base} | {x[0] for x in found})), score,
                                [dict(zip(("label", "first", "last"), x)) for x in base + found]))
            cols = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(
                pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([b.column("row"), *[pa.array(list(c), k) for c, k in zip(cols, kinds)]],
                                             schema.names)

    return src.mapInArrow(run, schema)


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs).select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                             "score")
