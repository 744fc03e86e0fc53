"""Text queries: tokens, n-grams, vocabulary, IDF, TF-IDF, top words, cloud terms.

Corpus queries read ``documents`` (whole texts); per-class queries read the
notes of the contact table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stopwords as sw
from ..functions import text as tx
from ..operators import collocations as coll
from ..operators import words as W
from ..sources.adapter import documents, note_texts, table
from ..sources.contacts import materialize, materialize_files
from .registry import contacts, register, with_extra

# DuckDB text of the cleaners (same rules as functions.text)
CLEAN_BASIC_SQL = ("trim(regexp_replace(regexp_replace(lower({x}), '[^a-záéíóúüñ\\s]', ' ', 'g'),"
                   " '\\s+', ' ', 'g'))")
CLEAN_NFD_SQL = ("trim(regexp_replace(regexp_replace(strip_accents(lower({x})), '[^a-zñáéíóúü0-9\\s]', ' ', 'g'),"
                 " '\\s+', ' ', 'g'))")
TOKENS_SQL = "list_filter(string_split(" + CLEAN_BASIC_SQL + ", ' '), lambda t: length(t) >= 2)"


def _doc_tokens(spark, sf_dir, pattern=W.UNICODE_NONWORD):
    docs = documents(spark, sf_dir)
    clean = tx.clean_basic("text")
    toks = W.tokenize_cleaned(clean) if pattern == W.UNICODE_NONWORD else W.tokenize(clean, pattern, lower=False)
    return docs.select("doc_id", toks.alias("tokens"))


@register("tokens", raw_sql=f"""
WITH c AS (SELECT doc_id, {TOKENS_SQL.format(x='text')} AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS token_text FROM c""")
def q_tokens(spark, sf_dir):
    t = _doc_tokens(spark, sf_dir)
    return t.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("token_text"))


@register("tokens_ascii", raw_sql=f"""
WITH c AS (SELECT doc_id, list_filter(regexp_split_to_array({CLEAN_BASIC_SQL.format(x='text')}, '\\W+'),
                                      lambda t: length(t) >= 2) AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS token_text FROM c""")
def q_tokens_ascii(spark, sf_dir):
    t = _doc_tokens(spark, sf_dir, W.ASCII_NONWORD)
    return t.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("token_text"))


@register("ngrams", raw_sql=f"""
WITH c AS (SELECT doc_id, {TOKENS_SQL.format(x='text')} AS t FROM documents),
 g AS (SELECT doc_id, list_transform(range(0, len(t) - 1), lambda i: array_to_string(t[i + 1:i + 2], ' ')) AS g
       FROM c)
SELECT doc_id, CAST(len(g) AS INTEGER) AS n_ngrams, array_to_string(g, '|') AS ngram_text FROM g""")
def q_ngrams(spark, sf_dir):
    t = _doc_tokens(spark, sf_dir)
    g = t.select("doc_id", W.ngrams("tokens", 2).alias("g"))
    return g.select("doc_id", F.size("g").alias("n_ngrams"), F.array_join("g", "|").alias("ngram_text"))


def _tf(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", tx.clean_basic("text").alias("clean"))
    words = W.explode_cleaned(docs, "clean", ["doc_id"], 2)
    words = W.remove_stopwords(words, W.stopword_frame(spark, sw.text_model_stopwords()), case_sensitive=True,
                               fold_accents=True)
    return W.term_frequencies(words, "doc_id")


_TF_SQL = f"""
WITH tok AS (SELECT doc_id, unnest({TOKENS_SQL.format(x='text')}) AS word FROM documents),
 f AS (SELECT * FROM tok
       WHERE NOT list_contains({sw.sql_list(sw.folded(sw.text_model_stopwords()))}, strip_accents(lower(word)))),
 tf AS (SELECT doc_id, word, count(*) AS tf FROM f GROUP BY ALL),
 st AS (SELECT word, CAST(sum(tf) AS BIGINT) AS term_freq, count(*) AS doc_freq FROM tf GROUP BY word),
 idf AS (SELECT word, doc_freq,
                ln(((SELECT count(*) FROM documents) + 1.0)::DOUBLE / (doc_freq + 1.0)::DOUBLE) AS idf FROM st)
"""


@register("term_counts", raw_sql=_TF_SQL + "SELECT * FROM st")
def q_term_counts(spark, sf_dir):
    return W.term_counts(_tf(spark, sf_dir))


@register("idf_weights", raw_sql=_TF_SQL + "SELECT word, doc_freq, round(idf, 9) AS idf FROM idf")
def q_idf_weights(spark, sf_dir):
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    idf = W.idf_weights(W.term_counts(_tf(spark, sf_dir)), n_docs)
    return idf.select("word", "doc_freq", F.round("idf", 9).alias("idf"))


@register("tfidf", raw_sql=_TF_SQL + """
SELECT tf.doc_id, tf.word, tf.tf, round(tf.tf * idf.idf, 9) AS tfidf FROM tf JOIN idf USING (word)""")
def q_tfidf(spark, sf_dir):
    tf = materialize_files(_tf(spark, sf_dir))           # read by the weights, the frequent and the other terms: one scan of the texts
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    idf = W.idf_weights(W.term_counts(tf), n_docs)
    return W.tfidf(tf, idf).select("doc_id", "word", "tf", F.round("tfidf", 9).alias("tfidf"))


_COVERED = (1000, 1 << 18)      # a small vocabulary, and the text model's


@register("vocabulary_coverage", raw_sql=_TF_SQL + ", r AS (SELECT *, row_number() OVER (ORDER BY term_freq DESC, word) AS r FROM st)\n"
          + "\nUNION ALL ".join(f"""SELECT CAST({v} AS BIGINT) AS vocab_size, '{name}_left_out' AS metric,
       coalesce({total} FILTER (WHERE r > {v}), 0)::DOUBLE AS value FROM r"""
                                for v in _COVERED for name, total in (("terms", "count(*)"), ("occurrences", "sum(term_freq)"))))
def q_vocabulary_coverage(spark, sf_dir):
    stats = materialize(W.term_counts(_tf(spark, sf_dir)))         # counted once for both sizes
    small, large = (W.vocabulary_coverage(stats, v).select(F.lit(v).cast("long").alias("vocab_size"), "metric", "value") for v in _COVERED)
    return small.unionByName(large)


@register("top_words")
def q_top_words(spark, sf_dir):
    refs = contacts(spark, sf_dir, note_ref=True)
    counts = W.class_word_counts_by_ref(refs, note_texts(spark, sf_dir, tx.clean_nb_nfd))
    return W.top_words(None, counts=counts, n=30)


from .registry import ORACLE  # noqa: E402

ORACLE["top_words"] = with_extra(f"""
, w AS (SELECT agent_result, unnest(string_split({CLEAN_NFD_SQL.format(x='note')}, ' ')) AS word FROM contacts),
 c AS (SELECT agent_result, word, count(*) AS frequency FROM w WHERE length(word) > 0 GROUP BY ALL),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY agent_result ORDER BY frequency DESC, word ASC)
                 AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 30""")


@register("cloud_terms")
def q_cloud_terms(spark, sf_dir):
    refs = contacts(spark, sf_dir, note_ref=True)
    stop = W.stopword_frame(spark, sw.cloud_stopwords())
    counts = W.class_word_counts_by_ref(refs, note_texts(spark, sf_dir, tx.clean_basic), min_len=2, stop=stop)
    out = W.cloud_terms(None, None, None, max_words=80, counts=counts)
    return out.withColumn("weight", F.round("weight", 9))


ORACLE["cloud_terms"] = with_extra(f"""
, w AS (SELECT agent_result, unnest(string_split({CLEAN_BASIC_SQL.format(x='note')}, ' ')) AS word
        FROM contacts),
 f AS (SELECT * FROM w WHERE length(word) >= 2
         AND NOT list_contains({sw.sql_list(sw.cloud_stopwords())}, lower(word))),
 c AS (SELECT agent_result, word, count(*) AS frequency FROM f GROUP BY ALL),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY agent_result ORDER BY frequency DESC, word ASC)
                 AS INTEGER) AS rank FROM c),
 t AS (SELECT * FROM r WHERE rank <= 80)
SELECT *, round(frequency / max(frequency) OVER (PARTITION BY agent_result), 9) AS weight FROM t""")


@register("cloud_pairs")
def q_cloud_pairs(spark, sf_dir):
    refs = contacts(spark, sf_dir, note_ref=True)
    classes = coll.class_values(refs)
    pairs = coll.pair_rows(refs, note_texts(spark, sf_dir, tx.clean_basic), classes=classes)
    out = coll.cloud_pairs(pairs, sw.cloud_stopwords(), max_words=100, classes=classes)
    return out.withColumn("weight", F.round("weight", 9))


def _llr_sql(c12: str, c1: str, c2: str, n: str) -> str:
    def part(k, m, x):
        return f"(ln(greatest({x}, 1e-10::DOUBLE)) * {k} + ln(greatest(1 - ({x}), 1e-10::DOUBLE)) * ({m} - {k}))"
    p, p1, p2 = f"{c2} / {n}", f"{c12} / {c1}", f"({c2} - {c12}) / nullif({n} - {c1}, 0)"
    return (f"CASE WHEN {n} <= {c1} OR {n} <= {c2} THEN 0 ELSE -2 * ({part(c12, c1, p)} + {part(f'({c2} - {c12})', f'({n} - {c1})', p)}"
            f" - {part(c12, c1, p1)} - {part(f'({c2} - {c12})', f'({n} - {c1})', p2)}) END")


ORACLE["cloud_pairs"] = with_extra(f"""
, t AS (SELECT agent_result, {TOKENS_SQL.format(x='note')} AS w FROM contacts),
 r AS (SELECT agent_result, unnest(w) AS word, unnest(list_append(w[2:], NULL)) AS next FROM t),
 s AS (SELECT unnest({sw.sql_list(sw.cloud_stopwords())}) AS stop),
 g AS MATERIALIZED (
   SELECT agent_result, word, CASE WHEN next NOT IN (SELECT stop FROM s) THEN next END AS next, count(*) AS n
   FROM r WHERE word NOT IN (SELECT stop FROM s) GROUP BY ALL),
 u AS MATERIALIZED (SELECT agent_result, word, sum(n) AS n FROM g GROUP BY ALL),
 f AS MATERIALIZED (
   SELECT u.agent_result, u.word, coalesce(v.word, u.word) AS form, u.n FROM u
   LEFT JOIN (SELECT agent_result || '|' || word || 's' AS plural, word FROM u WHERE word NOT LIKE '%s') v
   ON v.plural = u.agent_result || '|' || u.word),
 c AS MATERIALIZED (SELECT agent_result, form, sum(n) AS c FROM f GROUP BY ALL),
 tot AS MATERIALIZED (SELECT agent_result, sum(n) AS total FROM u GROUP BY ALL),
 wf AS MATERIALIZED (
   SELECT f.agent_result || '|' || f.word AS key, f.form, k.c FROM f
   JOIN (SELECT agent_result || '|' || form AS key, c FROM c) k ON k.key = f.agent_result || '|' || f.form),
 b AS MATERIALIZED (SELECT agent_result, word, next, sum(n) AS n FROM g WHERE next IS NOT NULL GROUP BY ALL),
 bf AS MATERIALIZED (
   SELECT b.agent_result, b.word, coalesce(v.next, b.next) AS second, sum(b.n) AS n FROM b
   LEFT JOIN (SELECT agent_result || '|' || word || '|' || next || 's' AS plural, next FROM b WHERE next NOT LIKE '%s') v
   ON v.plural = b.agent_result || '|' || b.word || '|' || b.next GROUP BY ALL),
 one AS MATERIALIZED (SELECT bf.*, wf.form AS form1, CAST(wf.c AS DOUBLE) AS c1 FROM bf JOIN wf ON wf.key = bf.agent_result || '|' || bf.word),
 x AS MATERIALIZED (
   SELECT one.*, wf.form AS form2, CAST(wf.c AS DOUBLE) AS c2, CAST(one.n AS DOUBLE) AS c12,
          (SELECT max(CAST(total AS DOUBLE)) FROM tot WHERE tot.agent_result = one.agent_result) AS nn
   FROM one JOIN wf ON wf.key = one.agent_result || '|' || one.second),
 strong AS MATERIALIZED (SELECT * FROM x WHERE {_llr_sql('c12', 'c1', 'c2', 'nn')} > 30),
 taken AS (SELECT agent_result, form, sum(n) AS n FROM (SELECT agent_result, unnest([form1, form2]) AS form, n FROM strong) GROUP BY ALL),
 terms AS (SELECT c.agent_result, c.form AS term, FALSE AS is_pair, CAST(c.c - coalesce(taken.n, 0) AS BIGINT) AS frequency
           FROM c LEFT JOIN taken ON taken.agent_result = c.agent_result AND taken.form = c.form
           UNION ALL SELECT agent_result, word || ' ' || second, TRUE, CAST(n AS BIGINT) FROM strong),
 k AS (SELECT *, CAST(row_number() OVER (PARTITION BY agent_result ORDER BY frequency DESC, term ASC) AS INTEGER) AS rank
       FROM terms WHERE frequency > 0),
 top AS (SELECT * FROM k WHERE rank <= 100)
SELECT *, round(frequency / max(frequency) OVER (PARTITION BY agent_result), 9) AS weight FROM top""")
