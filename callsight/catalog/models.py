"""Fitted models (rows-only checks) and the hour/channel recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_basic
from ..operators.evaluation import split_train_test
from ..plans import order_model, recommend, text_model
from ..plans.model_cache import fitted
from ..sources.adapter import documents, labelled_notes, note_texts, table
from .registry import contacts, register, with_extra, ORACLE
from .scoring import _BUCKET, RATES_SQL
from .text import CLEAN_BASIC_SQL


# ---- M15-M21, M27, M28, R7 (fitted: no SQL oracle) -----------------------------------

def _notes(spark, sf_dir):
    """Notes = whole document texts, label = the document quality flag."""
    return labelled_notes(spark, sf_dir).withColumnRenamed("doc_id", "interaction_id")


def _stamp(spark, sf_dir, *names):
    """Paths, sizes and times of the input files: rewritten data is fitted anew."""
    files = [table(spark, sf_dir, n).select("_metadata.file_path", "_metadata.file_size",
                                            "_metadata.file_modification_time").distinct() for n in names]
    return tuple(f.agg(F.bit_xor(F.xxhash64(*f.columns))).first()[0] for f in files)


def _text_model(spark, sf_dir, notebook=False):
    return fitted(spark, ("text", sf_dir, notebook, _stamp(spark, sf_dir, "documents", "labels")), lambda: text_model.train_text_model(
        _notes(spark, sf_dir), "note", "quality", "interaction_id", notebook=notebook))


def _order_model(spark, sf_dir, classifier="lr", notebook=False):
    # the registered queries train on the whole table; the studied code's
    # 40 % memory-saving sample stays available as ``sample_fraction=0.4``
    kw = {"sample_fraction": None, "max_iter": 20} if notebook else {"sample_fraction": None}
    return fitted(spark, ("orders", sf_dir, classifier, notebook, _stamp(spark, sf_dir, "events")), lambda: order_model.train_order_model(
        contacts(spark, sf_dir), classifier=classifier, **kw))


@register("train_text_model")
def q_train_text_model(spark, sf_dir):
    return _text_model(spark, sf_dir)[0]


@register("train_text_model_notebook")
def q_train_text_model_notebook(spark, sf_dir):
    """Notebook pipeline (NFKD cleaner, space tokenizer, notebook stop
    words, minDF 5), on all labelled notes."""
    return _text_model(spark, sf_dir, notebook=True)[0]


@register("classify_notes")
def q_classify_notes(spark, sf_dir):
    """M28 in batch: the fitted note model classifies every non-blank document."""
    _, _, model, labels = _text_model(spark, sf_dir)
    notes = documents(spark, sf_dir).withColumnsRenamed({"doc_id": "interaction_id", "text": "note"})
    return text_model.classify_notes(model, notes, labels, "note", "interaction_id", "quality")


@register("train_order_model")
def q_train_order_model(spark, sf_dir):
    return _order_model(spark, sf_dir)[0]


@register("train_order_model_notebook")
def q_train_order_model_notebook(spark, sf_dir):
    """One pipeline, no 40 % sample, maxIter 20, on all contacts."""
    return _order_model(spark, sf_dir, notebook=True)[0]


@register("predict_orders")
def q_predict_orders(spark, sf_dir):
    """M27 in batch: every contact scored by the fitted order model."""
    model = _order_model(spark, sf_dir)[2]
    return order_model.predict_orders(model, contacts(spark, sf_dir))


@register("random_forest_orders")
def q_random_forest_orders(spark, sf_dir):
    """The order model with a random forest."""
    return _order_model(spark, sf_dir, classifier="rf")[0]


@register("recommend_actions_model")
def q_recommend_actions_model(spark, sf_dir):
    """H1-H5 scored by the fitted order model (one plan for all contacts)."""
    model = _order_model(spark, sf_dir)[2]
    reqs = recommend.requests_from_contacts(contacts(spark, sf_dir))
    return recommend.recommend_actions(reqs, recommend.model_scorer(model))


@register("train_text_model_contacts")
def q_train_text_model_contacts(spark, sf_dir):
    """M18 on the contact table: the agent's verdict from the note.  No query scores with this model: its metrics are kept."""
    key = ("text", sf_dir, "contacts", _stamp(spark, sf_dir, "documents", "events"))
    return fitted(spark, key, lambda: text_model.train_text_model_by_ref(
        contacts(spark, sf_dir, note_ref=True), note_texts(spark, sf_dir, clean_basic))[:2])[0]


# ---- what the fitted queries read and return, without the fitted values (SQL oracle) ----

def _supports(data, label):
    """Rows per split and class."""
    train, test = split_train_test(data, "interaction_id", 80)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split", F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))


_SPLIT_SQL = f"CASE WHEN {_BUCKET.format(x='{id}')} < 80 THEN 'train' ELSE 'test' END AS split"


@register("text_model_supports", raw_sql=f"""
SELECT {_SPLIT_SQL.format(id='d.doc_id')}, CAST(l.quality AS VARCHAR) AS label, count(*) AS rows
FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL GROUP BY ALL""")
def q_text_model_supports(spark, sf_dir):
    return _supports(text_model.prepare_notes(_notes(spark, sf_dir), "note", "quality"), "quality")


@register("contact_model_supports", f"""
SELECT {_SPLIT_SQL.format(id='interaction_id')}, agent_result AS label, count(*) AS rows
FROM contacts GROUP BY ALL""")
def q_contact_model_supports(spark, sf_dir):
    return _supports(contacts(spark, sf_dir), "agent_result")


@register("order_model_supports", f"""
SELECT {_SPLIT_SQL.format(id='interaction_id')}, CAST(has_order AS DOUBLE) AS label, count(*) AS rows
FROM contacts WHERE has_order IS NOT NULL GROUP BY ALL""")
def q_order_model_supports(spark, sf_dir):
    return _supports(order_model.prepare_orders(contacts(spark, sf_dir)), "label")


@register("classified_note_ids", raw_sql=f"""
SELECT doc_id AS interaction_id FROM documents WHERE length({CLEAN_BASIC_SQL.format(x='text')}) > 0""")
def q_classified_note_ids(spark, sf_dir):
    """The notes that M28 scores: every non-blank one."""
    return q_classify_notes(spark, sf_dir).select("interaction_id")


@register("predicted_order_ids", "SELECT interaction_id FROM contacts")
def q_predicted_order_ids(spark, sf_dir):
    """The contacts that M27 scores: all of them."""
    return q_predict_orders(spark, sf_dir).select("interaction_id")


# ---- H1-H5, W4 with measured order rates (SQL oracle) ----------------------

_PROFILES = RATES_SQL + """
, req AS (SELECT interaction_id AS request_id, channel, agent_result, CAST(hour(contact_ts) AS INTEGER) AS hour
          FROM contacts),
 prof AS (SELECT DISTINCT channel, agent_result, hour FROM req),
 g AS (SELECT channel, agent_result, CAST(unnest(range(9, 22)) AS INTEGER) AS hour
       FROM (SELECT DISTINCT channel, agent_result FROM prof)),
 gs AS (SELECT g.*, coalesce(rates.p, (SELECT o FROM overall)) AS p FROM g LEFT JOIN rates USING (channel, agent_result, hour)),
 rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY channel, agent_result ORDER BY p DESC, hour DESC)
                  AS INTEGER) AS rank FROM gs),
 top AS (SELECT *, printf('%02d:00 (~%.1f%%)', hour, p * 100) AS label FROM rk WHERE rank <= 3)
"""


def _rates(spark, sf_dir):
    return recommend.rate_scorer(contacts(spark, sf_dir).withColumn("hour", F.hour("contact_ts")))


@register("score_hours", _PROFILES + "SELECT channel, agent_result, hour, round(p, 9) AS p FROM gs")
def q_score_hours(spark, sf_dir):
    reqs = recommend.requests_from_contacts(contacts(spark, sf_dir))
    out = recommend.score_hours(reqs, _rates(spark, sf_dir))
    return out.select("channel", "agent_result", "hour", F.round("p", 9).alias("p"))


@register("best_hours", _PROFILES + "SELECT channel, agent_result, rank, hour, round(p, 9) AS p, label FROM top")
def q_best_hours(spark, sf_dir):
    reqs = recommend.requests_from_contacts(contacts(spark, sf_dir))
    out = recommend.best_hours(recommend.score_hours(reqs, _rates(spark, sf_dir)))
    return out.select("channel", "agent_result", "rank", "hour", F.round("p", 9).alias("p"), "label")


@register("recommend_actions")
def q_recommend_actions(spark, sf_dir):
    reqs = recommend.requests_from_contacts(contacts(spark, sf_dir))
    out = recommend.recommend_actions(reqs, _rates(spark, sf_dir))
    return out.withColumns({c: F.round(c, 9) for c in ("p_current", "p_other", "best_p")})


ORACLE["recommend_actions"] = with_extra(_PROFILES + f"""
, summ AS (SELECT channel, agent_result, string_agg(label, ', ' ORDER BY rank) AS best_hours_text,
                  arg_min(hour, rank) AS best_hour, arg_min(p, rank) AS best_p FROM top GROUP BY ALL),
 pr AS (SELECT *, CASE WHEN channel = 'llamada' THEN 'whatsapp' ELSE 'llamada' END AS other_channel FROM prof),
 sc AS (SELECT pr.*, coalesce(a.p, (SELECT o FROM overall)) AS p_current, coalesce(b.p, (SELECT o FROM overall)) AS p_other
        FROM pr LEFT JOIN rates a ON a.channel = pr.channel AND a.agent_result = pr.agent_result AND a.hour = pr.hour
                LEFT JOIN rates b ON b.channel = pr.other_channel AND b.agent_result = pr.agent_result AND b.hour = pr.hour),
 j AS (SELECT sc.*, summ.best_hours_text, summ.best_hour, summ.best_p FROM sc LEFT JOIN summ USING (channel, agent_result)),
 a AS (SELECT *, list_filter([CASE WHEN best_hour <> hour AND best_p > p_current + 0.03::DOUBLE
                                   THEN printf('reschedule to %02d:00 (~%.1f%%)', best_hour, best_p * 100) END,
                              CASE WHEN p_other > p_current + 0.03::DOUBLE THEN printf('switch to %s (~%.1f%%)', other_channel, p_other * 100) END],
                             lambda x: x IS NOT NULL) AS acts FROM j)
SELECT req.request_id, req.channel, req.agent_result, req.hour, a.other_channel,
       round(a.p_current, 9) AS p_current, round(a.p_other, 9) AS p_other, a.best_hours_text, a.best_hour,
       round(a.best_p, 9) AS best_p,
       CASE WHEN len(acts) > 0 THEN array_to_string(acts, '; ') ELSE 'keep' END AS actions,
       CASE WHEN a.p_current > 0.5 THEN 'Sí generaría pedido' ELSE 'No generaría pedido' END AS predicted_text
FROM req LEFT JOIN a USING (channel, agent_result, hour)""")
