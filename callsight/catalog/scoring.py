"""Attribution, rule scores, numbering, splits, indexing and evaluation."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import attribution, evaluation, numbering, rules
from ..plans.recommend import rate_scorer
from ..sources.adapter import orders_from_events, raw_contacts
from ..sources.contacts import checkpoint_dir
from .registry import ORACLE, TS_TEXT, contacts, register

_MD5_U32 = "('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8))::BIGINT"


# Order rate per channel, result and hour, drawn towards the overall
# rate by ten contacts; a profile without contacts has the overall rate
RATES_SQL = """
, overall AS (SELECT sum(has_order)::DOUBLE / count(has_order)::DOUBLE AS o FROM contacts),
 rates AS (SELECT channel, agent_result, CAST(hour(contact_ts) AS INTEGER) AS hour,
                  (sum(has_order)::DOUBLE + 10.0::DOUBLE * max(o)) / (count(has_order)::DOUBLE + 10.0::DOUBLE) AS p
           FROM contacts, overall GROUP BY ALL)
"""


# ---- J4 ----------------------------------------------------------------------------

_ATTRIBUTE_SQL = """
, c AS (SELECT interaction_id, client_id, contact_ts FROM contacts),
 m AS (SELECT c.interaction_id, c.client_id, c.contact_ts, count(o.order_id) AS n_orders,
              round(sum(o.order_amount), 2) AS orders_amount,
              min(CASE WHEN o.order_id IS NOT NULL THEN {'t': o.order_ts, 'id': o.order_id} END).id
                AS first_order_id
       FROM c LEFT JOIN orders_24h o ON c.client_id = o.client_id AND c.client_id <> 'C000000000'
            AND c.contact_ts <> TIMESTAMP '2025-01-01 00:00:00' AND o.order_ts >= c.contact_ts AND o.order_ts <= c.contact_ts + INTERVAL 24 HOUR
       GROUP BY ALL)
SELECT interaction_id, client_id, strftime(contact_ts, '%Y-%m-%d %H:%M:%S.%f') AS contact_ts,
       n_orders, orders_amount, first_order_id, CAST(n_orders > 0 AS INTEGER) AS attributed
FROM m"""


def _readable(out):
    return out.withColumns({"contact_ts": F.date_format("contact_ts", TS_TEXT),
                            "orders_amount": F.round("orders_amount", 2)})


@register("attribute_orders", _ATTRIBUTE_SQL)
def q_attribute_orders(spark, sf_dir):
    return _readable(attribution.attribute_orders(contacts(spark, sf_dir), orders_from_events(spark, sf_dir), 24))


@register("attribute_orders_bucketed", _ATTRIBUTE_SQL)
def q_attribute_orders_bucketed(spark, sf_dir):
    """J4 over contacts stored once by the join's key: they are read without an exchange."""
    name = f"contacts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = attribution.bucketed_contacts(contacts(spark, sf_dir), name, f"{checkpoint_dir(spark)}/{name}", buckets)
    return _readable(attribution.attribute_orders(stored, orders_from_events(spark, sf_dir), 24))


# ---- G5, W5 -------------------------------------------------------------------

@register("order_numbers", f"""
, o AS (SELECT interaction_id FROM contacts WHERE has_order = 1),
 n AS (SELECT interaction_id, row_number() OVER (ORDER BY {_MD5_U32.format(x="'order:' || CAST(interaction_id AS VARCHAR)")},
                                                 interaction_id) AS order_number FROM o)
SELECT interaction_id, order_number, printf('P%09d', order_number) AS order_ref FROM n""")
def q_order_numbers(spark, sf_dir):
    o = contacts(spark, sf_dir).where(F.col("has_order") == 1).select("interaction_id")
    n = numbering.assign_numbers(o, "interaction_id", "order_number", salt="order:")
    return n.withColumn("order_ref", sc.format_id("P", F.col("order_number")))


@register("order_summary", """
SELECT CAST(count_if(has_order = 1) AS BIGINT) AS orders, avg(CASE WHEN has_order = 1 THEN 1.0 ELSE 0.0 END::DOUBLE) AS order_share
FROM contacts""")
def q_order_summary(spark, sf_dir):
    return rules.order_summary(contacts(spark, sf_dir))


# ---- M1, M2, A27 --------------------------------------------------------------------

_BUCKET = "(" + _MD5_U32.format(x="{x}") + " % 100)"


@register("hash_split_sizes", f"""
SELECT CASE WHEN {_BUCKET.format(x='interaction_id')} < 80 THEN 'train' ELSE 'test' END AS split,
       count(*) AS rows
FROM contacts GROUP BY ALL""")
def q_hash_split_sizes(spark, sf_dir):
    return evaluation.split_sizes(contacts(spark, sf_dir), "interaction_id")


@register("sample_split_sizes", f"""
SELECT CASE WHEN {_BUCKET.format(x='interaction_id')} < 80 THEN 'train' ELSE 'test' END AS split,
       count(*) AS rows
FROM contacts WHERE {_BUCKET.format(x="'sample:' || CAST(interaction_id AS VARCHAR)")} < 40 GROUP BY ALL""")
def q_sample_split_sizes(spark, sf_dir):
    s = evaluation.sample_rows(contacts(spark, sf_dir), "interaction_id", 0.4)
    return evaluation.split_sizes(s, "interaction_id")


# ---- M3-M5 ----------------------------------------------------------------------------

@register("string_index", """
, s AS (SELECT 'channel' AS column_name, channel AS value FROM contacts
        UNION ALL SELECT 'agent_result', agent_result FROM contacts),
 c AS (SELECT column_name, value, count(*) AS frequency FROM s WHERE value IS NOT NULL GROUP BY ALL)
SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY frequency DESC, value ASC) - 1 AS DOUBLE)
         AS label_index
FROM c""")
def q_string_index(spark, sf_dir):
    from ..plans.features import label_index_table
    return label_index_table(contacts(spark, sf_dir), ["channel", "agent_result"])


@register("one_hot_long", """
, c AS (SELECT channel, count(*) AS f FROM contacts WHERE channel IS NOT NULL GROUP BY ALL),
 i AS (SELECT channel, row_number() OVER (ORDER BY f DESC, channel ASC) - 1 AS idx FROM c),
 n AS (SELECT count(*) AS k FROM c)
SELECT t.interaction_id, CAST(coalesce(i.idx, n.k) AS DOUBLE) AS channel_index, CAST(n.k AS INTEGER) AS vec_size,
       CAST(CASE WHEN coalesce(i.idx, n.k) < n.k THEN coalesce(i.idx, n.k) END AS INTEGER) AS active_index
FROM contacts t LEFT JOIN i USING (channel) CROSS JOIN n""")
def q_one_hot_long(spark, sf_dir):
    df = contacts(spark, sf_dir).select("interaction_id", "channel")
    idx = StringIndexer(inputCol="channel", outputCol="channel_index", handleInvalid="keep").fit(df)
    enc = OneHotEncoder(inputCol="channel_index", outputCol="vec").fit(idx.transform(df))
    out = enc.transform(idx.transform(df)).withColumn("arr", vector_to_array("vec"))
    pos = F.array_position("arr", 1.0)
    return out.select("interaction_id", "channel_index", F.size("arr").alias("vec_size"),
                      F.when(pos > 0, (pos - 1).cast("int")).alias("active_index"))


# ---- A22, A23, M22-M26 (fixed-rule predictions) -------------------------------------------

def rule_predictions(spark, sf_dir):
    """Label = order flag (NULL dropped), prediction = 'interested', score = the measured order rate."""
    all_rows = contacts(spark, sf_dir).withColumn("hour", F.hour("contact_ts"))
    df = rate_scorer(all_rows)(all_rows).where(F.col("has_order").isNotNull())
    return df.select(F.col("has_order").cast("double").alias("label"),
                     (F.col("agent_result") == "interesado").cast("double").alias("prediction"),
                     F.col("p").alias("propensity"))


_CM_SQL = """
, cm AS (SELECT CAST(has_order AS DOUBLE) AS label,
                CASE WHEN agent_result = 'interesado' THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
                count(*) AS count
         FROM contacts WHERE has_order IS NOT NULL GROUP BY ALL)
"""


@register("confusion_matrix", _CM_SQL + "SELECT * FROM cm")
def q_confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(rule_predictions(spark, sf_dir))


@register("confusion_pivot", _CM_SQL + """
SELECT label, CAST(coalesce(sum(count) FILTER (WHERE prediction = 0.0), 0) AS BIGINT) AS pred_0,
       CAST(coalesce(sum(count) FILTER (WHERE prediction = 1.0), 0) AS BIGINT) AS pred_1
FROM cm GROUP BY label""")
def q_confusion_pivot(spark, sf_dir):
    return evaluation.confusion_pivot(evaluation.confusion_matrix(rule_predictions(spark, sf_dir)))


# Display texts of the confusion matrix.
REAL_TEXT = {0.0: "Real: 0 (no generó pedido)", 1.0: "Real: 1 (sí generó pedido)"}
PRED_TEXT = {0.0: "Predicho: 0 (no pedido)", 1.0: "Predicho: 1 (pedido)"}


@register("confusion_labels", _CM_SQL + f"""
SELECT CASE label WHEN 0.0 THEN '{REAL_TEXT[0.0]}' WHEN 1.0 THEN '{REAL_TEXT[1.0]}' END AS real_label,
       CASE prediction WHEN 0.0 THEN '{PRED_TEXT[0.0]}' WHEN 1.0 THEN '{PRED_TEXT[1.0]}' END AS pred_label,
       count
FROM cm""")
def q_confusion_labels(spark, sf_dir):
    """The confusion counts with readable texts (unmapped -> NULL)."""
    cm = evaluation.confusion_matrix(rule_predictions(spark, sf_dir))
    return cm.select(sc.label_flags("label", REAL_TEXT).alias("real_label"),
                     sc.label_flags("prediction", PRED_TEXT).alias("pred_label"), "count")


@register("binary_metrics", _CM_SQL + """,
 tot AS (SELECT sum(count)::DOUBLE AS n FROM cm),
 lab AS (SELECT label AS cls, sum(count) AS support, sum(CASE WHEN label = prediction THEN count ELSE 0 END) AS tp
         FROM cm GROUP BY label),
 prd AS (SELECT prediction AS cls, sum(count) AS predicted FROM cm GROUP BY prediction),
 cls AS (SELECT coalesce(lab.cls, prd.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
                coalesce(predicted, 0) AS predicted FROM lab FULL JOIN prd ON lab.cls = prd.cls),
 pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END::DOUBLE AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END::DOUBLE AS recall FROM cls),
 f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0.0 END::DOUBLE AS f1 FROM pr),
 m AS (SELECT 'accuracy' AS metric, sum(tp) / max(n) AS value FROM f, tot
       UNION ALL SELECT 'f1', sum(f1 * support) / max(n) FROM f, tot
       UNION ALL SELECT 'weighted_precision', sum(precision * support) / max(n) FROM f, tot
       UNION ALL SELECT 'weighted_recall', sum(recall * support) / max(n) FROM f, tot
       UNION ALL SELECT 'n', max(n) FROM tot
       UNION ALL SELECT 'precision_' || CAST(CAST(cls AS INTEGER) AS VARCHAR), precision FROM f
       UNION ALL SELECT 'recall_' || CAST(CAST(cls AS INTEGER) AS VARCHAR), recall FROM f
       UNION ALL SELECT 'precision', precision FROM f WHERE cls = 0.0
       UNION ALL SELECT 'recall', recall FROM f WHERE cls = 0.0)
SELECT metric, round(value::DOUBLE, 9) AS value FROM m""")
def q_binary_metrics(spark, sf_dir):
    cm = evaluation.confusion_matrix(rule_predictions(spark, sf_dir))
    return evaluation.metrics_from_confusion(cm).withColumn("value", F.round("value", 9))


@register("auc_rank", RATES_SQL + """
, s AS (SELECT has_order, round(rates.p, 4) AS score
        FROM contacts JOIN rates ON rates.channel = contacts.channel AND rates.agent_result = contacts.agent_result
             AND rates.hour = hour(contacts.contact_ts) WHERE has_order IS NOT NULL),
 h AS (SELECT score, CAST(count_if(has_order = 1) AS BIGINT) AS pos, CAST(count_if(has_order = 0) AS BIGINT) AS neg FROM s GROUP BY score),
 c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS neg_below FROM h)
SELECT round(sum(pos * (neg_below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 9) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, count(*) AS distinct_scores
FROM c""")
def q_auc_rank(spark, sf_dir):
    pred = rule_predictions(spark, sf_dir)
    hist = evaluation.score_histogram(pred, "label", "propensity", decimals=4)
    return evaluation.auc_from_histogram(hist).withColumn("auc", F.round("auc", 9))


@register("auc_continuous", """
, s AS (SELECT has_order, coalesce(order_amount, 0.0::DOUBLE) + CAST(interaction_id AS DOUBLE) / 1e9::DOUBLE AS score
        FROM raw_contacts WHERE has_order IS NOT NULL),
 r AS (SELECT has_order, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r, score FROM s),
 n AS (SELECT count_if(has_order = 1)::DOUBLE AS p, count_if(has_order = 0)::DOUBLE AS q FROM s)
SELECT round((sum(r) FILTER (WHERE has_order = 1) - max(p) * (max(p) + 1) / 2) / (max(p) * max(q)), 9) AS auc,
       CAST(max(p) AS BIGINT) AS positives, CAST(max(q) AS BIGINT) AS negatives, count(DISTINCT score) AS distinct_scores
FROM r, n""")
def q_auc_continuous(spark, sf_dir):
    """M25 for a score with as many values as rows: the amount, told apart by the contact's number."""
    df = raw_contacts(spark, sf_dir, notes=False)
    score = F.coalesce("order_amount", F.lit(0.0)) + F.col("interaction_id").cast("double") / 1e9
    return evaluation.auc_from_histogram(evaluation.score_histogram(df, "has_order", score)).withColumn("auc", F.round("auc", 9))
