"""Turn the driver tables into contact tables.

``events`` (one row per user action) plus whole ``documents`` texts become a
raw contact table with NULLs injected at fixed residues of the event id, so
every cleaning rule is exercised.  The same derivation is written once as
DataFrame code (below) and once as SQL text for the DuckDB oracle
(:data:`RAW_CONTACTS_SQL`); both give identical rows.

Every event becomes one contact; every document text is used whole: the
note of event ``e`` is document ``e mod (number of documents)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MISSING_NOTE
from ..functions.scalar import format_id

# Fixed values of the adapter: residues of event_id that become NULL.
NULL_RESIDUES = {
    "client_id": 101,
    "agent_id": 139,
    "channel": 103,
    "contact_ts": 107,
    "order_amount": 109,
    "product_category": 113,
    "order_id": 127,
    "note": 131,
    "has_order": 137,
}
AGENT_POOL = 37
DAY_SPREAD = 320
ORDER_EVENTS = ("purchase", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` (doc_id, text); small files are split by reader settings of the session, not by a shuffle."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _null_at(eid, column: str, value):
    return F.when(eid % NULL_RESIDUES[column] == 0, F.lit(None)).otherwise(value)


MISSING_NOTE_REF = -1


def raw_contacts(spark: SparkSession, sf_dir: str, notes: bool = True,
                 clean_note: Callable[[Column], Column] | None = None,
                 note_ref: bool = False, note_text: bool = True) -> DataFrame:
    """Raw (un-normalised) contacts.  ``notes=False`` leaves out the note
    column and with it the join against ``documents``; ``note_text=False``
    keeps only whether there is a note (empty or NULL), so that no text is
    shuffled.

    ``clean_note`` adds ``note_clean``: the cleaner applied to the note
    after the sentinel rule (what P10 adds after P7).  It is evaluated once
    per document, before the join that hands each text to many contacts,
    instead of once per contact; a missing note gets the cleaned sentinel
    (a constant).

    ``note_ref=True`` adds ``note_ref``, the id of the document holding the
    note (NULL when the note is missing), without reading any text."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = F.regexp_extract("props", r"([0-9]+)", 1).try_cast("int")
    ordered = F.when(F.col("event_type").isin(*ORDER_EVENTS), 1).otherwise(0)
    e = ev.select("event_id", "ts", "user_id", "event_type", "value",
                  k.alias("k"), ordered.alias("ord"))
    if notes:
        docs = documents(spark, sf_dir)
        if clean_note is not None:
            docs = docs.withColumn("text_clean", clean_note(F.coalesce(F.col("text"), F.lit(MISSING_NOTE))))
        if not note_text:
            docs = docs.withColumn("text", F.when(F.col("text").isNotNull(), F.lit("")))
        n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
        # Equi-join on a derived key.  The planner's size estimate counts a
        # text as a few bytes, so it would broadcast the whole corpus; a
        # sort-merge join (spills, no size limit) is requested instead.
        e = e.withColumn("_doc", F.try_mod(eid, n_docs))
        e = e.join(docs.hint("merge"), e["_doc"] == docs["doc_id"], "left")
    if note_ref:
        n_all = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
        e = e.withColumn("note_ref", _null_at(eid, "note", F.try_mod(eid, n_all)))
    kk, od = F.col("k"), F.col("ord")
    interested = ((od == 1) & (kk % 10 < 8)) | ((F.col("event_type") == "click") & (kk % 10 < 3))
    category = (F.when(kk % 3 == 0, "conectividad").when(kk % 3 == 1, "movilidad")
                .otherwise("hogar"))
    cols = {
        "interaction_id": eid,
        "client_id": _null_at(eid, "client_id",
                              format_id("C", F.col("user_id"))),
        "agent_id": _null_at(eid, "agent_id",
                             format_id("A", eid % AGENT_POOL + 1)),
        "channel": _null_at(eid, "channel", F.when(kk % 20 < 11, "llamada").otherwise("whatsapp")),
        "agent_result": F.when(interested, "interesado").otherwise("no_interesado"),
        "contact_ts": _null_at(eid, "contact_ts",
                               F.col("ts") + F.make_dt_interval(days=(eid % DAY_SPREAD).cast("int"))),
        "note": _null_at(eid, "note", F.col("text")) if notes else None,
        "note_clean": (F.when((eid % NULL_RESIDUES["note"] == 0) | F.col("doc_id").isNull(),
                              clean_note(F.lit(MISSING_NOTE))).otherwise(F.col("text_clean"))
                       if notes and clean_note is not None else None),
        "has_order": _null_at(eid, "has_order", od),
        "order_id": F.when((eid % NULL_RESIDUES["order_id"] == 0) | (od == 0), F.lit(None))
                     .otherwise(format_id("P", eid)),
        "order_amount": _null_at(eid, "order_amount", F.col("value")),
        "product_category": F.when((eid % NULL_RESIDUES["product_category"] == 0) | (od == 0),
                                   F.lit(None)).otherwise(category),
    }
    if note_ref:
        cols["note_ref"] = F.col("note_ref")
    return e.select(*[v.alias(n) for n, v in cols.items() if v is not None])


def note_texts(spark: SparkSession, sf_dir: str,
               clean_note: Callable[[Column], Column]) -> DataFrame:
    """The texts contacts refer to by ``note_ref``, cleaned once per text,
    plus the cleaned missing-note sentinel under ``MISSING_NOTE_REF``."""
    docs = documents(spark, sf_dir).select(
        F.col("doc_id").alias("note_ref"),
        clean_note(F.coalesce(F.col("text"), F.lit(MISSING_NOTE))).alias("note_clean"))
    missing = spark.range(1).select(F.lit(MISSING_NOTE_REF).cast("long").alias("note_ref"),
                                    clean_note(F.lit(MISSING_NOTE)).alias("note_clean"))
    return docs.unionByName(missing)


def attach_notes(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Add the raw ``note`` to a small set of contact rows (e.g. a preview):
    only the documents those rows reference are read into the join -- a
    semi-join against the needed ids; where they are few (a preview) the
    planner broadcasts them and streams the documents without shuffling them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    keyed = rows.withColumn("_doc", F.try_mod(F.col("interaction_id"), n_docs))
    needed = keyed.select(F.col("_doc").alias("doc_id")).distinct()
    wanted = docs.join(needed, "doc_id", "left_semi")
    out = keyed.join(wanted, keyed["_doc"] == wanted["doc_id"], "left")
    note = _null_at(F.col("interaction_id"), "note", F.col("text"))
    cols = [c for c in rows.columns]
    pos = cols.index("contact_ts") + 1 if "contact_ts" in cols else len(cols)
    return out.select(*cols[:pos], note.alias("note"), *cols[pos:])


def orders_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders for the 24-hour attribution: every ``purchase`` event."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return ev.select(
        format_id("P", F.col("event_id")).alias("order_id"),
        format_id("C", F.col("user_id")).alias("client_id"),
        F.col("ts").alias("order_ts"),
        F.col("value").alias("order_amount"),
    )


def labelled_notes(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """Notes with a text label: ``documents`` joined with ``labels``."""
    docs = documents(spark, sf_dir).withColumnRenamed("text", "note")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).cast("string").alias(label))
    return docs.join(labels, "doc_id", "inner")


# ---- the same derivation as SQL text for the DuckDB oracle -------------------

def _nul(col: str, expr: str) -> str:
    return f"CASE WHEN e.event_id % {NULL_RESIDUES[col]} = 0 THEN NULL ELSE {expr} END"


RAW_CONTACTS_SQL = f"""
SELECT e.event_id AS interaction_id,
  {_nul('client_id', "printf('C%09d', e.user_id)")} AS client_id,
  {_nul('agent_id', f"printf('A%09d', e.event_id % {AGENT_POOL} + 1)")} AS agent_id,
  {_nul('channel', "CASE WHEN e.k % 20 < 11 THEN 'llamada' ELSE 'whatsapp' END")} AS channel,
  CASE WHEN (e.ord = 1 AND e.k % 10 < 8) OR (e.event_type = 'click' AND e.k % 10 < 3)
       THEN 'interesado' ELSE 'no_interesado' END AS agent_result,
  {_nul('contact_ts', f"e.ts + to_days(CAST(e.event_id % {DAY_SPREAD} AS INTEGER))")} AS contact_ts,
  {_nul('note', 'd.text')} AS note,
  {_nul('has_order', 'e.ord')} AS has_order,
  CASE WHEN e.event_id % {NULL_RESIDUES['order_id']} = 0 OR e.ord = 0 THEN NULL
       ELSE printf('P%09d', e.event_id) END AS order_id,
  {_nul('order_amount', 'e.value')} AS order_amount,
  CASE WHEN e.event_id % {NULL_RESIDUES['product_category']} = 0 OR e.ord = 0 THEN NULL
       WHEN e.k % 3 = 0 THEN 'conectividad' WHEN e.k % 3 = 1 THEN 'movilidad' ELSE 'hogar' END
       AS product_category
FROM (SELECT *, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
             CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS ord
      FROM events) e
LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
"""

CONTACTS_SQL = """
SELECT interaction_id,
  coalesce(client_id, 'C000000000') AS client_id,
  coalesce(agent_id, 'A000000000') AS agent_id,
  coalesce(channel, 'desconocido') AS channel,
  coalesce(agent_result, 'no_especificado') AS agent_result,
  coalesce(contact_ts, TIMESTAMP '2025-01-01 00:00:00') AS contact_ts,
  coalesce(note, 'Sin nota capturada') AS note,
  has_order,
  CASE WHEN has_order = 0 THEN 'NA' ELSE coalesce(order_id, 'P000000000') END AS order_id,
  CASE WHEN has_order = 0 THEN 0.0::DOUBLE ELSE coalesce(order_amount, 0.0::DOUBLE) END AS order_amount,
  CASE WHEN has_order = 0 THEN 'NA' ELSE coalesce(product_category, 'NA') END AS product_category
FROM raw_contacts
"""

ORDERS_SQL = """
SELECT printf('P%09d', event_id) AS order_id, printf('C%09d', user_id) AS client_id,
       ts AS order_ts, value AS order_amount
FROM events WHERE event_type = 'purchase'
"""


def with_contacts(sql: str) -> str:
    """Prefix an oracle query with the ``raw_contacts``/``contacts``/``orders_24h`` CTEs."""
    return (f"WITH raw_contacts AS ({RAW_CONTACTS_SQL}),\n contacts AS ({CONTACTS_SQL}),\n"
            f" orders_24h AS ({ORDERS_SQL})\n{sql}")
