"""Reports: loading and cleaning checks, scalar functions, indicators, trends,
channels and agents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import scalar as sc
from ..functions import text as tx
from ..operators import agents, channels, clean, metrics, trends
from ..sources.adapter import attach_notes, documents, raw_contacts, table
from ..sources.contacts import CORRUPT, VERBATIM, checkpoint_dir, preview, row_limit_sample
from ..sources.csv_records import read_csv_records

from .registry import ORACLE, TS_TEXT, contacts, register
from .registry import with_extra as _with_extra


# =============================================================================
# Loading, cleaning, checks
# =============================================================================

@register("normalize_contacts", """
SELECT interaction_id, client_id, agent_id, channel, agent_result,
       strftime(contact_ts, '%Y-%m-%d %H:%M:%S.%f') AS contact_ts, note, has_order,
       order_id, order_amount, product_category
FROM contacts""")
def q_normalize_contacts(spark, sf_dir):
    df = contacts(spark, sf_dir, notes=True)
    return df.withColumn("contact_ts", F.date_format("contact_ts", TS_TEXT))


@register("csv_round_trip", """
SELECT interaction_id, client_id, agent_id, channel, agent_result,
       strftime(contact_ts, '%Y-%m-%d %H:%M:%S.%f') AS contact_ts, has_order,
       order_id, order_amount, product_category
FROM contacts""")
def q_csv_round_trip(spark, sf_dir):
    """Contacts as CSV lines and back with the fixed schema."""
    df = contacts(spark, sf_dir)
    how = {"escape": '"', "timestampFormat": TS_TEXT, "timestampNTZFormat": TS_TEXT}
    line = df.select(F.to_csv(F.struct(*df.columns), how).alias("line"))
    back = line.select(F.from_csv("line", df.schema.toDDL(), how).alias("c")).select("c.*")
    return back.withColumn("contact_ts", F.date_format("contact_ts", TS_TEXT))


_F3_SQL = """
SELECT CAST(count_if(has_order = 1 AND order_id = 'NA') AS BIGINT) AS order_without_id,
       CAST(count_if(has_order = 0 AND order_amount <> 0) AS BIGINT) AS no_order_with_amount,
       CAST(count_if(has_order = 0 AND product_category <> 'NA') AS BIGINT) AS no_order_with_category
FROM {t}"""


@register("preview_contacts", """
SELECT interaction_id, client_id, agent_id, channel, agent_result,
       strftime(contact_ts, '%Y-%m-%d %H:%M:%S.%f') AS contact_ts, note, has_order,
       order_id, order_amount, product_category
FROM contacts ORDER BY interaction_id LIMIT 1000""")
def q_preview_contacts(spark, sf_dir):
    """The first 1000 contacts by id (the limit is the feature).  The
    rows are chosen first; only their notes are then fetched."""
    first = preview(raw_contacts(spark, sf_dir, notes=False), 1000)
    df = clean.normalize_contacts(attach_notes(spark, sf_dir, first))
    return df.withColumn("contact_ts", F.date_format("contact_ts", TS_TEXT))


@register("row_limit_sample", """
SELECT channel, agent_result, count(*) AS contacts, CAST(sum(has_order) AS BIGINT) AS orders
FROM (SELECT * FROM contacts ORDER BY interaction_id LIMIT 50000) GROUP BY ALL""")
def q_row_limit_sample(spark, sf_dir):
    """The first 50,000 contacts by id as a working sample (the sampling
    operator itself), summarised per channel and result."""
    s = row_limit_sample(contacts(spark, sf_dir), 50000)
    return s.groupBy("channel", "agent_result").agg(F.count(F.lit(1)).alias("contacts"),
                                                    F.sum("has_order").alias("orders"))


@register("rule_violations_raw", _F3_SQL.format(t="raw_contacts"))
def q_rule_violations_raw(spark, sf_dir):
    return clean.rule_violations(raw_contacts(spark, sf_dir, notes=False))


@register("rule_violations_clean", _F3_SQL.format(t="contacts"))
def q_rule_violations_clean(spark, sf_dir):
    return clean.rule_violations(contacts(spark, sf_dir))


_SCHEMA_CHECKS_SQL = {
    "client_id_format": "NOT regexp_matches(client_id, '^C[0-9]{9}$')",
    "agent_id_format": "NOT regexp_matches(agent_id, '^A[0-9]{9}$')",
    "order_id_format": "NOT regexp_matches(order_id, '^(P[0-9]{9}|NA)$')",
    "channel_domain": "channel NOT IN ('llamada', 'whatsapp')",
    "agent_result_domain": "agent_result NOT IN ('interesado', 'no_interesado')",
    "category_domain": "product_category NOT IN ('conectividad', 'movilidad', 'hogar', 'NA')",
    "has_order_domain": "has_order NOT IN (0, 1)",
    "amount_range": "NOT (order_amount BETWEEN 0.0 AND 34999.0)",
    "contact_ts_range": "NOT (contact_ts BETWEEN TIMESTAMP '2025-01-01 00:00:00' AND TIMESTAMP '2025-12-31 23:59:59')",
    "hour_range": "NOT (hour(contact_ts) BETWEEN 9 AND 21)",
}


def _schema_violations_sql(t: str) -> str:
    aggs = ",\n ".join(f"CAST(count_if({p}) AS BIGINT) AS {n}" for n, p in _SCHEMA_CHECKS_SQL.items())
    names = list(_SCHEMA_CHECKS_SQL) + ["interaction_id_duplicates"]
    union = "\nUNION ALL ".join(f"SELECT '{n}' AS rule_name, {n} AS n_violations FROM agg" for n in names)
    return (f", agg AS (SELECT {aggs},\n count(interaction_id) - count(DISTINCT interaction_id)"
            f" AS interaction_id_duplicates FROM {t})\n{union}")


@register("schema_violations")
def q_schema_violations(spark, sf_dir):
    return clean.schema_violations(raw_contacts(spark, sf_dir, notes=False)) \
        .withColumnRenamed("check", "rule_name")


ORACLE["schema_violations"] = _with_extra(_schema_violations_sql("raw_contacts"))


@register("rejected_rows")
def q_rejected_rows(spark, sf_dir):
    """Every row that fails a check, once per check it fails."""
    _, rejected = clean.split_conforming(raw_contacts(spark, sf_dir, notes=False))
    return rejected.select("interaction_id", F.explode("failed_checks").alias("rule_name"))


ORACLE["rejected_rows"] = _with_extra(", r AS (" + "\nUNION ALL ".join(
    f"SELECT interaction_id, '{n}' AS rule_name FROM raw_contacts WHERE {p}" for n, p in _SCHEMA_CHECKS_SQL.items())
    + ")\nSELECT * FROM r")


# Fixed values of the query: residues of the contact's number whose CSV lines are damaged.
CUT_LINE, BAD_AMOUNT = 211, 223


@register("csv_rejects", f"""
SELECT interaction_id, rule_name FROM (
  SELECT interaction_id, CASE WHEN interaction_id % {CUT_LINE} = 0 OR interaction_id % {BAD_AMOUNT} = 0 THEN 'malformed_record'
         WHEN {' OR '.join(p for p in _SCHEMA_CHECKS_SQL.values())} THEN 'other' END AS rule_name FROM contacts)
WHERE rule_name IS NOT NULL""")
def q_csv_rejects(spark, sf_dir):
    """Contacts as CSV lines, some cut short and some with an amount that is no number; the parser keeps
    the text of every line it cannot read, the row is rejected for it."""
    df = contacts(spark, sf_dir)
    how = {"escape": '"', "timestampFormat": TS_TEXT, "timestampNTZFormat": TS_TEXT}
    i = F.col("interaction_id")
    line = F.to_csv(F.struct(*df.columns), how)
    line = F.when(i % CUT_LINE == 0, F.substring_index(line, ",", 5)).when(
        i % BAD_AMOUNT == 0, F.regexp_replace(line, ",([^,]*),([^,]*)$", ",x$1,$2")).otherwise(line)
    schema = T.StructType([*df.schema.fields, T.StructField(CORRUPT, T.StringType())])
    back = df.select(F.from_csv(line, schema.toDDL(), {**how, "columnNameOfCorruptRecord": CORRUPT}).alias("c")).select("c.*")
    _, rejected = clean.split_conforming(back, CORRUPT)
    number = F.coalesce("interaction_id", F.regexp_extract(CORRUPT, "^([0-9]+)", 1).cast("long"))
    first = F.when(F.col("failed_checks")[0] == "malformed_record", "malformed_record").otherwise("other")
    return rejected.select(number.alias("interaction_id"), first.alias("rule_name"))


@register("csv_documents", raw_sql="""
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5 FROM documents""")
def q_csv_documents(spark, sf_dir):
    """S1-S3 on files: whole texts with their line breaks and quotes written as CSV and read back by splits."""
    docs = documents(spark, sf_dir)
    path = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    docs.write.options(header=True, escape='"', **VERBATIM).csv(path)
    back = read_csv_records(spark, path, docs.schema)
    return back.select("doc_id", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


# =============================================================================
# Scalar functions
# =============================================================================

_KEEP_COLLAPSE = "trim(regexp_replace(regexp_replace({x}, '[^{keep}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


@register("clean_basic", "SELECT interaction_id, " + _KEEP_COLLAPSE.format(
    x="lower(note)", keep=tx.KEEP_BASIC) + " AS note_clean FROM contacts")
def q_clean_basic(spark, sf_dir):
    df = contacts(spark, sf_dir, clean_note=tx.clean_basic)
    return df.select("interaction_id", "note_clean")


@register("clean_strict", "SELECT interaction_id, trim(regexp_replace(regexp_replace(regexp_replace("
          "strip_accents(lower(note)), '[^a-zñ0-9\\s]', ' ', 'g'), '[0-9]+', ' ', 'g'), '\\s+', ' ', 'g'))"
          " AS note_clean FROM contacts")
def q_clean_strict(spark, sf_dir):
    df = contacts(spark, sf_dir, clean_note=tx.clean_strict)
    return df.select("interaction_id", "note_clean")


@register("clean_nb_nfd", "SELECT interaction_id, " + _KEEP_COLLAPSE.format(
    x="strip_accents(lower(note))", keep=tx.KEEP_NOTEBOOK) + " AS note_clean FROM contacts")
def q_clean_nb_nfd(spark, sf_dir):
    df = contacts(spark, sf_dir, clean_note=tx.clean_nb_nfd)
    return df.select("interaction_id", "note_clean")


@register("clean_nb_nfkd", "SELECT interaction_id, " + _KEEP_COLLAPSE.format(
    x="strip_accents(lower(note))", keep=tx.KEEP_STRICT) + " AS note_clean FROM contacts")
def q_clean_nb_nfkd(spark, sf_dir):
    df = contacts(spark, sf_dir, clean_note=tx.clean_nb_nfkd)
    return df.select("interaction_id", "note_clean")


@register("calendar_parts", """
SELECT interaction_id,
       CAST(year(contact_ts) AS INTEGER) AS year, CAST(month(contact_ts) AS INTEGER) AS month,
       CAST(hour(contact_ts) AS INTEGER) AS hour,
       CAST(dayofweek(contact_ts) + 1 AS INTEGER) AS weekday_sun1,
       CAST(isodow(contact_ts) - 1 AS INTEGER) AS weekday_mon0,
       CAST(day(contact_ts) AS INTEGER) AS day_of_month,
       strftime(contact_ts, '%Y-%m') AS year_month,
       (day(contact_ts) <= 3 OR day(contact_ts) BETWEEN 14 AND 17 OR day(contact_ts) >= 29) AS payday
FROM contacts""")
def q_calendar_parts(spark, sf_dir):
    df = cal.with_calendar(contacts(spark, sf_dir))
    return df.select("interaction_id", "year", "month", "hour", "weekday_sun1", "weekday_mon0",
                     "day_of_month", cal.year_month("contact_ts").alias("year_month"),
                     cal.payday_flag("contact_ts").alias("payday"))


@register("format_ids", raw_sql="""
SELECT event_id, printf('C%09d', user_id) AS client_ref, printf('P%09d', event_id) AS order_ref,
       printf('A%09d', event_id % 37 + 1) AS agent_ref
FROM events""")
def q_format_ids(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", sc.format_id("C", F.col("user_id")).alias("client_ref"),
                     sc.format_id("P", F.col("event_id")).alias("order_ref"),
                     sc.format_id("A", F.col("event_id") % 37 + 1).alias("agent_ref"))


# =============================================================================
# Indicators and distributions
# =============================================================================

@register("kpis", """
SELECT count(*) AS total_contacts, avg(has_order) AS order_rate,
       CAST(count_if(has_order = 1) AS BIGINT) AS orders, CAST(count_if(has_order = 0) AS BIGINT) AS non_orders,
       CAST(count_if(has_order IS NULL) AS BIGINT) AS unknown_flag,
       CAST(count_if(has_order = 0) AS BIGINT) / count(*) AS non_order_rate
FROM contacts""")
def q_kpis(spark, sf_dir):
    return metrics.kpis(contacts(spark, sf_dir))


_RAW_COLS = ("interaction_id", "client_id", "agent_id", "channel", "agent_result", "contact_ts",
             "note", "has_order", "order_id", "order_amount", "product_category")


def _long_form_sql(agg_expr: str, value_name: str, t: str) -> str:
    aggs = ", ".join(f"{agg_expr.format(c=c)} AS {c}" for c in _RAW_COLS)
    union = "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS {value_name} FROM agg" for c in _RAW_COLS)
    return f", agg AS (SELECT {aggs} FROM {t})\n{union}"


@register("null_counts")
def q_null_counts(spark, sf_dir):
    return metrics.null_counts(raw_contacts(spark, sf_dir, note_text=False)) \
        .withColumnRenamed("column", "column_name")


ORACLE["null_counts"] = _with_extra(_long_form_sql("CAST(count_if({c} IS NULL) AS BIGINT)", "n_nulls", "raw_contacts"))


@register("null_fractions")
def q_null_fractions(spark, sf_dir):
    return metrics.null_fractions(raw_contacts(spark, sf_dir, note_text=False)) \
        .withColumnRenamed("column", "column_name")


ORACLE["null_fractions"] = _with_extra(
    _long_form_sql("avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE)", "null_share", "raw_contacts"))


@register("describe_numeric", """
, v AS (SELECT 'has_order' AS column_name, CAST(has_order AS DOUBLE) AS v FROM raw_contacts
        UNION ALL SELECT 'order_amount', order_amount FROM raw_contacts)
SELECT column_name, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
       min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
       round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
FROM v GROUP BY column_name""")
def q_describe_numeric(spark, sf_dir):
    d = metrics.describe_numeric(raw_contacts(spark, sf_dir, notes=False))
    return d.withColumnRenamed("column", "column_name").withColumns(
        {c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@register("top_values")
def q_top_values(spark, sf_dir):
    return metrics.top_values(raw_contacts(spark, sf_dir, notes=False)) \
        .withColumnRenamed("column", "column_name")


ORACLE["top_values"] = _with_extra("""
, s AS (SELECT 'channel' AS column_name, channel AS value FROM raw_contacts
        UNION ALL SELECT 'agent_result', agent_result FROM raw_contacts
        UNION ALL SELECT 'product_category', product_category FROM raw_contacts),
 c AS (SELECT column_name, value, count(*) AS n FROM s GROUP BY column_name, value),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC NULLS FIRST)
                 AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 10""")


@register("distribution", """
, d AS (SELECT channel, count(*) AS total, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM contacts) AS percent
        FROM contacts GROUP BY channel)
SELECT *, CAST(round(percent, 2) AS VARCHAR) || '%' AS percent_label FROM d""")
def q_distribution(spark, sf_dir):
    return metrics.distribution(contacts(spark, sf_dir), "channel")


@register("class_balance", "SELECT has_order, count(*) AS count FROM contacts GROUP BY has_order")
def q_class_balance(spark, sf_dir):
    return metrics.class_balance(contacts(spark, sf_dir))


# =============================================================================
# Trends
# =============================================================================

_YM = "CAST(year(contact_ts) AS INTEGER) AS year, CAST(month(contact_ts) AS INTEGER) AS month"


@register("monthly_summary", f"""
SELECT {_YM}, count(*) AS total_contacts, CAST(sum(has_order) AS BIGINT) AS total_orders,
       strftime(min(contact_ts), '%Y-%m') AS year_month
FROM contacts GROUP BY ALL""")
def q_monthly_summary(spark, sf_dir):
    return trends.monthly_summary(contacts(spark, sf_dir))


@register("monthly_conversion", f"""
SELECT {_YM}, count(interaction_id) AS total_contacts, CAST(sum(has_order) AS BIGINT) AS total_orders,
       sum(has_order) / count(interaction_id) AS order_rate
FROM contacts GROUP BY ALL""")
def q_monthly_conversion(spark, sf_dir):
    return trends.monthly_conversion(contacts(spark, sf_dir))


@register("monthly_interest", f"""
SELECT {_YM}, CAST(count_if(agent_result = 'interesado') AS BIGINT) AS interested,
       CAST(count_if(agent_result = 'no_interesado') AS BIGINT) AS not_interested
FROM contacts GROUP BY ALL""")
def q_monthly_interest(spark, sf_dir):
    return trends.monthly_interest(contacts(spark, sf_dir))


@register("interest_long", f"SELECT {_YM}, agent_result, count(*) AS total FROM contacts GROUP BY ALL")
def q_interest_long(spark, sf_dir):
    return trends.interest_long(contacts(spark, sf_dir))


@register("interest_pivot", """
SELECT CAST(month(contact_ts) AS INTEGER) AS month,
       CAST(count_if(agent_result = 'interesado') AS BIGINT) AS interesado,
       CAST(count_if(agent_result = 'no_interesado') AS BIGINT) AS no_interesado,
       CAST(count_if(agent_result = 'no_especificado') AS BIGINT) AS no_especificado
FROM contacts GROUP BY ALL""")
def q_interest_pivot(spark, sf_dir):
    return trends.interest_pivot(contacts(spark, sf_dir))


@register("volume_by_hour", """
SELECT CAST(hour(contact_ts) AS INTEGER) AS hour, count(*) AS total_contacts,
       CAST(sum(has_order) AS BIGINT) AS total_orders
FROM contacts GROUP BY ALL""")
def q_volume_by_hour(spark, sf_dir):
    return trends.volume_by_hour(contacts(spark, sf_dir))


@register("volume_by_day", """
SELECT CAST(contact_ts AS DATE) AS day, count(*) AS total_contacts,
       CAST(sum(has_order) AS BIGINT) AS total_orders
FROM contacts GROUP BY ALL""")
def q_volume_by_day(spark, sf_dir):
    return trends.volume_by_day(contacts(spark, sf_dir))


@register("hour_weekday_matrix", "SELECT CAST(hour(contact_ts) AS INTEGER) AS hour, " + ", ".join(
    f"CAST(count_if(dayofweek(contact_ts) + 1 = {i}) AS BIGINT) AS d{i}" for i in range(1, 8)) + " FROM contacts GROUP BY ALL")
def q_hour_weekday_matrix(spark, sf_dir):
    return trends.hour_weekday_matrix(contacts(spark, sf_dir))


@register("interest_by_hour", """
SELECT CAST(hour(contact_ts) AS INTEGER) AS hour, count(*) AS total_contacts,
       CAST(count_if(agent_result = 'interesado') AS BIGINT) AS interested,
       CAST(count_if(agent_result = 'no_interesado') AS BIGINT) AS not_interested,
       CAST(count_if(agent_result = 'interesado') AS BIGINT) / count(*) AS interest_rate
FROM contacts GROUP BY ALL""")
def q_interest_by_hour(spark, sf_dir):
    return trends.interest_by_hour(contacts(spark, sf_dir))


# =============================================================================
# Channels, categories, agents
# =============================================================================

@register("channel_category_orders", """
SELECT channel, product_category, count(*) AS orders FROM contacts WHERE has_order = 1 GROUP BY ALL""")
def q_channel_category_orders(spark, sf_dir):
    return channels.channel_category_orders(contacts(spark, sf_dir))


@register("channel_category_share", """
, a AS (SELECT channel, coalesce(product_category, 'sin_categoria') AS product_category, count(*) AS orders
        FROM contacts WHERE has_order = 1 GROUP BY ALL),
 b AS (SELECT * FROM a WHERE product_category <> 'sin_categoria')
SELECT channel, product_category, orders, CAST(sum(orders) OVER (PARTITION BY channel) AS BIGINT) AS channel_orders,
       round(orders * 100.0::DOUBLE / sum(orders) OVER (PARTITION BY channel), 2) AS share_pct
FROM b""")
def q_channel_category_share(spark, sf_dir):
    return channels.channel_category_share(contacts(spark, sf_dir))


@register("channel_category_conversion", """
SELECT channel, product_category, CAST(sum(has_order) AS BIGINT) AS orders, count(*) AS total_contacts,
       sum(has_order) / count(*) AS order_rate
FROM contacts GROUP BY ALL""")
def q_channel_category_conversion(spark, sf_dir):
    return channels.channel_category_conversion(contacts(spark, sf_dir))


@register("channel_category_conversion_raw", """
SELECT channel, product_category, CAST(sum(has_order) AS BIGINT) AS orders, count(*) AS total_contacts,
       sum(has_order) / count(*) AS order_rate
FROM raw_contacts WHERE channel IS NOT NULL AND product_category IS NOT NULL GROUP BY ALL""")
def q_channel_category_conversion_raw(spark, sf_dir):
    """T1 parity: the notebook's table on raw rows where missing keys drop out."""
    return channels.channel_category_conversion(raw_contacts(spark, sf_dir, notes=False), drop_null_keys=True)


@register("conversion_by_channel", """
SELECT channel, count(*) AS total_contacts, CAST(sum(has_order) AS BIGINT) AS orders,
       avg(has_order) AS order_rate
FROM contacts GROUP BY ALL""")
def q_conversion_by_channel(spark, sf_dir):
    return channels.conversion_by_channel(contacts(spark, sf_dir))


@register("category_ranking", """
SELECT product_category, count(*) AS orders, round(sum(order_amount), 4) AS amount
FROM contacts WHERE has_order = 1 GROUP BY ALL""")
def q_category_ranking(spark, sf_dir):
    return channels.category_ranking(contacts(spark, sf_dir)).withColumn("amount", F.round("amount", 4))


_AGENTS_SQL = """
SELECT agent_id, CAST(sum(has_order) AS BIGINT) AS total_orders, count(*) AS total_contacts
FROM contacts GROUP BY agent_id ORDER BY total_orders {dir} NULLS LAST, agent_id ASC LIMIT 10"""


@register("top_agents", _AGENTS_SQL.format(dir="DESC"))
def q_top_agents(spark, sf_dir):
    return agents.top_agents(contacts(spark, sf_dir))


@register("bottom_agents", _AGENTS_SQL.format(dir="ASC"))
def q_bottom_agents(spark, sf_dir):
    return agents.bottom_agents(contacts(spark, sf_dir))


@register("agent_conversion", """
SELECT agent_id, CAST(sum(has_order) AS BIGINT) AS total_orders, count(*) AS total_contacts,
       sum(has_order) / count(*) AS order_rate
FROM contacts GROUP BY agent_id""")
def q_agent_conversion(spark, sf_dir):
    return agents.agent_conversion(contacts(spark, sf_dir))


# =============================================================================
# Small operators on their own: P8, F1, F5, J1, J2, X11, X14, X18
# =============================================================================

_RAW_COLUMNS = ("interaction_id", "client_id", "agent_id", "channel", "agent_result", "contact_ts", "has_order", "order_id",
                "order_amount", "product_category")


@register("complete_rows", "SELECT interaction_id, channel FROM raw_contacts WHERE "
          + " AND ".join(f"{c} IS NOT NULL" for c in _RAW_COLUMNS))
def q_complete_rows(spark, sf_dir):
    """Raw contacts without a NULL in any column."""
    return clean.drop_incomplete(raw_contacts(spark, sf_dir, notes=False)).select("interaction_id", "channel")


@register("interested_contacts", "SELECT interaction_id, channel FROM contacts WHERE agent_result = 'interesado'")
def q_interested_contacts(spark, sf_dir):
    """F1."""
    return clean.by_result(contacts(spark, sf_dir), "interesado").select("interaction_id", "channel")


@register("nonblank_notes", raw_sql="SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents WHERE length(trim(text)) > 0")
def q_nonblank_notes(spark, sf_dir):
    """F5 on the texts that are the contacts' notes."""
    return clean.require_nonblank_note(documents(spark, sf_dir), "text").select("doc_id", F.length("text").alias("n_chars"))


@register("joined_months", f"""
SELECT {_YM}, count(*) AS total_contacts, CAST(sum(has_order) AS BIGINT) AS total_orders FROM contacts GROUP BY ALL""")
def q_joined_months(spark, sf_dir):
    """Contacts and orders per month, each an aggregate of its own."""
    df = contacts(spark, sf_dir)
    return trends.join_monthly(trends.monthly_volume(df), trends.monthly_orders(df))


@register("joined_agents", """
SELECT agent_id, CAST(sum(has_order) AS BIGINT) AS total_orders, count(*) AS total_contacts FROM contacts GROUP BY agent_id""")
def q_joined_agents(spark, sf_dir):
    """Orders and contacts per agent, each an aggregate of its own."""
    df = contacts(spark, sf_dir)
    orders = df.groupBy("agent_id").agg(F.sum("has_order").alias("total_orders"))
    return agents.join_agents(orders, df.groupBy("agent_id").agg(F.count(F.lit(1)).alias("total_contacts")))


@register("parsed_times", """
SELECT interaction_id, CASE WHEN interaction_id % 5 = 0 THEN NULL ELSE strftime(date_trunc('second', contact_ts), '%Y-%m-%d %H:%M:%S') END AS parsed,
       strftime(date_trunc('day', contact_ts) + to_hours(9 + interaction_id % 13), '%Y-%m-%d %H:%M:%S') AS at_hour,
       round(order_amount / 7, 2) AS part
FROM contacts""")
def q_parsed_times(spark, sf_dir):
    """Times written as text (every fifth damaged) and parsed, a day plus an hour, two decimals."""
    df, i = contacts(spark, sf_dir), F.col("interaction_id")
    text = F.date_format("contact_ts", "yyyy-MM-dd HH:mm:ss")
    text = F.when(i % 5 == 0, F.concat(F.lit("on "), text)).otherwise(text)
    hour = cal.ts_from_parts(F.to_date("contact_ts"), (9 + i % 13).cast("int"))
    return df.select("interaction_id", F.date_format(cal.parse_ts(text), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                     F.date_format(hour, "yyyy-MM-dd HH:mm:ss").alias("at_hour"),
                     sc.round2(F.col("order_amount") / 7).alias("part"))
