"""FIXTURES.md F1 golden rows and expected results."""

from datetime import datetime

from pyspark.ml.feature import RegexTokenizer
from pyspark.sql import functions as F

from callsight.functions import calendar as cal
from callsight.functions import text as tx
from callsight.operators import agents, channels, clean, evaluation, metrics, trends


def by_id(df, col="interaction_id"):
    return {r[col]: r for r in df.collect()}


def test_normalize_rows(golden):
    rows = by_id(clean.normalize_contacts(golden))
    r5 = rows[5]
    assert (r5.order_id, r5.order_amount, r5.product_category) == ("P000000000", 0.0, "NA")
    r6 = rows[6]
    assert (r6.client_id, r6.agent_id, r6.channel, r6.agent_result) == \
        ("C000000000", "A000000000", "desconocido", "no_especificado")
    assert r6.contact_ts == datetime(2025, 1, 1, 0, 0, 0)
    assert (r6.note, r6.order_id, r6.order_amount, r6.product_category) == ("Sin nota capturada", "NA", 0.0, "NA")
    assert (rows[7].order_id, rows[7].order_amount, rows[7].product_category) == ("NA", 0.0, "NA")
    assert (rows[8].order_id, rows[8].order_amount, rows[8].product_category) == ("NA", 450.25, "movilidad")
    assert (rows[9].order_id, rows[9].order_amount, rows[9].product_category) == ("P000000000", 0.0, "NA")


def test_normalize_idempotent(golden):
    once = clean.normalize_contacts(golden)
    twice = clean.normalize_contacts(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_null_counts_raw(golden):
    got = {r.column: r.n_nulls for r in metrics.null_counts(golden).collect()}
    for c in ("client_id", "agent_id", "channel", "agent_result", "contact_ts", "note", "has_order"):
        assert got[c] == 1, c
    for c in ("order_id", "order_amount", "product_category"):
        assert got[c] == 3, c


def test_rule_violations(golden):
    assert tuple(clean.rule_violations(golden).first()) == (1, 1, 1)
    assert tuple(clean.rule_violations(clean.normalize_contacts(golden)).first()) == (1, 0, 0)


def test_kpis(golden):
    k = metrics.kpis(clean.normalize_contacts(golden)).first()
    assert k.total_contacts == 12
    assert abs(k.order_rate - 6 / 11) < 1e-12
    assert (k.orders, k.non_orders, k.unknown_flag) == (6, 5, 1)
    assert abs(k.non_order_rate - 5 / 12) < 1e-12


def test_monthly(golden):
    df = clean.normalize_contacts(golden)
    got = {(r.year, r.month): (r.total_contacts, r.total_orders) for r in trends.monthly_summary(df).collect()}
    assert got == {(2025, 1): (3, 2), (2025, 2): (3, 1), (2025, 5): (2, 1), (2025, 11): (4, 2)}
    got = {(r.year, r.month): (r.interested, r.not_interested) for r in trends.monthly_interest(df).collect()}
    assert got == {(2025, 1): (2, 0), (2025, 2): (1, 2), (2025, 5): (2, 0), (2025, 11): (2, 2)}


def test_channel_share(golden):
    rows = channels.channel_category_share(clean.normalize_contacts(golden)).collect()
    got = {(r.channel, r.product_category): (r.share_pct, r.channel_orders) for r in rows}
    assert got == {("llamada", "NA"): (25.0, 4), ("llamada", "conectividad"): (50.0, 4),
                   ("llamada", "movilidad"): (25.0, 4), ("whatsapp", "hogar"): (50.0, 2),
                   ("whatsapp", "movilidad"): (50.0, 2)}


def test_agents(golden):
    df = clean.normalize_contacts(golden)
    got = [(r.agent_id[-1], r.total_orders, r.total_contacts) for r in agents.top_agents(df, 10).collect()]
    assert got == [("1", 2, 3), ("3", 2, 3), ("2", 1, 3), ("4", 1, 2), ("0", 0, 1)]
    bottom = [r.agent_id[-1] for r in agents.bottom_agents(df, 2).collect()]
    assert bottom == ["0", "2"]


def test_weekdays(golden):
    df = golden.orderBy("interaction_id").select(cal.weekday_sun1("contact_ts").alias("s"),
                                                 cal.weekday_mon0("contact_ts").alias("m")).collect()
    sun1 = [r.s for r in df]
    mon0 = [r.m for r in df]
    assert [x for i, x in enumerate(sun1) if i != 5] == [2, 6, 1, 6, 5, 3, 6, 1, 2, 2, 6]
    assert [x for i, x in enumerate(mon0) if i != 5] == [0, 4, 6, 4, 3, 1, 4, 6, 0, 0, 4]
    norm = clean.normalize_contacts(golden).where("interaction_id = 6")
    assert norm.select(cal.weekday_sun1("contact_ts")).first()[0] == 4
    assert norm.select(cal.weekday_mon0("contact_ts")).first()[0] == 2


def test_cleaners(golden):
    rows = by_id(golden.select("interaction_id", tx.clean_basic("note").alias("b"),
                               tx.clean_strict("note").alias("s"),
                               tx.clean_strict("note").alias("se")))
    assert rows[1].b == "mostró más interés en conectividad"
    assert rows[5].b == "mañana compra equipos"
    assert rows[7].b == "cliente ocupado"
    assert rows[8].b == ""
    assert rows[9].b == "señal débil g"
    assert rows[6].b == ""
    assert rows[1].s == "mostro mas interes en conectividad"
    assert rows[5].s == "manana compra equipos"
    assert rows[9].s == "senal debil g"
    assert all(r.s == r.se for r in rows.values())


def test_confusion_and_metrics(golden):
    df = clean.normalize_contacts(golden).where(F.col("has_order").isNotNull())
    pred = df.select(F.col("has_order").cast("double").alias("label"),
                     (F.col("agent_result") == "interesado").cast("double").alias("prediction"))
    cm = {(r.label, r.prediction): r["count"] for r in evaluation.confusion_matrix(pred).collect()}
    assert cm == {(0.0, 0.0): 4, (0.0, 1.0): 1, (1.0, 0.0): 1, (1.0, 1.0): 5}
    m = {r.metric: r.value for r in evaluation.metrics_from_confusion(evaluation.confusion_matrix(pred)).collect()}
    assert abs(m["accuracy"] - 9 / 11) < 1e-12
    assert abs(m["precision"] - 4 / 5) < 1e-12 and abs(m["recall"] - 4 / 5) < 1e-12
    assert abs(m["precision_1"] - 5 / 6) < 1e-12 and abs(m["recall_1"] - 5 / 6) < 1e-12


def test_tokenizer_patterns(spark):
    df = spark.createDataFrame([("mostró más interés",)], "t string")
    ascii_ = RegexTokenizer(inputCol="t", outputCol="o", pattern=r"\W+", minTokenLength=2)
    assert ascii_.transform(df).first().o == ["mostr", "inter"]
    from callsight.operators.words import tokenize, ASCII_NONWORD
    assert df.select(tokenize("t")).first()[0] == ["mostró", "más", "interés"]
    assert df.select(tokenize("t", ASCII_NONWORD)).first()[0] == ["mostr", "inter"]
