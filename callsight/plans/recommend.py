"""Contact-hour and channel recommendation.

The studied app answers one request per click with 15 sequential one-row
jobs.  Here any number of requests is one plan: the requests' distinct
profiles (channel, result, hour) are crossed with the 13 candidate hours
by ``explode(sequence(9, 21))`` (a generator, not a join), scored, ranked
with a per-profile window, turned into actions, and joined back to the
requests.  The profile table is bounded by the category domains times 24
hours, so the join back never moves the requests more than once.

Scoring is pluggable: ``rate_scorer`` uses order rates measured on given
contacts (SQL-comparable), ``model_scorer`` a fitted order model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .features import with_time_features

# Candidate hours, reference date, improvement margin, texts.
HOURS = (9, 21)
REFERENCE_DATE = (2025, 1, 1)
MARGIN = 0.03
TOP_K = 3
PRIOR_CONTACTS = 10.0
BROADCAST_PROFILES = 10_000
CLASS_TEXT = {1: "Sí generaría pedido", 0: "No generaría pedido"}

Scorer = Callable[[DataFrame], DataFrame]


def other_channel(c) -> F.Column:
    """H3: whatsapp when the channel is llamada, otherwise llamada."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "llamada", F.lit("whatsapp")).otherwise(F.lit("llamada"))


def candidate_ts(hour_col: str = "hour") -> F.Column:
    y, m, d = REFERENCE_DATE
    return F.make_timestamp_ntz(F.lit(y), F.lit(m), F.lit(d), F.col(hour_col), F.lit(0), F.lit(0))


def rate_scorer(contacts: DataFrame, prior: float = PRIOR_CONTACTS) -> Scorer:
    """Adds ``p``: the order rate of ``contacts`` (with ``hour`` and
    ``has_order``) at (channel, result, hour), drawn towards the overall rate
    by ``prior`` contacts; profiles without contacts have the overall rate."""
    overall = contacts.select(F.sum("has_order").cast("double") / F.count("has_order").cast("double")).scalar()
    rates = contacts.groupBy("channel", "agent_result", "hour").agg(
        ((F.sum("has_order").cast("double") + F.lit(prior) * overall)
         / (F.count("has_order").cast("double") + F.lit(prior))).alias("p"))

    def score(df: DataFrame) -> DataFrame:
        own = df.columns
        return df.join(rates, ["channel", "agent_result", "hour"], "left").select(
            *own, F.coalesce("p", overall).alias("p"))
    return score


def model_scorer(model: PipelineModel) -> Scorer:
    """Adds ``p`` = P(order) from a fitted order pipeline."""
    def score(df: DataFrame) -> DataFrame:
        x = with_time_features(df.withColumn("_ts", candidate_ts()), "_ts")
        return model.transform(x).withColumn("p", vector_to_array("probability")[1]) \
            .select(*df.columns, "p")
    return score


def score_hours(profiles: DataFrame, scorer: Scorer) -> DataFrame:
    """Every (channel, result) profile at every candidate hour."""
    lo, hi = HOURS
    grid = profiles.select("channel", "agent_result").distinct() \
        .withColumn("hour", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
    return scorer(grid)


def best_hours(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` best hours per profile (ties: the later hour first),
    with the ``HH:00 (~p%)`` text."""
    w = Window.partitionBy("channel", "agent_result").orderBy(F.desc("p"), F.desc("hour"))
    top = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.withColumn("label", F.format_string("%02d:00 (~%.1f%%)", F.col("hour"), F.col("p") * 100))


def recommend_actions(requests: DataFrame, scorer: Scorer, id_col: str = "request_id",
                      margin: float = MARGIN) -> DataFrame:
    """H3-H5 per request (``id_col, channel, agent_result, hour``): current
    probability, best hour, other channel's probability, the actions that
    would raise the probability by more than ``margin``, and the class text."""
    profiles = requests.select("channel", "agent_result", "hour").distinct()
    prof = profiles.withColumn("other_channel", other_channel("channel"))
    cur = scorer(profiles).withColumnRenamed("p", "p_current")
    oth = scorer(prof.select(F.col("other_channel").alias("channel"), "agent_result", "hour").distinct()) \
        .withColumnsRenamed({"channel": "other_channel", "p": "p_other"})
    top = best_hours(score_hours(profiles, scorer))
    summary = (top.groupBy("channel", "agent_result")
                  .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "label"))),
                                                lambda x: x["label"]), ", ").alias("best_hours_text"),
                       F.min_by("hour", "rank").alias("best_hour"),
                       F.min_by("p", "rank").alias("best_p")))
    prof = (prof.join(cur, ["channel", "agent_result", "hour"], "left")
                .join(oth, ["other_channel", "agent_result", "hour"], "left")
                .join(summary, ["channel", "agent_result"], "left"))
    resched = (F.col("best_hour") != F.col("hour")) & (F.col("best_p") > F.col("p_current") + F.lit(margin))
    switch = F.col("p_other") > F.col("p_current") + F.lit(margin)
    actions = F.array_compact(F.array(
        F.when(resched, F.format_string("reschedule to %02d:00 (~%.1f%%)", F.col("best_hour"), F.col("best_p") * 100)),
        F.when(switch, F.format_string("switch to %s (~%.1f%%)", F.col("other_channel"), F.col("p_other") * 100))))
    prof = prof.withColumns({
        "actions": F.when(F.size(actions) > 0, F.array_join(actions, "; ")).otherwise(F.lit("keep")),
        "predicted_text": F.when(F.col("p_current") > 0.5, F.lit(CLASS_TEXT[1])).otherwise(F.lit(CLASS_TEXT[0])),
    })
    # domains x 24 hours if channel and result are categories: then no request
    # is shuffled; free-text values beyond the checked bound join by shuffle
    if profiles.count() <= BROADCAST_PROFILES:
        prof = F.broadcast(prof)
    return requests.select(id_col, "channel", "agent_result", "hour").join(
        prof, ["channel", "agent_result", "hour"], "left")


def requests_from_contacts(contacts: DataFrame) -> DataFrame:
    """F4 requests from a contact table: its channel, result and hour."""
    return contacts.select(F.col("interaction_id").alias("request_id"), "channel", "agent_result",
                           F.hour("contact_ts").alias("hour"))
