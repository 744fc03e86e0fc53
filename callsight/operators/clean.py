"""Type casts, sentinel filling, order-consistency rules and checks.

All rules are column expressions over one projection (P1-P6 collapse into
a single ``Project``); checks are one aggregate each, never one job per rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scalar import category_or_default
from ..functions.text import clean_basic


# --- P1-P7 ------------------------------------------------------------------------

def cast_types(df: DataFrame) -> DataFrame:
    """Flag -> int, amount -> double, time -> timestamp.  ``try_cast``:
    an unparsable value becomes NULL instead of failing the job (ANSI)."""
    casts = {"has_order": "int", "order_amount": "double", "contact_ts": "timestamp_ntz"}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns})


def fill_sentinels(df: DataFrame) -> DataFrame:
    """NULL -> per-column sentinel for client, agent, channel, result, note."""
    return df.na.fill({c: v for c, v in S.SENTINELS.items() if c in df.columns})


def fill_timestamp(df: DataFrame, default: str = S.DEFAULT_TS) -> DataFrame:
    """NULL contact time -> fixed default."""
    return df.withColumn("contact_ts", F.coalesce(
        F.col("contact_ts"), F.to_timestamp_ntz(F.lit(default), F.lit("yyyy-MM-dd HH:mm:ss"))))


def _order_rule(column: str, no_order, missing):
    """flag = 0 -> ``no_order``; otherwise (1 or NULL, see T6) NULL -> ``missing``."""
    return (F.when(F.col("has_order") == 0, F.lit(no_order))
            .otherwise(F.coalesce(F.col(column), F.lit(missing))))


def order_rules(df: DataFrame) -> DataFrame:
    """P4-P6 in one projection: order id, amount and category against the flag."""
    return df.withColumns({
        "order_id": _order_rule("order_id", S.NO_ORDER_ID, S.MISSING_ORDER_ID),
        "order_amount": _order_rule("order_amount", 0.0, 0.0),
        "product_category": _order_rule("product_category", S.NO_CATEGORY, S.NO_CATEGORY),
    })


def rule_order_id(df: DataFrame) -> DataFrame:
    return df.withColumn("order_id", _order_rule("order_id", S.NO_ORDER_ID, S.MISSING_ORDER_ID))


def rule_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("order_amount", _order_rule("order_amount", 0.0, 0.0))


def rule_category(df: DataFrame) -> DataFrame:
    return df.withColumn("product_category", _order_rule("product_category", S.NO_CATEGORY, S.NO_CATEGORY))


def normalize_contacts(df: DataFrame) -> DataFrame:
    """P1..P6 in order; the result is ready for every report.  Idempotent."""
    return (df.transform(cast_types).transform(fill_sentinels)
              .transform(fill_timestamp).transform(order_rules))


# --- P8-P16 ---------------------------------------------------------------------

def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``subset`` (all columns by default)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def project(df: DataFrame, *cols: str) -> DataFrame:
    """P9."""
    return df.select(*cols)


def ensure_clean_note(df: DataFrame, src: str = "note", out: str = "note_clean") -> DataFrame:
    """P10: add the cleaned note only when it is missing."""
    return df if out in df.columns else df.withColumn(out, clean_basic(src))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P11."""
    return df.withColumnsRenamed(mapping)


def category_without_default(df: DataFrame, col: str = "product_category",
                             default: str = "sin_categoria") -> DataFrame:
    """NULL category -> ``default``, then rows with ``default`` removed."""
    return df.withColumn(col, category_or_default(col, default)).where(F.col(col) != default)


# --- filters F1-F5 ----------------------------------------------------------------

def by_result(df: DataFrame, result: str) -> DataFrame:
    """F1."""
    return df.where(F.col("agent_result") == result)


def with_order(df: DataFrame) -> DataFrame:
    """flag = 1 (NULL flags are in neither side)."""
    return df.where(F.col("has_order") == 1)


def without_order(df: DataFrame) -> DataFrame:
    return df.where(F.col("has_order") == 0)


def rule_violations(df: DataFrame) -> DataFrame:
    """the three consistency rules as one aggregate (one scan):
    flag=1 with id 'NA'; flag=0 with amount != 0; flag=0 with category != 'NA'."""
    f = F.col("has_order")
    return df.agg(
        F.count_if((f == 1) & (F.col("order_id") == S.NO_ORDER_ID)).alias("order_without_id"),
        F.count_if((f == 0) & (F.col("order_amount") != 0)).alias("no_order_with_amount"),
        F.count_if((f == 0) & (F.col("product_category") != S.NO_CATEGORY)).alias("no_order_with_category"),
    )


def is_empty(df: DataFrame) -> bool:
    """F4 guard (an action: reads at most one row)."""
    return df.isEmpty()


def require_nonblank_note(df: DataFrame, col: str = "note") -> DataFrame:
    """keep rows whose note is not blank."""
    return df.where(F.length(F.trim(F.col(col))) > 0)


# --- S8 conformance ---------------------------------------------------------------

def schema_checks() -> dict[str, F.Column]:
    """Violation predicates derived from the declared domains (NULLs are
    reported by ``null_counts``, not here)."""
    lo, hi = S.TS_RANGE
    ts_lo = F.to_timestamp_ntz(F.lit(lo))
    ts_hi = F.to_timestamp_ntz(F.lit(hi))
    return {
        "client_id_format": ~F.col("client_id").rlike(S.ID_PATTERNS["client_id"]),
        "agent_id_format": ~F.col("agent_id").rlike(S.ID_PATTERNS["agent_id"]),
        "order_id_format": ~F.col("order_id").rlike(S.ID_PATTERNS["order_id"]),
        "channel_domain": ~F.col("channel").isin(*S.CHANNELS),
        "agent_result_domain": ~F.col("agent_result").isin(*S.RESULTS),
        "category_domain": ~F.col("product_category").isin(*S.CATEGORIES, S.NO_CATEGORY),
        "has_order_domain": ~F.col("has_order").isin(0, 1),
        "amount_range": ~F.col("order_amount").between(*S.AMOUNT_RANGE),
        "contact_ts_range": ~F.col("contact_ts").between(ts_lo, ts_hi),
        "hour_range": ~F.hour("contact_ts").between(*S.WORK_HOURS),
    }


def schema_violations(df: DataFrame) -> DataFrame:
    """Count of violating rows per check, long form (check, n_violations),
    plus duplicate interaction ids.  One aggregate pass plus one
    distinct-count (two-phase, no single-task collection)."""
    checks = schema_checks()
    wide = df.agg(*[F.count_if(p).alias(n) for n, p in checks.items()],
                  (F.count("interaction_id") - F.count_distinct("interaction_id"))
                  .alias("interaction_id_duplicates"))
    names = list(checks) + ["interaction_id_duplicates"]
    return wide.unpivot([], names, "check", "n_violations")


def failed_checks(corrupt_col: str | None = None) -> Column:
    """The names of the checks a row fails, in the order of :func:`schema_checks`; a record that did not parse
    (``corrupt_col`` holds its text) fails ``malformed_record`` first."""
    checks = schema_checks()
    if corrupt_col:
        checks = {"malformed_record": F.col(corrupt_col).isNotNull(), **checks}
    return F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in checks.items()]))


def split_conforming(df: DataFrame, corrupt_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S8 row by row: the rows that pass every check (without ``corrupt_col``) and the rejected ones with
    ``failed_checks``.  Both are filters over the same rows, nothing is shuffled."""
    judged = df.withColumn("failed_checks", failed_checks(corrupt_col))
    passed = judged.where(F.size("failed_checks") == 0).drop("failed_checks", *([corrupt_col] if corrupt_col else []))
    return passed, judged.where(F.size("failed_checks") > 0)
