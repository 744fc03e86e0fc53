"""Registry of named queries and their DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean
from ..sources.adapter import raw_contacts, with_contacts

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def register(name: str, sql: str | None = None, raw_sql: str | None = None):
    """Register a query; ``sql`` is wrapped with the contact CTEs, ``raw_sql`` is used as is."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_contacts(sql)
        elif raw_sql is not None:
            ORACLE[name] = raw_sql
        return fn
    return deco


def contacts(spark: SparkSession, sf_dir: str, notes: bool = False, clean_note=None,
             note_ref: bool = False) -> DataFrame:
    """Normalised contacts (P7 over the adapter); with ``clean_note`` also
    ``note_clean``, cleaned once per document text; with ``note_ref`` the
    key of the note's text instead of the text (see the adapter)."""
    return clean.normalize_contacts(raw_contacts(spark, sf_dir, notes=notes or clean_note is not None,
                                                 clean_note=clean_note, note_ref=note_ref))


def with_extra(cte_tail: str) -> str:
    """Contact CTEs followed by more CTEs: ``cte_tail`` starts with
    ``", name AS (...)"`` and ends with the final SELECT."""
    return with_contacts("").rstrip() + cte_tail
