"""Fitted models kept for the life of a Spark application.

The studied app trains a model once per session and scores with it many
times; this cache does the same: a model is fitted on first use for a
(application, input, kind) key and reused by the later scoring queries of
that application.  What is kept lives on the driver: model objects
(coefficients, vocabularies) and plain values; a frame in a result is kept as
its rows.  A second thread that asks for a model being fitted waits for it.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_CACHE: dict[tuple, Any] = {}
_FITTING: dict[tuple, Lock] = {}
_LOCK = Lock()


def fitted(spark: SparkSession, key: tuple, fit: Callable[[], tuple]) -> tuple:
    """The result of ``fit()`` for ``key`` in this application; its frames must be small (metrics, confusion)."""
    k = (spark.conf.get("spark.app.id", None) or id(spark), *key)
    with _LOCK:
        own = _FITTING.setdefault(k, Lock())
    with own:
        if k not in _CACHE:
            _CACHE[k] = tuple((x.collect(), x.schema) if isinstance(x, DataFrame) else (x, None) for x in fit())
        return tuple(spark.createDataFrame(x, schema) if schema is not None else x for x, schema in _CACHE[k])


def clear() -> None:
    with _LOCK:
        _CACHE.clear()
