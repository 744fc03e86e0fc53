"""Named queries over the driver tables, each with its DuckDB oracle text.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on Spark; ``ORACLE[name]``
is the same question in DuckDB SQL over the same parquet tables (views
``events``, ``documents``, ``labels`` ...).  Contacts come from the adapter
(:mod:`callsight.sources.adapter`) in both engines.  Column names are
identical on both sides; doubles that are sums of doubles are rounded to a
fixed scale on both sides; timestamps are emitted as text.  Queries without
an oracle entry (fitted models) are checked by row counts and invariants.
"""

from . import reports, scoring, text, models  # noqa: F401  (registration side effects)
from .registry import ORACLE, QUERIES, contacts  # noqa: F401
