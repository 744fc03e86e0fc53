"""Contact table schema, sentinels and value domains.

A contact is one call or message between an agent and a client, with the
agent's verdict, a free-text note and possibly an order.  The schema is
fixed (no inference pass over the input) so the reader does a single scan
and sentinel strings can always be written into string columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the studied application's for equal results.
# ---------------------------------------------------------------------------
SENTINEL_CLIENT = "C000000000"
SENTINEL_AGENT = "A000000000"
UNKNOWN_CHANNEL = "desconocido"
UNKNOWN_RESULT = "no_especificado"
MISSING_NOTE = "Sin nota capturada"
DEFAULT_TS = "2025-01-01 00:00:00"
NO_ORDER_ID = "NA"
MISSING_ORDER_ID = "P000000000"
NO_CATEGORY = "NA"
CHANNELS = ("llamada", "whatsapp")
RESULTS = ("interesado", "no_interesado")
CATEGORIES = ("conectividad", "movilidad", "hogar")
ID_PATTERNS = {"client_id": r"^C[0-9]{9}$", "agent_id": r"^A[0-9]{9}$",
               "order_id": r"^(P[0-9]{9}|NA)$"}
TS_RANGE = ("2025-01-01 00:00:00", "2025-12-31 23:59:59")
AMOUNT_RANGE = (0.0, 34999.0)
WORK_HOURS = (9, 21)
# ---------------------------------------------------------------------------

CONTACT_COLUMNS = (
    "interaction_id",
    "client_id",
    "agent_id",
    "channel",
    "agent_result",
    "contact_ts",
    "note",
    "has_order",
    "order_id",
    "order_amount",
    "product_category",
)

_DESCRIPTIONS = {
    "interaction_id": "unique contact number",
    "client_id": "client, C + 9 digits",
    "agent_id": "agent, A + 9 digits",
    "channel": "llamada | whatsapp",
    "agent_result": "interesado | no_interesado",
    "contact_ts": "wall-clock time of the contact",
    "note": "free text written by the agent",
    "has_order": "1 when an order followed, else 0",
    "order_id": "P + 9 digits, or NA without order",
    "order_amount": "0, or the order amount",
    "product_category": "conectividad | movilidad | hogar | NA",
}

_TYPES = {
    "interaction_id": T.LongType(),
    "client_id": T.StringType(),
    "agent_id": T.StringType(),
    "channel": T.StringType(),
    "agent_result": T.StringType(),
    # Naive wall-clock time: results never depend on the session time zone.
    "contact_ts": T.TimestampNTZType(),
    "note": T.StringType(),
    "has_order": T.IntegerType(),
    "order_id": T.StringType(),
    "order_amount": T.DoubleType(),
    "product_category": T.StringType(),
}

CONTACT_SCHEMA = T.StructType(
    [
        T.StructField(c, _TYPES[c], nullable=(c != "interaction_id"),
                      metadata={"description": _DESCRIPTIONS[c]})
        for c in CONTACT_COLUMNS
    ]
)

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("order_amount", T.DoubleType()),
    ]
)

SENTINELS = {
    "client_id": SENTINEL_CLIENT,
    "agent_id": SENTINEL_AGENT,
    "channel": UNKNOWN_CHANNEL,
    "agent_result": UNKNOWN_RESULT,
    "note": MISSING_NOTE,
}


def describe_schema(schema: T.StructType = CONTACT_SCHEMA) -> list[tuple[str, str, str]]:
    """(column, Spark type, description) triples, e.g. for a schema report."""
    return [(f.name, f.dataType.simpleString(), f.metadata.get("description", ""))
            for f in schema.fields]
