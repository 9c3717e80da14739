"""Spark schemas of the record types, the spool envelope and the delivery tables."""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("values", T.ArrayType(T.StringType())),
        ]
    )
)

BREADCRUMBS = T.ArrayType(
    T.StructType(
        [
            T.StructField("timestamp", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("message", T.StringType()),
            T.StructField("data", T.VariantType()),
        ]
    )
)


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in pairs])


ITEMS = {
    "errors": _fields(
        ("message", T.StringType()),
        ("file", T.StringType()),
        ("line", T.LongType()),
        ("type", T.StringType()),
        ("environment", T.StringType()),
        ("trace", T.StringType()),
        ("headers", HEADERS),
        ("context", T.StringType()),
        ("highlight_line", T.LongType()),
        ("user", _fields(("id", T.StringType()), ("email", T.StringType()))),
        ("timestamp", T.StringType()),
        ("url", T.StringType()),
        ("method", T.StringType()),
        ("php_version", T.StringType()),
        ("framework", T.StringType()),
        ("framework_version", T.StringType()),
        ("is_console", T.BooleanType()),
        ("console_command", T.StringType()),
        ("console_arguments", T.ArrayType(T.StringType())),
    ),
    "events": _fields(
        ("event_name", T.StringType()),
        ("timestamp", T.StringType()),
        ("properties", T.VariantType()),
        ("user", _fields(("id", T.StringType()))),
        ("url", T.StringType()),
        ("user_agent_hash", T.StringType()),
        ("session_id_hash", T.StringType()),
    ),
    "logs": _fields(
        ("level", T.StringType()),
        ("message", T.StringType()),
        ("context", T.VariantType()),
        ("channel", T.StringType()),
        ("timestamp", T.StringType()),
        ("extra", T.VariantType()),
    ),
    "javascript_errors": _fields(
        ("message", T.StringType()),
        ("stack", T.StringType()),
        ("type", T.StringType()),
        ("filename", T.StringType()),
        ("line", T.LongType()),
        ("column", T.LongType()),
        ("user_agent", T.StringType()),
        ("url", T.StringType()),
        ("timestamp", T.StringType()),
        ("environment", T.StringType()),
        ("user_id", T.StringType()),
        ("session_id", T.StringType()),
        ("breadcrumbs", BREADCRUMBS),
        ("context", T.VariantType()),
        ("browser_info", T.VariantType()),
    ),
}

# One spooled record.  `seq` is the arrival number (unique per type): rows of a table have no
# order of their own, so every FIFO rule reads it.  `data` is the item as JSON text, `bytes` its
# size on the wire.
SPOOL = _fields(
    ("type", T.StringType()),
    ("id", T.StringType()),
    ("seq", T.LongType()),
    ("timestamp", T.LongType()),
    ("data", T.StringType()),
    ("bytes", T.LongType()),
)

RAW_RESPONSES = _fields(
    ("type", T.StringType()),
    ("batch_no", T.LongType()),
    ("status", T.IntegerType()),
    ("retry_after", T.StringType()),
    ("body", T.StringType()),
    ("at", T.LongType()),
    ("transport_error", T.StringType()),
)

PAUSES = _fields(
    ("scope", T.StringType()),
    ("started_at", T.LongType()),
    ("paused_until", T.LongType()),
    ("reason", T.StringType()),
)
