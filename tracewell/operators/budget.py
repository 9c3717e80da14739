"""Byte budgets of items and of browser report bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell import contracts as C
from tracewell import schemas
from tracewell.functions import sizing, text
from tracewell.functions.let import computed_once


def wire_fields(df: DataFrame, record_type: str) -> list[T.StructField]:
    """The item's columns, in contract order as far as the schema names one."""
    known = [f.name for f in schemas.ITEMS[record_type].fields]
    return [df.schema[name] for name in known if name in df.columns]


def _wire_value(field: T.StructField) -> Column:
    """A column as it goes on the wire: header lists become objects, other nested types VARIANT."""
    column = F.col(f"`{field.name}`")
    if field.dataType == schemas.HEADERS:
        return F.map_from_entries(F.transform(column, lambda h: F.struct(h["name"], h["values"])))
    return column


def item_json(df: DataFrame, record_type: str) -> Column:
    """The whole item as JSON text, null fields included."""
    fields = [_wire_value(f).alias(f.name) for f in wire_fields(df, record_type)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def item_bytes(df: DataFrame, record_type: str) -> Column:
    return sizing.json_text_bytes(item_json(df, record_type))


def item_budget(
    df: DataFrame,
    record_type: str,
    keep=(),
    max_item: int = C.MAX_ITEM_BYTES,
    max_field: int = C.MAX_ITEM_FIELD_BYTES,
    dropped_too: bool = False,
) -> DataFrame:
    """Items as `data` (JSON text) with `bytes` and `budget_status` ok, shrunk or dropped.

    An item within budget stays as it is.  Over it, long strings are cut and large nested values
    replaced whole; if that is not enough the item goes, never replaced by a marker of its own.
    `dropped_too` keeps the dropped rows, for reports.
    """
    fields = wire_fields(df, record_type)
    measured = df.select(*[F.col(k) for k in keep], *[F.col(f"`{f.name}`") for f in fields if f.name not in keep])
    measured = measured.withColumn("_full", item_json(df, record_type))
    measured = measured.withColumn("_full_bytes", sizing.json_text_bytes(F.col("_full")))

    def shrink(field: T.StructField) -> Column:
        value = _wire_value(field)
        if isinstance(field.dataType, T.StringType):
            cut = F.concat(text.cut_utf8(value, max_field), F.lit(C.TRUNCATION_SUFFIX))
            return F.when(F.octet_length(value) > max_field, cut).otherwise(value)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            rendered = F.to_json(value, {"ignoreNullFields": "false"})
            return F.when(sizing.json_text_bytes(rendered) > max_field, sizing.truncation_marker(C.FIELD_REASON)).otherwise(
                F.parse_json(rendered)
            )
        return value

    small = F.to_json(F.struct(*[shrink(f).alias(f.name) for f in fields]), {"ignoreNullFields": "false"})
    over = F.col("_full_bytes") > max_item
    sized = measured.withColumn("data", F.when(over, small).otherwise(F.col("_full")))
    sized = sized.withColumn(
        "bytes", F.when(over, sizing.json_text_bytes(F.col("data"))).otherwise(F.col("_full_bytes"))
    )
    status = F.when(~over, "ok").when(F.col("bytes") <= max_item, "shrunk").otherwise("dropped")
    out = sized.withColumn("budget_status", status).select(*keep, "data", "bytes", "budget_status")
    return out if dropped_too else computed_once(out).where(F.col("budget_status") != "dropped")


def budget_report(budgeted: DataFrame, keys=("type",)) -> DataFrame:
    return budgeted.groupBy(*keys, "budget_status").agg(
        F.count(F.lit(1)).alias("items"), F.sum("bytes").alias("bytes")
    )


def fit_report_body(
    df: DataFrame,
    fields=("message", "filename", "line", "column", "stack", "type", "context", "breadcrumbs", "browser_info", "url", "timestamp"),
    limit: int = C.REPORT_BODY_LIMIT,
) -> DataFrame:
    """Browser report bodies: as they are, else with the newer half of the breadcrumbs, else
    without context, else flagged as not to be kept alive.

    Adds `body`, `keepalive` and `fit_step`.  Length counts UTF-16 units, as a browser does.
    """
    present = [f for f in fields if f in df.columns]

    def body(**changed: Column) -> Column:
        parts = [changed.get(f, F.col(f"`{f}`")).alias(f) for f in present]
        return F.to_json(F.struct(*parts))

    crumbs = F.col("breadcrumbs")
    count = F.coalesce(F.size(crumbs), F.lit(0))
    half = F.when(count > 0, F.slice(crumbs, F.floor(count / 2).cast("int") + 1, F.greatest(count, F.lit(1)))).otherwise(crumbs)
    bare = F.parse_json(F.lit("{}"))
    has_context = F.col("context").isNotNull() & ~F.to_json("context").isin("{}", "[]")
    out = df.withColumn("_b0", body())
    fits0 = sizing.utf16_length(F.col("_b0")) <= limit
    out = out.withColumn("_b1", F.when(~fits0, body(breadcrumbs=half)))
    fits1 = sizing.utf16_length(F.col("_b1")) <= limit
    emptied = F.when(has_context, bare).otherwise(F.col("context"))
    out = out.withColumn("_b2", F.when(~fits0 & ~fits1, body(breadcrumbs=half, context=emptied)))
    fits2 = sizing.utf16_length(F.col("_b2")) <= limit
    return out.withColumns(
        {
            "fit_step": F.when(fits0, "whole").when(fits1, "half_breadcrumbs").when(fits2, "no_context").otherwise("oversize"),
            "body": F.coalesce("_b2", "_b1", "_b0"),
            "keepalive": F.coalesce(fits0 | fits1 | fits2, F.lit(False)),
        }
    ).drop("_b0", "_b1", "_b2")
