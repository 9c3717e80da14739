"""Writers of batch bodies, spools, rejected items and diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell import contracts as C


def write_batches(bodies: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bodies of `batching.packed_bodies`, one per line: its batch number, a tab, and the JSON body; a folder per type.

    Bodies are written by the tasks that built them; `mode` overwrite makes a repeat harmless.
    """
    line = F.concat(F.col("batch_no").cast("string"), F.lit("\t"), F.col("body"))
    bodies.select("type", line.alias("value")).write.partitionBy("type").mode(mode).text(path)


def write_spool_lines(spool: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A spool as one JSON envelope per line, in a folder per type."""
    spool.select("type", envelope_json().alias("value")).write.partitionBy("type").mode(mode).text(path)


def write_spool(spool: DataFrame, path: str, mode: str = "append") -> None:
    """A spool as a table in a folder per type: what later steps read more than once."""
    spool.write.partitionBy("type").mode(mode).parquet(path)


def envelope_json() -> Column:
    """`{"id", "data", "timestamp"}`; the item's text is placed as it is."""
    quoted_id = F.to_json(F.struct(F.col("id").alias("id")))
    return F.concat(
        F.substr(quoted_id, F.lit(1), F.length(quoted_id) - 1),
        F.lit(',"data":'),
        F.col("data"),
        F.lit(',"timestamp":'),
        F.col("timestamp").cast("string"),
        F.lit("}"),
    )


def write_quarantine(rejected: DataFrame, path: str, by=("type",), mode: str = "append") -> None:
    """Rejected items with their reasons."""
    rejected.write.partitionBy(*by).mode(mode).parquet(path)


def diagnostic_lines(df: DataFrame, channel: str = "internal") -> DataFrame:
    """`at` (ISO string), `level`, `message`, `context` (VARIANT or null) to text lines by day.

    A diagnostic is one line: line breaks in its message are written as `\\n`.
    """
    shown = F.coalesce(F.to_json("context"), F.lit("{}"))
    suffix = F.when(shown.isin("{}", "[]"), "").otherwise(F.concat(F.lit(" "), shown))
    line = F.concat(
        F.lit("["), F.col("at"), F.lit(f"] {channel}."), F.upper("level"), F.lit(": "),
        F.regexp_replace("message", r"\r\n|[\n\r]", r"\\n"), suffix,
    )
    return df.select(F.substring("at", 1, 10).alias("day"), line.alias("value"))


def write_diagnostics(df: DataFrame, path: str, channel: str = "internal", mode: str = "append") -> None:
    diagnostic_lines(df, channel).write.partitionBy("day").mode(mode).text(path)


def prune_diagnostics(df: DataFrame, today: Column, days: int = C.DIAGNOSTICS_DAYS, day: str = "day") -> DataFrame:
    """Days within retention; on a table partitioned by day, older folders are not read."""
    if days < 1:
        return df
    return df.where(F.col(day).cast("date") >= F.date_sub(today, days))
