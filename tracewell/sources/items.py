"""Readers of spools, items, batch bodies, responses and diagnostics.

Every reader works for batches and, with `stream=True`, for streams of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell import contracts as C
from tracewell import schemas
from tracewell.functions import rules, sizing
from tracewell.sources.json_list import read_json_list


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def _known(record_type: str) -> str:
    if record_type not in C.TYPES:
        raise ValueError(f"unknown record type: {record_type}")
    return record_type


def _documents(spark: SparkSession, path: str, whole: bool, stream: bool) -> DataFrame:
    """JSON documents as text, one per file or one per line, and their file's name."""
    reader = _reader(spark, stream)
    if whole:
        reader = reader.option("wholetext", "true")
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def read_spool(spark: SparkSession, path: str, record_type: str, stream: bool = False, split: bool = False, block_bytes: int | None = None) -> DataFrame:
    """Envelopes of spool files, each a JSON list; `pos` is the place in the list.

    An unreadable file counts as empty.  Entries without a string id, nested data and an integer
    timestamp are dropped.  Each entry is parsed by itself, so the limit on a VARIANT's size holds
    for an entry and not for the file, which may be as long as a string.  With `split` a file is read
    by many tasks and may be of any length; it is then read twice, and jobs run when this is called.
    """
    _known(record_type)
    if split:
        if stream:
            raise ValueError("files of a stream are read whole")
        return _envelopes(read_json_list(spark, path, block_bytes), record_type)
    listed = F.from_json("value", "array<variant>")
    is_list = F.col("value").rlike(r"^\s*+\[")
    entries = _documents(spark, path, True, stream).where(is_list).select("file", F.posexplode(listed).alias("pos", "entry"))
    return _envelopes(entries, record_type)


def read_spool_lines(spark: SparkSession, path: str, record_type: str, stream: bool = False) -> DataFrame:
    """Envelopes of a spool kept as one JSON object per line: splittable, so of any size."""
    _known(record_type)
    rows = _documents(spark, path, False, stream)
    entries = rows.select("file", F.lit(0).alias("pos"), F.try_parse_json("value").alias("entry"))
    return _envelopes(entries, record_type)


def read_spool_table(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """A spool kept as a table; a filter on `type` reads that type's folder only."""
    return _reader(spark, stream).schema(schemas.SPOOL).parquet(path)


def _envelopes(entries: DataFrame, record_type: str) -> DataFrame:
    entry = F.col("entry")
    id_, data, at = (rules.variant_field(entry, k) for k in ("id", "data", "timestamp"))
    whole = (
        (rules.variant_kind(id_) == "string")
        & (rules.variant_kind(data) == "array")
        & (rules.variant_kind(at) == "integer")
    )
    text = F.to_json(data)
    return entries.where(whole).select(
        F.lit(record_type).alias("type"),
        id_.try_cast("string").alias("id"),
        at.try_cast("bigint").alias("timestamp"),
        text.alias("data"),
        sizing.json_text_bytes(text).alias("bytes"),
        "file",
        "pos",
    )


def read_items(
    spark: SparkSession, path: str, record_type: str, fmt: str = "json", stream: bool = False
) -> DataFrame:
    """Items with the schema of their type, never an inferred one; a broken line gives nulls and
    shows in `_corrupt_record`."""
    schema = schemas.ITEMS[_known(record_type)]
    if fmt != "json":
        return _reader(spark, stream).schema(schema).format(fmt).load(path)
    wire = T.StructType(
        [
            T.StructField(f.name, T.MapType(T.StringType(), T.ArrayType(T.StringType())) if f.dataType == schemas.HEADERS else f.dataType)
            for f in schema.fields
        ]
        + [T.StructField("_corrupt_record", T.StringType())]
    )
    rows = _reader(spark, stream).schema(wire).option("mode", "PERMISSIVE").json(path)
    if "headers" in rows.columns:
        as_list = F.transform(
            F.map_entries("headers"), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("values"))
        )
        rows = rows.withColumn("headers", as_list)
    return rows


def body_items(bodies: DataFrame, body: Column, keep=()) -> DataFrame:
    """Items of batch bodies with their zero-based position; the single key names the type."""
    members = F.map_entries(F.try_parse_json(body).try_cast("map<string,variant>"))
    single = bodies.select(*keep, members.alias("_m")).where(F.size("_m") == 1)
    return (
        single.select(*keep, F.col("_m")[0]["key"].alias("wrapper"), F.col("_m")[0]["value"].alias("_list"))
        .select(*keep, "wrapper", F.posexplode(F.col("_list").try_cast("array<variant>")).alias("batch_pos", "item"))
    )


def read_batch_bodies(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Items of bodies that `write_batches` wrote, each with its batch's number, so that responses
    can be joined to what was sent; a line without a number is a body with none."""
    rows = _reader(spark, stream).format("text").load(path)
    keep = [c for c in rows.columns if c != "value"]
    number, body = (F.regexp_extract("value", r"(?s)^(?:(\d+)\t)?+(.*)$", i) for i in (1, 2))
    return body_items(rows.select(*keep, number.try_cast("bigint").alias("batch_no"), body.alias("_body")), F.col("_body"), [*keep, "batch_no"])


def normalize_responses(raw: DataFrame) -> DataFrame:
    """Responses with counters: absent ones are 0, a body that is no object counts as empty, an
    absent Retry-After is an empty string.  `transport_error`, where there is one, is what the
    client says of a request that got no answer (status 0)."""
    parsed = F.try_parse_json("body")
    body = F.when(rules.variant_kind(parsed) == "array", parsed)
    rows = raw.withColumn("_body", body)
    items = rules.variant_field(F.col("_body"), "items")

    def counter(name: str) -> Column:
        value = rules.variant_field(items, name)
        numeric = rules.variant_kind(value).isin("integer", "number", "string")
        return F.coalesce(
            F.when(numeric, value.try_cast("double").try_cast("int")), F.lit(0)
        ).alias(name)

    listed = rules.variant_field(F.col("_body"), "unprocessed_indexes").try_cast("array<variant>")
    whole = F.filter(listed, lambda v: F.schema_of_variant(v) == "BIGINT")
    indexes = F.transform(whole, lambda v: v.try_cast("int"))
    message = rules.variant_field(rules.variant_field(F.col("_body"), "error"), "message")
    is_text = rules.variant_kind(message) == "string"
    is_2xx = F.col("status").between(200, 299)
    given_error = F.nullif(F.col("transport_error"), F.lit("")) if "transport_error" in raw.columns else F.lit(None).cast("string")
    return rows.select(
        "type",
        "batch_no",
        F.coalesce("status", F.lit(0)).alias("status"),
        F.coalesce("retry_after", F.lit("")).alias("retry_after"),
        F.when(is_text, message.try_cast("string")).alias("error_message"),
        *[counter(n) for n in ("received", "processed", "ignored", "failed", "unprocessed")],
        F.coalesce(indexes, F.array().cast("array<int>")).alias("unprocessed_indexes"),
        (is_2xx & F.col("_body").isNotNull()).alias("success"),
        F.coalesce(given_error, F.when(is_2xx & F.col("_body").isNull(), "Invalid response format")).alias("error"),
        "at",
    )


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    return normalize_responses(_reader(spark, stream).schema(schemas.RAW_RESPONSES).format(fmt).load(path))


DIAGNOSTIC_LINE = r"^\[([^\]]+)\] ([^\s.]+(?:\.[^\s.]+)*)\.([A-Z]+): (.*?)(?: (\{.*\}|\[.*\]))?\z"


def parse_diagnostics(lines: DataFrame, value: str = "value") -> DataFrame:
    """`[time] channel.LEVEL: message {context}` lines; other lines are left out."""
    part = [F.regexp_extract(value, DIAGNOSTIC_LINE, i) for i in range(6)]
    return lines.where(F.col(value).rlike(DIAGNOSTIC_LINE)).select(
        *[c for c in lines.columns if c != value],
        part[1].alias("at"),
        part[2].alias("channel"),
        F.lower(part[3]).alias("level"),
        part[4].alias("message"),
        F.try_parse_json(F.nullif(part[5], F.lit(""))).alias("context"),
    )


def read_diagnostics(spark: SparkSession, path: str, since: Column | None = None, stream: bool = False) -> DataFrame:
    """Diagnostics by day; `since` prunes whole days before a line is read."""
    rows = _reader(spark, stream).format("text").load(path)
    if since is not None:
        rows = rows.where(F.col("day") >= since)
    return parse_diagnostics(rows)
