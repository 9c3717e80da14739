"""Readers and writers, each checked by writing what the tables give and reading it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.operators import batching, shape, validate
from tracewell.plans import inputs
from tracewell.plans.registry import ORACLES, query
from tracewell.session import new_table_path
from tracewell.sources import items as sources
from tracewell.sources import sinks, stored

_TYPES = ("errors", "events", "logs", "javascript_errors")


def _faulty(backlog):
    """Envelopes as JSON, some without a proper id, data or timestamp."""
    k = F.col("seq") % 20
    envelope = sinks.envelope_json()
    return (
        F.when(k == 1, F.concat(F.lit('{"id":5,"data":'), "data", F.lit(',"timestamp":1}')))
        .when(k == 2, F.lit('{"id":"x","data":"text","timestamp":1}'))
        .when(k == 3, F.concat(F.lit('{"id":"x","data":'), "data", F.lit(',"timestamp":"1"}')))
        .otherwise(envelope)
    )


@query(
    "read_spool_files",
    f"""WITH {inputs.BACKLOG_SQL}, p AS (SELECT *, (row_number() OVER (PARTITION BY type ORDER BY seq) - 1) // 500 AS chunk FROM backlog)
        SELECT type, id, "timestamp", regexp_replace(data, '\\s', '', 'g') AS data, length(regexp_replace(data, '\\s', '', 'g')) AS bytes
        FROM p WHERE seq % 20 NOT IN (1, 2, 3) AND chunk % 3 <> 2""",
)
def read_spool_files(spark, folder):
    """Spool files of at most 500 envelopes; every third file is cut off, so it counts as empty."""
    path = _spool_files(spark, folder)
    return _all_types(lambda t: sources.read_spool(spark, f"{path}/type={t}", t))


def _spool_files(spark, folder):
    packed = batching.pack_batches(inputs.backlog(spark, folder), max_items=500)
    rows = packed.select("type", "batch_no", "batch_pos", _faulty(packed).alias("envelope"))
    files = rows.groupBy("type", "batch_no").agg(F.array_sort(F.collect_list(F.struct("batch_pos", "envelope"))).alias("e"))
    text = F.concat(F.lit("["), F.array_join(F.transform("e", lambda x: x["envelope"]), ","), F.lit("]"))
    cut = F.expr("batch_no div 500") % 3 == 2
    path = new_table_path(spark, "spool")
    files.select("type", F.when(cut, F.substr(text, F.lit(1), F.length(text) - 5)).otherwise(text).alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).partitionBy("type").text(path)
    return path


def _all_types(read):
    whole = read(_TYPES[0])
    for t in _TYPES[1:]:
        whole = whole.unionByName(read(t))
    return whole.select("type", "id", "timestamp", "data", "bytes")


@query("read_spool_blocks", ORACLES["read_spool_files"])
def read_spool_blocks(spark, folder):
    """The same files, each cut into blocks that are read by different tasks."""
    path = _spool_files(spark, folder)
    return _all_types(lambda t: sources.read_spool(spark, f"{path}/type={t}", t, split=True, block_bytes=20_000))


@query(
    "read_spool_lines",
    f"""WITH {inputs.BACKLOG_SQL} SELECT type, id, "timestamp", regexp_replace(data, '\\s', '', 'g') AS data FROM backlog""",
)
def read_spool_lines(spark, folder):
    path = new_table_path(spark, "spool-lines")
    sinks.write_spool_lines(inputs.backlog(spark, folder), path)
    parts = [sources.read_spool_lines(spark, f"{path}/type={t}", t) for t in _TYPES]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select("type", "id", "timestamp", "data")


@query(
    "read_items",
    f"""WITH {inputs.EVENTS_SQL} SELECT event_name, "timestamp", CAST(user_id AS VARCHAR) AS user_id, properties, url, session_id_hash FROM items""",
)
def read_items(spark, folder):
    """Event items as JSON lines, read with the schema of their type."""
    from tracewell.operators import budget

    shaped = shape.shape_events(inputs.raw_events(spark, folder), inputs.SALT, keep=("event_id",))
    path = new_table_path(spark, "items")
    budget.item_budget(shaped, "events", keep=("event_id",)).select("data").write.text(path)
    read = sources.read_items(spark, path, "events").where("_corrupt_record IS NULL")
    return read.select(
        "event_name", "timestamp", F.col("user.id").alias("user_id"), F.to_json("properties").alias("properties"), "url", "session_id_hash"
    )


@query(
    "read_batch_bodies",
    f"""WITH {inputs.BACKLOG_SQL}, p AS (SELECT *, (row_number() OVER (PARTITION BY type ORDER BY seq) - 1) AS place, place % 1000 AS batch_pos, place // 1000 * 1000 AS batch_no FROM backlog)
        SELECT type, type AS wrapper, batch_no, CAST(batch_pos AS INTEGER) AS batch_pos, seq AS n FROM p""",
)
def read_batch_bodies(spark, folder):
    """Bodies written per type and taken apart again, with the batch and position of every item."""
    path = new_table_path(spark, "bodies")
    sinks.write_batches(batching.packed_bodies(inputs.backlog(spark, folder)), path)
    read = sources.read_batch_bodies(spark, path)
    return read.select("type", "wrapper", "batch_no", "batch_pos", F.variant_get("item", "$.n", "bigint").alias("n"))


@query(
    "diagnostics",
    """WITH d AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS stamp, event_type, user_id, props FROM events)
       SELECT day, stamp, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'debug' ELSE 'warning' END AS level,
         'Saw ' || event_type || ': again' AS message, CASE WHEN user_id % 2 = 0 THEN replace(props, ' ', '') END AS context
       FROM d WHERE CAST(day AS DATE) >= DATE '2024-01-30' - 14""",
)
def diagnostics(spark, folder):
    """Lines written by day and read back; days out of retention are not read."""
    from tracewell.functions import text

    kind = F.col("event_type")
    e = inputs.load(spark, folder, "events").select(
        text.iso_timestamp(F.col("ts")).alias("at"),
        F.when(kind == "error", "error").when(kind == "view", "debug").otherwise("warning").alias("level"),
        F.concat(F.lit("Saw "), kind, F.lit(": again")).alias("message"),
        F.when(F.col("user_id") % 2 == 0, F.parse_json("props")).alias("context"),
    )
    path = new_table_path(spark, "diagnostics")
    sinks.write_diagnostics(e, path)
    lines = spark.read.text(path).withColumn("day", F.col("day").cast("string"))
    kept = sinks.prune_diagnostics(lines, F.lit("2024-01-30").cast("date"))
    parsed = sources.parse_diagnostics(kept)
    return parsed.select("day", F.col("at").alias("stamp"), "level", "message", F.to_json("context").alias("context"))


@query(
    "recent_diagnostics",
    """WITH d AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS stamp, event_type FROM events)
       SELECT day, stamp, 'notice' AS level, 'Saw ' || event_type || '\\nin two lines' AS message FROM d WHERE CAST(day AS DATE) >= DATE '2024-01-25'""",
)
def recent_diagnostics(spark, folder):
    """Messages of two lines written by day; the reader opens the folders of recent days only."""
    from tracewell.functions import text

    e = inputs.load(spark, folder, "events").select(
        text.iso_timestamp(F.col("ts")).alias("at"), F.lit("notice").alias("level"),
        F.concat(F.lit("Saw "), F.col("event_type"), F.lit("\nin two lines")).alias("message"), F.lit(None).cast("variant").alias("context"),
    )
    path = new_table_path(spark, "recent-diagnostics")
    sinks.write_diagnostics(e, path)
    read = sources.read_diagnostics(spark, path, since=F.lit("2024-01-25").cast("date"))
    return read.select(F.col("day").cast("string").alias("day"), F.col("at").alias("stamp"), "level", "message")


@query(
    "pruned_store",
    """WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type FROM events)
       SELECT day, count(*) AS lines FROM d WHERE CAST(day AS DATE) >= DATE '2024-01-30' - 7 GROUP BY day""",
)
def pruned_store(spark, folder):
    """Days out of retention are removed from the stored diagnostics, and the table is read whole."""
    from tracewell.functions import text

    e = inputs.load(spark, folder, "events").select(
        text.iso_timestamp(F.col("ts")).alias("at"), F.lit("notice").alias("level"), F.col("event_type").alias("message"),
        F.lit(None).cast("variant").alias("context"),
    )
    path = new_table_path(spark, "pruned")
    sinks.write_diagnostics(e, path)
    for _ in range(2):  # a repeat changes nothing
        stored.prune_stored_diagnostics(spark, path, "2024-01-30", 7)
    return spark.read.text(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "discarded_store",
    f"""WITH {inputs.BACKLOG_SQL} SELECT type, id, seq, md5(data) AS data_md5 FROM backlog
        WHERE type NOT IN ('logs') AND NOT (type = 'events' AND seq % 3 = 0)""",
)
def discarded_store(spark, folder):
    """The backlog of a type, and some records of another, are removed from a stored spool."""
    path = new_table_path(spark, "discarded")
    sinks.write_spool(inputs.backlog(spark, folder), path)
    for _ in range(2):
        stored.discard_stored_backlog(spark, path, "logs")
        stored.discard_where(spark, path, (F.col("type") == "events") & (F.col("seq") % 3 == 0))
    return sources.read_spool_table(spark, path).select("type", "id", "seq", F.md5("data").alias("data_md5"))


@query(
    "expired_store",
    f"""WITH {inputs.BACKLOG_SQL}, e AS (SELECT max("timestamp") - 7200 AS now FROM backlog), b AS (SELECT * FROM backlog, e WHERE "timestamp" <= now),
          s AS (SELECT type, id, "timestamp" AS t, "timestamp" - lag("timestamp") OVER (PARTITION BY type ORDER BY "timestamp") > 1800 AS gap FROM b),
          l AS (SELECT type, id, t, sum(CASE WHEN gap IS NULL OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY type ORDER BY t) AS life FROM s),
          x AS (SELECT type, life, max(t) AS last_t, max(life) OVER (PARTITION BY type) AS last_life FROM l GROUP BY type, life)
        SELECT l.type, id FROM l JOIN x ON l.type = x.type AND l.life = x.life
        WHERE x.life = x.last_life AND (SELECT now FROM e) - last_t <= 1800""",
)
def expired_store(spark, folder):
    """What has expired is removed from a stored spool, two hours before the last record of the table."""
    backlog, path = inputs.backlog(spark, folder), new_table_path(spark, "expired")
    now = backlog.agg(F.max("timestamp") - 7200).first()[0]
    sinks.write_spool(backlog.where(F.col("timestamp") <= now), path)
    for _ in range(2):
        stored.expire_stored_spool(spark, path, now, ttl=1800)
    return sources.read_spool_table(spark, path).select("type", "id")


@query(
    "quarantine",
    f"""WITH {inputs.REPORTS_SQL} SELECT kind, count(*) AS reports FROM reports
        WHERE kind IN (1, 3, 4, 5, 6) OR (page_url IS NULL AND kind = 11) GROUP BY kind""",
)
def quarantine(spark, folder):
    checked = validate.validate_browser_report(inputs.raw_reports(spark, folder))
    bad = checked.where(F.size("problems") > 0).select(
        (F.col("report_id") % 12).alias("kind"), "report_id", F.to_json("payload").alias("payload"), "problems"
    )
    path = new_table_path(spark, "quarantine")
    sinks.write_quarantine(bad, path, by=("kind",))
    return spark.read.parquet(path).groupBy(F.col("kind").cast("bigint").alias("kind")).agg(F.count(F.lit(1)).alias("reports"))
