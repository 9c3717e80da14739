"""Streams over the given tables, run until all input is read, their results written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import batching, sessions, spool
from tracewell.plans import inputs, q_sessions
from tracewell.plans.registry import ORACLES, query
from tracewell.session import new_table_path
from tracewell.sources import items as sources
from tracewell.sources import ledger
from tracewell.streaming import pipeline, stateful


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Everything the stream gives, from a table in the shared folder."""
    spark = stream.sparkSession
    path = new_table_path(spark, name)
    started = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", new_table_path(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_in_parts(rows: DataFrame, order: str, build, name: str, parts: int = 3) -> DataFrame:
    """What `build` makes of a stream that is stopped and started again from its checkpoint between parts of the input, so
    that state has to last; parts are thirds of the rows in `order`."""
    spark = rows.sparkSession
    source, out, checkpoint = (new_table_path(spark, f"{name}-{x}") for x in ("source", "out", "checkpoint"))
    ends = [float("-inf"), *rows.approxQuantile(order, [(i + 1) / parts for i in range(parts - 1)], 0.01), float("inf")]
    for low, high in zip(ends, ends[1:]):
        rows.where((F.col(order) > low) & (F.col(order) <= high)).write.mode("append").parquet(source)
        stream = build(spark.readStream.schema(rows.schema).parquet(source))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _events(spark, folder):
    return read_stream(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_dedupe", ORACLES["session_dedupe"])
def stream_dedupe(spark, folder):
    e = read_stream(spark, folder, "events")
    bucket = (F.get_json_object("props", "$.k").cast("bigint") % 10).cast("string")
    key = F.concat("event_type", F.lit("|"), bucket)
    slim = e.select("event_id", "user_id", key.alias("key"))
    sent = stateful.dedupe_reports_stream(slim, F.col("key"), "user_id", "event_id", idle=None)
    return run(sent, "stream-dedupe").select("event_id")


@query("stream_dedupe_restarted", ORACLES["session_dedupe_small_cache"])
def stream_dedupe_restarted(spark, folder):
    """The caches last while the stream is stopped and started again."""
    bucket = (F.get_json_object("props", "$.k").cast("bigint") % 10).cast("string")
    slim = inputs.load(spark, folder, "events").select("event_id", "user_id", F.concat("event_type", F.lit("|"), bucket).alias("key"))

    def sent(stream):
        return stateful.dedupe_reports_stream(stream, F.col("key"), "user_id", "event_id", cache=5, idle=None)

    return run_in_parts(slim, "event_id", sent, "stream-restarted").select("event_id")


@query("stream_trails", q_sessions._TRAIL)
def stream_trails(spark, folder):
    """The rings of crumbs last while the stream is stopped and started again."""
    e = inputs.load(spark, folder, "events").select(
        "event_id", "user_id", (F.col("event_type") == "error").alias("is_error"),
        F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")).alias("crumb"),
    )

    def trailed(stream):
        return stateful.breadcrumb_stream(stream, "user_id", "event_id", "is_error", "crumb", idle=None)

    return run_in_parts(e, "event_id", trailed, "stream-trails").select(
        "event_id", F.size("breadcrumbs").cast("bigint").alias("crumbs"), F.array_join("breadcrumbs", ">").alias("trail")
    )


@query(
    "stream_idle_lives",
    f"""WITH b AS (SELECT {inputs.TYPE_SQL} AS type, ts FROM events), top AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM events),
          s AS (SELECT type, ts, ts - lag(ts) OVER (PARTITION BY type ORDER BY ts) > INTERVAL '30 minutes' AS gap FROM b),
          l AS (SELECT type, ts, sum(CASE WHEN gap IS NULL OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY type ORDER BY ts) AS life FROM s),
          x AS (SELECT type, life, min(ts) AS f, max(ts) AS t, count(*) AS writes FROM l GROUP BY type, life)
        SELECT type, CAST(epoch_us(f) AS BIGINT) AS started_at, CAST(epoch_us(t) AS BIGINT) AS last_write_at, writes FROM x, top
        WHERE t + INTERVAL '30 minutes' <= mark""",
)
def stream_idle_lives(spark, folder):
    """Lives whose end the watermark has passed; the open ones come with later input."""
    writes = _events(spark, folder).select("ts", inputs.type_of_event(F.col("event_type")).alias("type"))
    lives = run(stateful.idle_lives_stream(writes, ttl="30 minutes"), "stream-lives")
    return lives.select(
        "type", F.unix_micros("started_at").alias("started_at"), F.unix_micros("last_write_at").alias("last_write_at"), "writes"
    )


@query(
    "stream_expired",
    f"""WITH {inputs.BACKLOG_SQL}, mark AS (SELECT max("timestamp") - 3600 AS w FROM backlog),
          s AS (SELECT type, id, "timestamp" AS t, "timestamp" - lag("timestamp") OVER (PARTITION BY type ORDER BY "timestamp") > 1800 AS gap FROM backlog),
          l AS (SELECT type, id, t, sum(CASE WHEN gap IS NULL OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY type ORDER BY t) AS life FROM s),
          x AS (SELECT *, max(t) OVER (PARTITION BY type, life) AS last_t FROM l)
        SELECT type, id FROM x, mark WHERE w - last_t > 1800""",
)
def stream_expired(spark, folder):
    """The records of the lives that timers have ended, an hour behind the newest record."""
    stream = inputs.events_as_backlog(read_stream(spark, folder, "events"))
    lives = run(stateful.expired_lives_stream(stream, ttl=1800), "stream-expired")
    return spool.expired_records(inputs.backlog(spark, folder), lives, ttl=1800).select("type", "id")


@query("stream_dedupe_continued", ORACLES["session_dedupe_small_cache"])
def stream_dedupe_continued(spark, folder):
    """Half of the reports as one batch; a stream goes on from the caches that the batch ended with."""
    bucket = (F.get_json_object("props", "$.k").cast("bigint") % 10).cast("string")
    slim = inputs.load(spark, folder, "events").select("event_id", "user_id", F.concat("event_type", F.lit("|"), bucket).alias("key"))
    half = slim.approxQuantile("event_id", [0.5], 0.01)[0]
    earlier, path = slim.where(F.col("event_id") <= half), new_table_path(spark, "continued")
    slim.where(F.col("event_id") > half).write.parquet(path)
    sent = sessions.dedupe_reports(earlier, F.col("key"), "user_id", "event_id", cache=5)
    caches = sessions.session_caches(earlier, F.col("key"), "user_id", "event_id", cache=5)
    stream = spark.readStream.schema(slim.schema).parquet(path)
    later = stateful.dedupe_reports_stream(stream, F.col("key"), "user_id", "event_id", cache=5, idle=None, caches=caches)
    return sent.select("event_id").unionByName(run(later, "stream-continued").select("event_id"))


@query("stream_trails_continued", q_sessions._TRAIL)
def stream_trails_continued(spark, folder):
    """The trails of half of the records as one batch; a stream goes on from the crumbs that the batch ended with."""
    e = inputs.load(spark, folder, "events").select(
        "event_id", "user_id", (F.col("event_type") == "error").alias("is_error"),
        F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")).alias("crumb"),
    )
    half = e.approxQuantile("event_id", [0.5], 0.01)[0]
    earlier, path = e.where(F.col("event_id") <= half), new_table_path(spark, "continued")
    e.where(F.col("event_id") > half).write.parquet(path)
    trails = sessions.breadcrumb_trail(earlier, F.col("is_error"), F.col("crumb"), "user_id", "event_id")
    crumbs = sessions.last_crumbs(earlier, F.col("is_error"), F.col("crumb"), "user_id", "event_id")
    stream = spark.readStream.schema(e.schema).parquet(path)
    later = run(stateful.breadcrumb_stream(stream, "user_id", "event_id", "is_error", "crumb", idle=None, crumbs=crumbs), "stream-continued")
    both = trails.select("event_id", "breadcrumbs").unionByName(later.select("event_id", "breadcrumbs"))
    return both.select("event_id", F.size("breadcrumbs").cast("bigint").alias("crumbs"), F.array_join("breadcrumbs", ">").alias("trail"))


@query(
    "stream_rates",
    """WITH m AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS minute, event_type, count(*) AS requests FROM events GROUP BY ALL)
       SELECT CAST(epoch(minute) AS BIGINT) AS minute, event_type, requests, requests > 1 AS over_limit FROM m
       WHERE minute + INTERVAL '1 minute' <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'""",
)
def stream_rates(spark, folder):
    """Closed minutes only."""
    flagged = stateful.rate_flags_stream(_events(spark, folder), keys=("event_type",), limit=1)
    return run(flagged, "stream-rates").select(F.unix_timestamp("minute").alias("minute"), "event_type", "requests", "over_limit")


@query(
    "stream_watermark_dedupe",
    """SELECT user_id, event_type, count(*) AS kept FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL""",
)
def stream_watermark_dedupe(spark, folder):
    """All input in one micro-batch: one report per session and key."""
    e = _events(spark, folder).select("user_id", "event_type", "ts")
    kept = run(stateful.dedupe_within_watermark(e, F.col("event_type"), "user_id", "ts"), "stream-watermark")
    return kept.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("kept"))


@query(
    "stream_event_items",
    f"""WITH {inputs.EVENTS_SQL} SELECT event_id, CAST(bytes AS BIGINT) AS bytes, md5(data) AS data_md5 FROM sized WHERE user_agent_hash <> ''""",
)
def stream_event_items(spark, folder):
    raw = inputs.events_as_raw(read_stream(spark, folder, "events"))
    items = run(pipeline.event_stream(raw, inputs.SALT), "stream-items")
    return items.select("event_id", "bytes", F.md5("data").alias("data_md5"))


@query("stream_delivery", ORACLES["batch_sizes"])
def stream_delivery(spark, folder):
    """A spool delivered through foreachBatch; a repeat of a micro-batch would replace its folder."""
    path = new_table_path(spark, "stream-bodies")
    backlog = inputs.events_as_backlog(read_stream(spark, folder, "events"))
    pipeline.deliver_stream(backlog, path, new_table_path(spark, "stream-delivery")).awaitTermination()
    bodies = spark.read.parquet(path)
    return bodies.select(
        "type", "batch_no", "items", "bytes", F.length("body").cast("bigint").alias("body_chars"), F.md5("body").alias("body_md5")
    )


@query(
    "stream_delivery_once",
    f"""WITH {inputs.BACKLOG_SQL} SELECT type AS wrapper, seq, md5(replace(data, ' ', '')) AS item_md5, TRUE AS within_limits FROM backlog""",
)
def stream_delivery_once(spark, folder):
    """A spool delivered to the ledger by a stream that is stopped and started; all of it is then put in again as one run,
    twice, which a reader sees once."""
    path, checkpoint, source = (new_table_path(spark, f"once-{x}") for x in ("out", "checkpoint", "source"))
    rows = inputs.backlog(spark, folder)
    for part in range(2):
        rows.where(F.col("seq") % 2 == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        pipeline.deliver_stream_once(stream, path, checkpoint, max_items=300).awaitTermination()
    schema = batching.partition_bodies(rows).schema
    streamed = ledger.read_once(spark, path, schema)
    again = new_table_path(spark, "once-again")
    for _ in range(2):
        ledger.write_once(streamed, again, "all")
    bodies = ledger.read_once(spark, again, schema)
    items = sources.body_items(bodies, F.col("body"), keep=("items",))
    number = F.try_variant_get("item", "$.n", "bigint").alias("seq")
    return items.select("wrapper", number, F.md5(F.to_json("item")).alias("item_md5"), (F.col("items") <= 300).alias("within_limits"))


@query(
    "stream_quarantine",
    """SELECT user_id % 7 = 0 AS rejected, count(*) AS records FROM events GROUP BY ALL""",
)
def stream_quarantine(spark, folder):
    from tracewell.operators import shape, validate

    raw = inputs.events_as_raw(read_stream(spark, folder, "events"))
    checked = validate.validate(shape.shape_events(raw, inputs.SALT, keep=("event_id",)), "events")
    slim = checked.select("event_id", "event_name", "violations")
    good, bad = new_table_path(spark, "good"), new_table_path(spark, "bad")
    pipeline.quarantine_stream(slim, good, bad, new_table_path(spark, "quarantine")).awaitTermination()
    both = spark.read.parquet(good).select(F.lit(False).alias("rejected")).unionByName(
        spark.read.parquet(bad).select(F.lit(True).alias("rejected"))
    )
    return both.groupBy("rejected").agg(F.count(F.lit(1)).alias("records"))
