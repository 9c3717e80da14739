"""Event items, their hashes and their visitors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions import text
from tracewell.functions.let import computed_once
from tracewell.operators import budget, sessions, shape
from tracewell.plans import inputs
from tracewell.plans.registry import query

_E = inputs.EVENTS_SQL


@query(
    "event_items",
    f"""WITH {_E} SELECT event_id, event_name, "timestamp", properties, CAST(user_id AS VARCHAR) AS user_id, url,
        user_agent_hash, session_id_hash, CAST(bytes AS BIGINT) AS bytes FROM sized""",
)
def event_items(spark, folder):
    shaped = computed_once(shape.shape_events(inputs.raw_events(spark, folder), inputs.SALT, keep=("event_id",)))
    return shaped.select(
        "event_id",
        "event_name",
        "timestamp",
        F.to_json("properties").alias("properties"),
        F.col("user.id").alias("user_id"),
        "url",
        "user_agent_hash",
        "session_id_hash",
        budget.item_bytes(shaped, "events").alias("bytes"),
    )


@query(
    "daily_visitors",
    f"""WITH {_E} SELECT strftime(ts, '%Y-%m-%d') AS day, session_id_hash, count(*) AS events,
        min("timestamp") AS first_at, max("timestamp") AS last_at FROM items GROUP BY ALL""",
)
def daily_visitors(spark, folder):
    hashed = shape.shape_visits(inputs.raw_events(spark, folder, ("ts", "request")), inputs.SALT, keep=("ts",))
    return sessions.daily_visitor_activity(hashed, F.date_format("ts", "yyyy-MM-dd"))


@query(
    "visit_hashes",
    f"""SELECT user_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE {inputs.hmac_sql("'s' || user_id")} END AS session_hash,
        count(*) AS events FROM events GROUP BY ALL""",
)
def visit_hashes(spark, folder):
    e = inputs.load(spark, folder, "events")
    raw = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.concat(F.lit("s"), F.col("user_id").cast("string")))
    counted = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return counted.select("user_id", inputs.salted_visit(raw).alias("session_hash"), "events")


@query(
    "event_names",
    """WITH names AS (
         SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type) WHEN 2 THEN 'ab'
           WHEN 3 THEN event_type || '_' || user_id WHEN 4 THEN repeat(event_type, 12) ELSE '9' || event_type END AS name
         FROM events)
       SELECT event_id, name, length(name) BETWEEN 3 AND 50 AND regexp_matches(name, '^[a-z][a-z0-9_]*$') AS valid
       FROM names""",
)
def event_names(spark, folder):
    kind, number = F.col("event_type"), F.col("event_id") % 6
    name = (
        F.when(number == 0, kind)
        .when(number == 1, F.upper(kind))
        .when(number == 2, F.lit("ab"))
        .when(number == 3, F.concat(kind, F.lit("_"), F.col("user_id").cast("string")))
        .when(number == 4, F.repeat(kind, F.lit(12)))
        .otherwise(F.concat(F.lit("9"), kind))
    )
    named = inputs.load(spark, folder, "events").select("event_id", name.alias("name"))
    return named.withColumn("valid", text.valid_event_name(F.col("name")))
