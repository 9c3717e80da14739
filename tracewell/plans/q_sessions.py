"""Duplicate reports and breadcrumb trails."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.operators import filters, sessions
from tracewell.plans import inputs
from tracewell.session import new_table_path
from tracewell.plans.registry import query


@query(
    "session_dedupe",
    """SELECT event_id FROM events QUALIFY row_number() OVER (
         PARTITION BY user_id, event_type || '|' || (CAST(replace(replace(props, '{"k": ', ''), '}', '') AS BIGINT) % 10) ORDER BY event_id) = 1""",
)
def session_dedupe(spark, folder):
    """At most fifty distinct keys per session, so no key ever leaves a cache."""
    e = inputs.load(spark, folder, "events")
    bucket = (F.get_json_object("props", "$.k").cast("bigint") % 10).cast("string")
    key = F.concat("event_type", F.lit("|"), bucket)
    return sessions.dedupe_reports(e, key, session="user_id", order="event_id").select("event_id")


@query(
    "session_dedupe_small_cache",
    """WITH RECURSIVE k AS (SELECT event_id, user_id, event_type || '|' || (CAST(replace(replace(props, '{"k": ', ''), '}', '') AS BIGINT) % 10) AS key,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
         walk AS (SELECT event_id, user_id, n, TRUE AS sent, [key] AS held FROM k WHERE n = 1
           UNION ALL SELECT k.event_id, k.user_id, k.n, NOT list_contains(held, key),
             CASE WHEN list_contains(held, key) THEN held ELSE list_append(held, key)[-5:] END
           FROM walk JOIN k ON k.user_id = walk.user_id AND k.n = walk.n + 1)
       SELECT event_id FROM walk WHERE sent""",
)
def session_dedupe_small_cache(spark, folder):
    """A cache of five, which sessions outgrow: keys leave it and are sent again."""
    e = inputs.load(spark, folder, "events")
    bucket = (F.get_json_object("props", "$.k").cast("bigint") % 10).cast("string")
    key = F.concat("event_type", F.lit("|"), bucket)
    kept = sessions.dedupe_reports(e, key, session="user_id", order="event_id", cache=5, segment=40)
    return kept.select("event_id")


_TRAIL = """SELECT event_id, len(trail) AS crumbs, array_to_string(trail, '>') AS trail FROM (
  SELECT event_id, event_type, list_slice(coalesce(list(event_type || ':' || event_id) FILTER (event_type <> 'error') OVER
    (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []), -20, -1) AS trail FROM events)
WHERE event_type = 'error'"""


@query("error_trails", _TRAIL)
def error_trails(spark, folder):
    e = inputs.load(spark, folder, "events")
    crumb = F.concat("event_type", F.lit(":"), F.col("event_id").cast("string"))
    trails = sessions.breadcrumb_trail(e, F.col("event_type") == "error", crumb, session="user_id", order="event_id")
    return trails.select(
        "event_id",
        F.size("breadcrumbs").cast("bigint").alias("crumbs"),
        F.array_join("breadcrumbs", ">").alias("trail"),
    )


@query(
    "unique_reports",
    """SELECT event_id FROM events WHERE event_type <> 'click' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
)
def unique_reports(spark, folder):
    """The browser's own order: the ignore list first, then duplicates by message, file and place."""
    from tracewell.plans import flows

    kind = F.col("event_type")
    e = inputs.load(spark, folder, "events").select(
        "event_id",
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("session_id"),
        F.when(kind == "click", "Load failed").otherwise(F.concat(F.lit("Boom "), kind)).alias("message"),
        F.lit("app.js").alias("filename"),
        F.lit(1).alias("line"),
        F.lit(2).alias("column"),
    )
    return flows.unique_reports(e).select("event_id")


@query(
    "approximate_visitors",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, TRUE AS close FROM events GROUP BY day""",
)
def approximate_visitors(spark, folder):
    """Approximate visitors per day lie within a tenth of the exact number."""
    e = inputs.load(spark, folder, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    rough = sessions.daily_visitor_activity(e, day, visitor="user_id", at="ts", approximate=True)
    exact = e.groupBy(day.alias("day")).agg(F.count_distinct("user_id").alias("n"))
    close = F.abs(F.col("visitors") - F.col("n")) <= F.greatest(F.col("n") * 0.1, F.lit(2))
    return rough.join(exact, "day").select("day", close.alias("close"))


@query(
    "visitors_by_range",
    """SELECT strftime(ts, '%Y-%m') AS month, count(*) AS events, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS days, TRUE AS close
       FROM events GROUP BY month""",
)
def visitors_by_range(spark, folder):
    """Visitors of each month from stored sketches of its days, against the exact number."""
    e = inputs.load(spark, folder, "events")
    path = new_table_path(spark, "visitor-sketches")
    sessions.daily_visitor_sketches(e, F.date_format("ts", "yyyy-MM-dd"), visitor="user_id").write.partitionBy("day").parquet(path)
    stored = spark.read.schema("sketch binary, events bigint, day string").parquet(path)
    month = F.substring("day", 1, 7).alias("month")
    rough = sessions.visitors_over(stored, month)
    exact = e.groupBy(F.date_format("ts", "yyyy-MM").alias("month")).agg(F.count_distinct("user_id").alias("n"))
    close = F.abs(F.col("visitors") - F.col("n")) <= F.greatest(F.col("n") * 0.08, F.lit(2))
    return rough.join(exact, "month").select("month", "events", "days", close.alias("close"))


@query("passing_levels", """SELECT count(*) AS n FROM conversations WHERE turn % 2 = 0""")
def passing_levels(spark, folder):
    logs = inputs.load(spark, folder, "conversations").select(
        F.when(F.col("turn") % 2 == 0, "emergency").otherwise("info").alias("level")
    )
    return filters.min_level(logs).agg(F.count(F.lit(1)).alias("n"))
