"""The flows end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.operators import batching, spool, validate
from tracewell.plans import flows, inputs
from tracewell.plans.registry import query
from tracewell.session import new_table_path
from tracewell.sources import items as sources
from tracewell.sources import sinks

_E, _R = inputs.EVENTS_SQL, inputs.REPORTS_SQL


@query(
    "flush_events",
    f"""WITH {_E}, newest AS (SELECT * FROM sized WHERE user_agent_hash <> '' QUALIFY row_number() OVER (ORDER BY event_id DESC) <= 5000),
          placed AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS chunk FROM newest)
        SELECT 'events' AS type, chunk * 1000 AS batch_no, count(*) AS items, CAST(sum(bytes) AS BIGINT) AS bytes,
          md5(string_agg(md5(data), '' ORDER BY event_id)) AS digest
        FROM placed GROUP BY chunk""",
)
def flush_events(spark, folder):
    """Events shaped, redacted, hashed, validated and held to their budget; the newest of them
    spooled and packed."""
    path = new_table_path(spark, "event-spool")
    sinks.write_spool(flows.event_spool(inputs.raw_events(spark, folder), inputs.SALT), path)
    packed = flows.flush(sources.read_spool_table(spark, path))
    return packed.groupBy("type", "batch_no").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("bytes").alias("bytes"),
        F.md5(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("batch_pos", F.md5("data").alias("d")))), lambda x: x["d"]), ""
            )
        ).alias("digest"),
    )


@query(
    "event_backlog",
    f"""WITH {_E} SELECT 'events' AS type, CAST(event_id AS VARCHAR) AS id, event_id AS seq, secs AS "timestamp", CAST(bytes AS BIGINT) AS bytes, md5(data) AS data_md5
        FROM sized WHERE user_agent_hash <> ''""",
)
def event_backlog(spark, folder):
    backlog = flows.event_spool(inputs.raw_events(spark, folder), inputs.SALT)
    return backlog.select("type", "id", "seq", "timestamp", "bytes", F.md5("data").alias("data_md5"))


@query(
    "js_report_flow",
    f"""WITH {_R} SELECT report_id, 'ok' AS budget_status, least(crumbs, 20) AS breadcrumbs FROM judged WHERE disposition = 'received'""",
)
def js_report_flow(spark, folder):
    """Browser reports through every rule to budgeted items."""
    items = flows.js_error_items(inputs.raw_reports(spark, folder), inputs.SALT, allowed=inputs.ALLOWED_ORIGINS)
    crumbs = F.variant_get(F.parse_json("data"), "$.breadcrumbs", "array<variant>")
    return items.select("report_id", "budget_status", F.size(crumbs).cast("bigint").alias("breadcrumbs"))


@query(
    "rejected_reports",
    f"""WITH {_R} SELECT report_id, kind FROM judged WHERE disposition = 'invalid'""",
)
def rejected_reports(spark, folder):
    rejected = flows.rejected_reports(inputs.raw_reports(spark, folder), inputs.ALLOWED_ORIGINS)
    return rejected.where(F.size("problems") > 0).select("report_id", (F.col("report_id") % 12).alias("kind"))


@query(
    "run_batches",
    f"""WITH {inputs.BACKLOG_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY seq) AS n FROM backlog QUALIFY n <= 1000),
          r AS (SELECT *, sum(bytes) OVER (PARTITION BY type ORDER BY seq) AS running FROM t)
        SELECT type, n = 1 OR running <= 20000 AS kept, count(*) AS items, CAST(sum(bytes) AS BIGINT) AS bytes FROM r GROUP BY ALL""",
)
def run_batches(spark, folder):
    """One run: the oldest thousand of each type, trimmed to a byte limit (a low one)."""
    taken = spool.take_fifo(inputs.backlog(spark, folder))
    trimmed = batching.trim_to_bytes(taken, 20_000)
    return trimmed.groupBy("type", "kept").agg(F.count(F.lit(1)).alias("items"), F.sum("bytes").alias("bytes"))


@query(
    "filled_report_urls",
    f"""WITH {_R} SELECT report_id, CASE WHEN page_url IS NOT NULL THEN page_url WHEN kind <> 11 THEN 'https://shop.example.com/from?token=1' END AS url FROM reports""",
)
def filled_report_urls(spark, folder):
    filled = validate.fill_report_url(inputs.raw_reports(spark, folder))
    return filled.select("report_id", F.variant_get("payload", "$.url", "string").alias("url"))
