"""Filters of records: ignore lists, samples, levels, origins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions import url
from tracewell.operators import filters
from tracewell.plans import inputs
from tracewell.plans.registry import query


@query(
    "ignored_messages",
    """SELECT doc_id FROM documents WHERE NOT (contains(lower(text), 'thth') OR contains(lower(text), 'ändern'))
       AND NOT contains(lower(text), 'erst')""",
)
def ignored_messages(spark, folder):
    d = inputs.load(spark, folder, "documents", "doc_id")
    return filters.drop_ignored(d, "text", ("THTH", "Ändern", "", "Erst")).select("doc_id")


@query(
    "default_ignore_list",
    """SELECT event_id, event_type IN ('click', 'view') AS ignored FROM events""",
)
def default_ignore_list(spark, folder):
    e = inputs.load(spark, folder, "events")
    kind = F.col("event_type")
    message = (
        F.when(kind == "click", "Uncaught aborterror: stop")
        .when(kind == "view", "SCRIPT ERROR")
        .otherwise(F.concat(F.lit("Boom in "), kind))
    )
    return e.select("event_id", filters.ignored_flag(message).alias("ignored"))


@query(
    "sampled_reports",
    """SELECT event_id FROM events WHERE event_type = 'error'
       AND CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 <= 0.25""",
)
def sampled_reports(spark, folder):
    errors = inputs.load(spark, folder, "events").where("event_type = 'error'")
    return filters.sample_by_key(errors, "event_id", 0.25).select("event_id")


@query(
    "random_sample",
    """SELECT event_type, count(*) AS rows, count(*) AS all_kept, TRUE AS half_kept, 0 AS none_kept, TRUE AS of_the_table FROM events GROUP BY event_type""",
)
def random_sample(spark, folder):
    """What holds whatever the seed: a rate of one keeps all, a half keeps about half (within six standard deviations),
    nothing keeps nothing, and what is kept is in the table."""
    events = inputs.load(spark, folder, "events").select("event_id", "event_type")
    n = F.count(F.lit(1))
    rows = events.groupBy("event_type").agg(n.alias("rows"))
    whole = filters.sample(events, 1.0).groupBy("event_type").agg(n.alias("all_kept"))
    half = filters.sample(events, 0.5, seed=7)
    met = half.join(events.select("event_id"), "event_id", "left_semi").groupBy("event_type").agg(n.alias("_met"))
    halves = half.groupBy("event_type").agg(n.alias("_half"))
    none = filters.sample(events, -1.0, seed=7).groupBy("event_type").agg(n.alias("none_kept"))
    found = rows
    for part in (whole, halves, met, none):
        found = found.join(part, "event_type", "left")
    kept = F.coalesce("_half", F.lit(0))
    near = F.abs(kept - F.col("rows") / 2) <= 3 * F.sqrt("rows") + 1
    return found.select(
        "event_type", "rows", "all_kept", near.alias("half_kept"), F.coalesce("none_kept", F.lit(0)).alias("none_kept"),
        (kept == F.coalesce("_met", F.lit(0))).alias("of_the_table"),
    )


@query(
    "log_levels",
    """WITH l AS (SELECT conv_id, turn, CASE turn % 9 WHEN 0 THEN 'debug' WHEN 1 THEN 'info' WHEN 2 THEN 'Notice' WHEN 3 THEN 'warning'
           WHEN 4 THEN 'ERROR' WHEN 5 THEN 'critical' WHEN 6 THEN 'alert' WHEN 7 THEN 'emergency' ELSE 'trace' END AS level, role FROM conversations)
       SELECT conv_id, turn, level FROM l WHERE lower(level) IN ('warning', 'error', 'critical', 'alert', 'emergency') AND role <> 'user'""",
)
def log_levels(spark, folder):
    names = ["debug", "info", "Notice", "warning", "ERROR", "critical", "alert", "emergency", "trace"]
    level = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("turn") % 9 + 1).cast("int"))
    logs = inputs.load(spark, folder, "conversations").select("conv_id", "turn", "role", level.alias("level"))
    kept = filters.min_level(filters.exclude_channels(logs, ["user"], "role"), "warning")
    return kept.select("conv_id", "turn", "level")


@query(
    "own_and_fatal_errors",
    """WITH e AS (SELECT doc_id, '/srv/' || (CASE WHEN source IN ('src1', 'src2') THEN 'lib/' ELSE 'app/' END) || source AS file,
           [1, 2, 4, 8, 16, 32, 64, 256][CAST(doc_id % 8 AS INTEGER) + 1] AS severity FROM documents)
       SELECT doc_id, file, severity FROM e WHERE NOT starts_with(file, '/srv/lib/') AND severity IN (1, 4, 16, 64)""",
)
def own_and_fatal_errors(spark, folder):
    severities = F.array(*[F.lit(s) for s in (1, 2, 4, 8, 16, 32, 64, 256)])
    place = F.when(F.col("source").isin("src1", "src2"), "lib/").otherwise("app/")
    errors = inputs.load(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lit("/srv/"), place, "source").alias("file"),
        F.element_at(severities, (F.col("doc_id") % 8 + 1).cast("int")).alias("severity"),
    )
    return filters.only_fatal(filters.drop_self_errors(errors, "/srv/lib/"))


@query(
    "origins",
    """WITH p AS (SELECT page_id, regexp_extract(url, '^(https?)', 1) AS scheme, regexp_extract(url, '^https?://([^/]+)', 1) AS host, page_id % 7 AS k FROM pages)
       SELECT page_id, CASE k WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN FALSE
           WHEN 3 THEN FALSE WHEN 4 THEN scheme = 'https' WHEN 5 THEN TRUE ELSE FALSE END AS allowed FROM p""",
)
def origins(spark, folder):
    """0 none, 1 own host, 2 a foreign host, 3 no origin at all, 4 a listed origin (its scheme
    counts), 5 a listed authority, 6 a listed authority on another port."""
    host, scheme = F.regexp_extract("url", r"^https?://([^/]+)", 1), F.regexp_extract("url", r"^(https?)", 1)
    k = F.col("page_id") % 7
    origin = (
        F.when(k == 1, F.concat(scheme, F.lit("://"), F.upper(host), F.when(scheme == "https", ":443").otherwise(":80")))
        .when(k == 2, F.concat(F.lit("https://"), host, F.lit(".evil.test")))
        .when(k == 3, F.concat(F.lit("//"), host))
        .when(k == 4, F.concat(scheme, F.lit("://listed.example.com")))
        .when(k == 5, F.concat(scheme, F.lit("://plain.example.com:8443/some/page")))
        .when(k == 6, F.concat(scheme, F.lit("://plain.example.com:9443")))
    )
    request = F.map_filter(
        F.create_map(
            F.lit("HTTP_HOST"), F.concat(host, F.when(F.col("page_id") % 2 == 0, ":443").otherwise("")),
            F.lit("HTTP_ORIGIN"), F.when(k < 5, origin),
            F.lit("HTTP_REFERER"), F.when(k >= 5, origin),
        ),
        lambda _, v: v.isNotNull(),
    )
    listed = ("https://Listed.example.com:443", "plain.example.com:8443", "")
    pages = inputs.load(spark, folder, "pages").select("page_id", request.alias("request"))
    return pages.select("page_id", url.origin_allowed(F.col("request"), listed).alias("allowed"))


@query("same_origin_reports", """SELECT page_id FROM pages WHERE page_id % 3 <> 0""")
def same_origin_reports(spark, folder):
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    origin = F.when(F.col("page_id") % 3 == 0, "https://elsewhere.test").otherwise(F.concat(F.lit("https://"), host))
    request = F.create_map(F.lit("HTTP_HOST"), host, F.lit("HTTP_ORIGIN"), origin)
    pages = inputs.load(spark, folder, "pages").select("page_id", request.alias("request"))
    return filters.same_origin(pages).select("page_id")


@query(
    "known_types",
    """SELECT type, count(*) AS records FROM (SELECT CASE event_type WHEN 'error' THEN 'errors' WHEN 'view' THEN 'page_visits'
         WHEN 'click' THEN 'events' ELSE 'logs' END AS type FROM events) WHERE type <> 'page_visits' GROUP BY type""",
)
def known_types(spark, folder):
    kind = F.col("event_type")
    typed = inputs.load(spark, folder, "events").select(
        F.when(kind == "error", "errors").when(kind == "view", "page_visits").when(kind == "click", "events").otherwise("logs").alias("type")
    )
    return filters.known_type(typed).groupBy("type").agg(F.count(F.lit(1)).alias("records"))
