"""Error, log and browser error items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions import text, url
from tracewell.functions.let import computed_once
from tracewell.operators import budget, filters, shape, validate
from tracewell.plans import inputs
from tracewell.plans.q_redaction import _TEXT_RE2
from tracewell.plans.registry import query

_REDACT = f"regexp_replace(text, '{_TEXT_RE2}', '\\1\\2[REDACTED]', 'g')"


@query(
    "error_items",
    f"""SELECT doc_id, 'Failed with password=[REDACTED] for ' || source AS message,
         'src/' || source || '/' || lang || '.php' AS file, doc_id % 40 + 1 AS line,
         md5(CASE WHEN length({_REDACT}) > 5000 THEN substr({_REDACT}, 1, 4985) || '... (truncated)' ELSE {_REDACT} END) AS trace_md5,
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE
           'http-host=' || (CASE WHEN doc_id % 4 = 0 THEN '' ELSE source || '.example.com' END) END AS host_header,
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'https://a.example.com/x?token=[REDACTED]&q=1' END AS referer,
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'accept,content-type,cookie,host,referer,x-forwarded-for' END AS header_names,
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'cookie,x-forwarded-for' END AS masked,
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE
           (CASE WHEN doc_id % 4 = 0 THEN '' ELSE (CASE WHEN doc_id % 3 = 1 THEN 'https' ELSE 'http' END) || '://' || source || '.example.com' END)
           || '/' || lang || '/' || doc_id || '?api_key=[REDACTED]&page=2' END AS url,
         CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method,
         doc_id % 5 = 0 AS is_console,
         CASE WHEN doc_id % 5 = 0 THEN 'bin/run ' || lang || ' --token=[REDACTED]' END AS console_command,
         CASE WHEN doc_id % 5 = 0 THEN 'bin/run|' || lang || '|--token=[REDACTED]' END AS console_arguments
       FROM documents""",
)
def error_items(spark, folder):
    shaped = computed_once(
        shape.shape_errors(inputs.raw_errors(spark, folder), keep=("doc_id",), project_root="/srv/app")
    )
    headers = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["name"], h["values"][0])))
    masked = F.filter(F.map_keys(headers), lambda k: headers[k] == C.MASKED)
    return shaped.select(
        "doc_id",
        "message",
        "file",
        "line",
        F.md5("trace").alias("trace_md5"),
        F.concat(F.lit("http-host="), headers["host"]).alias("host_header"),
        headers["referer"].alias("referer"),
        F.array_join(F.array_sort(F.map_keys(headers)), ",").alias("header_names"),
        F.array_join(F.array_sort(masked), ",").alias("masked"),
        "url",
        "method",
        "is_console",
        "console_command",
        F.array_join("console_arguments", "|").alias("console_arguments"),
    )


@query(
    "bounded_paths",
    """WITH p AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '/srv/app' ELSE '/opt' END || '//' ||
           repeat(source || '/', CAST(doc_id % 150 AS INTEGER)) || 'x.php' AS path FROM documents),
         r AS (SELECT doc_id, CASE WHEN starts_with(path, '/srv/app') THEN ltrim(substr(path, 9), '/\\') ELSE path END AS path FROM p)
       SELECT doc_id, CASE WHEN length(path) > 500 THEN right(path, 500) ELSE path END AS file FROM r""",
)
def bounded_paths(spark, folder):
    d = inputs.load(spark, folder, "documents")
    root = F.when(F.col("doc_id") % 2 == 0, "/srv/app").otherwise("/opt")
    path = F.concat(
        root, F.lit("//"), F.repeat(F.concat("source", F.lit("/")), (F.col("doc_id") % 150).cast("int")), F.lit("x.php")
    )
    return d.select("doc_id", text.bound_file_path(path, "/srv/app").alias("file"))


@query(
    "request_urls",
    """WITH c AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
           regexp_extract(url, '^https?://[^/]+(.*)$', 1) AS uri, page_id % 5 AS k FROM pages)
       SELECT page_id,
         CASE WHEN k = 4 THEN uri ELSE (CASE WHEN k = 1 THEN 'https' ELSE 'http' END) || '://' ||
           (CASE WHEN k = 3 THEN 'server.example.com' ELSE host END) || uri END AS error_url,
         (CASE WHEN k = 1 THEN 'https' WHEN k = 2 THEN 'wss' WHEN k = 0 THEN 'https' ELSE 'http' END) || '://' ||
           (CASE WHEN k >= 3 THEN 'server.example.com' ELSE host END) || uri AS event_url
       FROM c""",
)
def request_urls(spark, folder):
    """The two URL rules on one set of contexts: they differ on empty hosts and on schemes."""
    host, uri, k = F.regexp_extract("url", r"^https?://([^/]+)", 1), F.regexp_extract("url", r"^https?://[^/]+(.*)$", 1), F.col("page_id") % 5
    request = F.map_filter(
        F.create_map(
            F.lit("HTTP_HOST"), F.when(k == 3, F.lit(None)).when(k == 4, "").otherwise(host),
            F.lit("SERVER_NAME"), F.lit("server.example.com"),
            F.lit("REQUEST_URI"), uri,
            F.lit("HTTPS"), F.when(k == 1, "1").when(k == 3, "Off").otherwise(""),
            F.lit("REQUEST_SCHEME"), F.when(k == 2, "WSS").otherwise(""),
            F.lit("SERVER_PORT"), F.when(k == 0, "443").otherwise("8080"),
        ),
        lambda _, v: v.isNotNull(),
    )
    pages = inputs.load(spark, folder, "pages").select("page_id", request.alias("request"))
    return pages.select(
        "page_id",
        url.error_request_url(F.col("request")).alias("error_url"),
        url.event_request_url(F.col("request")).alias("event_url"),
    )


@query(
    "source_previews",
    """WITH f AS (SELECT doc_id, string_split(text, chr(10)) AS lines, text, 1 + doc_id % 60 AS line FROM documents
           WHERE strlen(text) < 1048576),
         w AS (SELECT doc_id, line, greatest(0, line - 6) AS start, lines,
             len(lines) - CASE WHEN text LIKE '%' || chr(10) OR text = '' THEN 1 ELSE 0 END AS total FROM f),
         c AS (SELECT *, least(total, start + 11) AS stop,
             list_transform(lines[start + 1 : least(total, start + 11)], lambda s: regexp_replace(
               CASE WHEN length(s) > 2000 THEN substr(s, 1, 2000) || '... (truncated)' ELSE s END, '\\s+$', '')) AS win FROM w),
         i AS (SELECT *, coalesce(list_min(list_transform(list_filter(win, lambda s: s <> ''),
             lambda s: length(s) - length(ltrim(s, ' ' || chr(9))))), 0) AS indent FROM c)
       SELECT doc_id, line, md5(CASE WHEN stop > start THEN
           array_to_string(list_transform(win, lambda s: substr(s, CAST(indent AS INTEGER) + 1)), chr(10)) ||
           CASE WHEN stop < len(lines) THEN chr(10) ELSE '' END ELSE '' END) AS context_md5, line - start AS highlight_line
       FROM i""",
)
def source_previews(spark, folder):
    d = inputs.load(spark, folder, "documents", "doc_id")
    path = F.concat(F.lit("src/"), F.col("doc_id").cast("string"))
    errors = d.select("doc_id", path.alias("file"), (F.col("doc_id") % 60 + 1).alias("line"))
    files = inputs.load(spark, folder, "documents", "doc_id").select(path.alias("path"), "text")
    seen = shape.source_preview(errors, files)
    return seen.select("doc_id", "line", F.md5("context").alias("context_md5"), "highlight_line")


@query(
    "shared_previews",
    """WITH f AS (SELECT doc_id, string_split(text, chr(10)) AS lines, text FROM documents WHERE doc_id < 40 AND strlen(text) < 1048576),
         e AS (SELECT event_id, event_id % 60 AS file_no, CASE WHEN event_id % 17 = 0 THEN 99000000 ELSE event_id % 7 + 1 END AS line FROM events),
         w AS (SELECT event_id, line, doc_id, greatest(0, line - 6) AS start, lines,
             len(lines) - CASE WHEN text LIKE '%' || chr(10) OR text = '' THEN 1 ELSE 0 END AS total FROM e LEFT JOIN f ON doc_id = file_no),
         c AS (SELECT *, least(total, start + 11) AS stop,
             list_transform(lines[start + 1 : least(total, start + 11)], lambda s: regexp_replace(
               CASE WHEN length(s) > 2000 THEN substr(s, 1, 2000) || '... (truncated)' ELSE s END, '\\s+$', '')) AS win FROM w),
         i AS (SELECT *, coalesce(list_min(list_transform(list_filter(win, lambda s: s <> ''),
             lambda s: length(s) - length(ltrim(s, ' ' || chr(9))))), 0) AS indent FROM c)
       SELECT event_id, md5(CASE WHEN doc_id IS NULL THEN NULL WHEN stop > start THEN
           array_to_string(list_transform(win, lambda s: substr(s, CAST(indent AS INTEGER) + 1)), chr(10)) ||
           CASE WHEN stop < len(lines) THEN chr(10) ELSE '' END ELSE '' END) AS context_md5,
         CASE WHEN doc_id IS NOT NULL THEN line - start END AS highlight_line
       FROM i""",
)
def shared_previews(spark, folder):
    """Many errors in a few files, some at lines no file has, some in files that are missing."""
    at = F.col("event_id")
    errors = inputs.load(spark, folder, "events").select(
        at.alias("event_id"),
        F.concat(F.lit("src/"), (at % 60).cast("string")).alias("file"),
        F.when(at % 17 == 0, F.lit(99_000_000)).otherwise(at % 7 + 1).alias("line"),
    )
    d = inputs.load(spark, folder, "documents")
    files = d.select(F.concat(F.lit("src/"), F.col("doc_id").cast("string")).alias("path"), "text", "doc_id").where("doc_id < 40")
    seen = shape.source_preview(errors, files)
    return seen.select("event_id", F.md5("context").alias("context_md5"), "highlight_line")


@query(
    "referer_secrets",
    """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN 'https://a.example.com/[REDACTED]?token=[REDACTED]&q=1' END AS referer,
         'Failed with password=[REDACTED] for s###' AS message_start FROM documents""",
)
def referer_secrets(spark, folder):
    """Secrets of the referring page's path, and a caller's own rule over free text."""
    own = lambda text: F.regexp_replace(text, r"src\d+$", "s###")
    shaped = shape.shape_errors(inputs.raw_errors(spark, folder), keep=("doc_id",), referer_secrets=F.array(F.lit("x")), redactor=own)
    named = F.filter("headers", lambda h: F.lower(h["name"]) == "referer")
    return shaped.select("doc_id", F.get(F.get(named, F.lit(0))["values"], F.lit(0)).alias("referer"), F.col("message").alias("message_start"))


@query(
    "framework_pairs",
    """WITH r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN '11.' || c_custkey END AS legacy,
           CASE WHEN c_custkey % 3 = 0 THEN 'symfony' END AS f, CASE WHEN c_custkey % 3 = 0 THEN '7.1' END AS v FROM customer)
       SELECT id, CASE WHEN legacy IS NOT NULL AND f IS NULL THEN 'laravel' ELSE f END AS framework,
         CASE WHEN legacy IS NOT NULL AND f IS NULL THEN legacy ELSE v END AS framework_version FROM r""",
)
def framework_pairs(spark, folder):
    key = F.col("c_custkey")
    rows = inputs.load(spark, folder, "customer").select(
        key.alias("id"),
        F.when(key % 2 == 0, F.concat(F.lit("11."), key.cast("string"))).alias("laravel_version"),
        F.when(key % 3 == 0, "symfony").alias("framework"),
        F.when(key % 3 == 0, "7.1").alias("framework_version"),
    )
    return shape.normalize_framework(rows)


def raw_logs(spark, folder):
    """conversations as log records: the role is the channel, the turn gives the level."""
    c = inputs.load(spark, folder, "conversations", "conv_id")
    turn = F.col("turn")
    level = (
        F.when(turn % 4 == 0, "NOTICE").when(turn % 4 == 1, "debug").when(turn % 4 == 2, "Error").otherwise("verbose")
    )
    context = F.to_variant_object(
        F.struct(F.concat(F.lit("k"), F.col("conv_id").cast("string")).alias("api_key"), turn.alias("attempt"))
    )
    extra = F.to_variant_object(F.struct(F.lit("mine").alias("environment"), F.col("text").alias("note")))
    return c.select(
        "conv_id",
        "turn",
        level.alias("level"),
        F.concat(F.lit("Retry with api_key=k1 after "), "text").alias("message"),
        context.alias("context"),
        F.col("role").alias("channel"),
        F.timestamp_seconds(F.lit(inputs.DATA_EPOCH) + F.col("conv_id")).alias("ts"),
        extra.alias("extra"),
    )


_LOG_RE2 = f"regexp_replace('Retry with api_key=k1 after ' || text, '{_TEXT_RE2}', '\\1\\2[REDACTED]', 'g')"
_EXTRA_BYTES = inputs.json_bytes_sql("'{\"environment\":\"mine\",\"note\":' || CAST(to_json(text) AS VARCHAR) || '}'")


@query(
    "log_items",
    f"""SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'notice' ELSE 'error' END AS level, role AS channel,
         md5({_LOG_RE2}) AS message_md5, '{{"api_key":"[REDACTED]","attempt":' || turn || '}}' AS context,
         CASE WHEN {_EXTRA_BYTES} > 10240 THEN '_truncated,environment,framework,php_version'
              ELSE 'environment,framework,note,php_version' END AS extra_keys,
         'staging' AS environment, strftime(make_timestamp((1704067200 + conv_id) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp"
       FROM conversations WHERE turn % 4 IN (0, 2) AND role <> 'system'""",
)
def log_items(spark, folder):
    kept = filters.exclude_channels(filters.min_level(raw_logs(spark, folder)), ["system"])
    shaped = computed_once(
        shape.shape_logs(
            kept, keep=("conv_id", "turn"), environment="staging", runtime_version="8.4.1", framework="symfony"
        )
    )
    keys = F.array_sort(F.map_keys(F.col("extra").try_cast("map<string,variant>")))
    return shaped.select(
        "conv_id",
        "turn",
        "level",
        "channel",
        F.md5("message").alias("message_md5"),
        F.to_json("context").alias("context"),
        F.array_join(keys, ",").alias("extra_keys"),
        F.variant_get("extra", "$.environment", "string").alias("environment"),
        "timestamp",
    )


@query(
    "js_error_items",
    f"""WITH {inputs.REPORTS_SQL}
       SELECT report_id, 'Boom {{token: [REDACTED] at step ' || (report_id % 5) AS message,
         'at app.js api_key=[REDACTED]' AS stack, CASE WHEN kind = 7 THEN 'TypeError' ELSE 'Error' END AS type,
         report_id % 300 AS line, 7 AS "column",
         coalesce(page_url, 'https://shop.example.com/from?token=[REDACTED]') AS url,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp",
         CASE WHEN user_id % 4 = 0 THEN NULL ELSE {inputs.hmac_sql("'s' || user_id")} END AS session_id,
         least(crumbs, 20) AS breadcrumbs, 'Page loaded ' || greatest(crumbs - 19, 1) AS first_crumb,
         CASE WHEN page_url IS NULL THEN '{{"authorization":"[REDACTED]"}}'
              ELSE '{{"authorization":"[REDACTED]","url":"' || page_url || '"}}' END AS last_data,
         '{{"password":"[REDACTED]","step":' || (report_id % 9) || '}}' AS context,
         '{{"connection_type":"4g","device_memory":null,"hardware_concurrency":null,"screen_height":"1080","screen_width":1920,"viewport_height":null,"viewport_width":null}}' AS browser_info
       FROM judged WHERE disposition = 'received'""",
)
def js_error_items(spark, folder):
    raw = inputs.raw_reports(spark, folder)
    judged = validate.classify_reports(raw, inputs.ALLOWED_ORIGINS).where("disposition = 'received'")
    shaped = computed_once(
        shape.shape_js_errors(validate.fill_report_url(judged), inputs.SALT, keep=("report_id",))
    )
    crumbs = F.col("breadcrumbs")
    return shaped.select(
        "report_id", "message", "stack", "type", "line", "column", "url", "timestamp", "session_id",
        F.size(crumbs).alias("breadcrumbs"),
        crumbs[0]["message"].alias("first_crumb"),
        F.to_json(F.element_at(crumbs, -1)["data"]).alias("last_data"),
        F.to_json("context").alias("context"),
        F.to_json("browser_info").alias("browser_info"),
    )


@query(
    "browser_signals",
    """WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'rejection' WHEN 2 THEN 'console' ELSE 'manual' END AS source,
           CASE event_id % 3 WHEN 0 THEN 'error' WHEN 1 THEN 'string' ELSE 'none' END AS reason_kind,
           CASE WHEN user_id % 2 = 0 THEN '' ELSE 'went wrong ' || user_id END AS message,
           CASE WHEN user_id % 3 = 0 THEN 'RangeError' ELSE '' END AS type FROM events)
       SELECT event_id, source,
         CASE source WHEN 'error' THEN coalesce(nullif(message, ''), 'Unknown error')
           WHEN 'rejection' THEN CASE reason_kind WHEN 'string' THEN message
             WHEN 'error' THEN coalesce(nullif(message, ''), 'Unhandled Promise Rejection') ELSE 'Unhandled Promise Rejection' END
           WHEN 'console' THEN 'Console Error: ' || message ELSE message END AS message,
         CASE source WHEN 'error' THEN coalesce(nullif(type, ''), 'Error')
           WHEN 'rejection' THEN CASE WHEN reason_kind = 'error' THEN coalesce(nullif(type, ''), 'UnhandledRejection') ELSE 'UnhandledRejection' END
           WHEN 'console' THEN 'ConsoleError' ELSE coalesce(nullif(type, ''), 'ManualError') END AS type,
         CASE WHEN source = 'rejection' AND reason_kind <> 'error' THEN '' ELSE 'at x' END AS stack,
         CASE WHEN source = 'error' THEN event_id % 90 ELSE 0 END AS line
       FROM s""",
)
def browser_signals(spark, folder):
    e = inputs.load(spark, folder, "events")
    n, u = F.col("event_id"), F.col("user_id")
    signals = e.select(
        "event_id",
        F.when(n % 4 == 0, "error").when(n % 4 == 1, "rejection").when(n % 4 == 2, "console").otherwise("manual").alias("source"),
        F.when(n % 3 == 0, "error").when(n % 3 == 1, "string").otherwise("none").alias("reason_kind"),
        F.when(u % 2 == 0, "").otherwise(F.concat(F.lit("went wrong "), u.cast("string"))).alias("message"),
        F.when(u % 3 == 0, "RangeError").otherwise("").alias("type"),
        F.lit("at x").alias("stack"),
        F.lit("app.js").alias("filename"),
        (n % 90).alias("line"),
        F.lit(1).alias("column"),
    )
    return shape.error_signal_defaults(signals).select("event_id", "source", "message", "type", "stack", "line")


# The size of a text repeated k times is k times its size between the quotes.
_INNER = f"({inputs.json_bytes_sql('CAST(to_json(text) AS VARCHAR)')} - 2)"


@query(
    "item_budgets",
    f"""WITH i AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 12 END AS k, strlen(text) AS n, {_INNER} AS inner_bytes FROM documents),
         f AS (SELECT *, length('{{"level":"notice","message":"","context":{{"body":""}}}}') + 2 * k * inner_bytes AS full_bytes FROM i)
       SELECT doc_id, CAST(full_bytes AS BIGINT) AS full_bytes, full_bytes > 71680 AS shrunk,
         full_bytes > 71680 AND k * n > 8192 AS cut_message,
         full_bytes > 71680 AND k * inner_bytes + length('{{"body":""}}') > 8192 AS removed_context FROM f""",
)
def item_budgets(spark, folder):
    """Byte budgets on items made of whole documents, some of them many times over."""
    d = inputs.load(spark, folder, "documents", "doc_id")
    big = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.repeat("text", F.lit(12)))
    items = d.select(
        "doc_id", F.lit("notice").alias("level"), big.alias("message"), F.to_variant_object(F.struct(big.alias("body"))).alias("context")
    )
    sized = items.withColumn("full_bytes", budget.item_bytes(items, "logs"))
    out = computed_once(budget.item_budget(sized, "logs", keep=("doc_id", "full_bytes"), dropped_too=True))
    parsed = F.parse_json("data")
    return out.select(
        "doc_id",
        "full_bytes",
        (F.col("budget_status") != "ok").alias("shrunk"),
        ((F.col("budget_status") != "ok") & F.endswith(F.variant_get(parsed, "$.message", "string"), F.lit(C.TRUNCATION_SUFFIX))).alias("cut_message"),
        F.variant_get(parsed, "$.context._truncated", "string").isNotNull().alias("removed_context"),
    )


@query(
    "utf8_cuts",
    """SELECT doc_id, strlen(text) > 1000 AS cut,
         CASE WHEN strlen(text) > 1000 THEN (SELECT max(n) FROM range(200, 1001) t(n) WHERE strlen(substr(text, 1, CAST(n AS INTEGER))) <= 1000)
              ELSE length(text) END AS chars FROM documents""",
)
def utf8_cuts(spark, folder):
    d = inputs.load(spark, folder, "documents")
    cut = text.cut_utf8(F.col("text"), 1000)
    return d.select("doc_id", (F.octet_length("text") > 1000).alias("cut"), F.length(cut).cast("bigint").alias("chars"))


@query(
    "report_bodies",
    """WITH r AS (SELECT conv_id, turn, text, turn * 15 AS crumbs FROM conversations),
         b AS (SELECT *, length('{"message":"m' || conv_id || '","context":{"doc":' || CAST(to_json(text) AS VARCHAR) || '},"breadcrumbs":') + 2 +
             length(CAST(to_json(text) AS VARCHAR)) - length(CAST(to_json(text) AS VARCHAR)) AS head,
             length('{"message":' || CAST(to_json(text) AS VARCHAR) || '}') AS crumb,
             length('{"message":"m' || conv_id || '","context":{},"breadcrumbs":') + 2 AS bare FROM r),
         s AS (SELECT *, head - 1 + (2 + crumbs * crumb + greatest(crumbs - 1, 0)) - 0 AS l0,
             head - 1 + (2 + (crumbs - crumbs // 2) * crumb + greatest(crumbs - crumbs // 2 - 1, 0)) AS l1,
             bare - 1 + (2 + (crumbs - crumbs // 2) * crumb + greatest(crumbs - crumbs // 2 - 1, 0)) AS l2 FROM b)
       SELECT conv_id, turn, CASE WHEN l0 <= 2000 THEN 'whole' WHEN crumbs > 0 AND l1 <= 2000 THEN 'half_breadcrumbs'
           WHEN l2 <= 2000 THEN 'no_context' ELSE 'oversize' END AS fit_step,
         CASE WHEN l0 <= 2000 THEN l0 WHEN crumbs > 0 AND l1 <= 2000 THEN l1 ELSE l2 END AS chars,
         least(l0, l1, l2) <= 2000 AS keepalive FROM s""",
)
def report_bodies(spark, folder):
    """Browser report bodies held to a limit (a low one, so that every step is reached)."""
    c = inputs.load(spark, folder, "conversations")
    crumb = F.struct(F.col("text").alias("message"))
    reports = c.select(
        "conv_id",
        "turn",
        F.concat(F.lit("m"), F.col("conv_id").cast("string")).alias("message"),
        F.to_variant_object(F.struct(F.col("text").alias("doc"))).alias("context"),
        F.array_repeat(crumb, (F.col("turn") * 15).cast("int")).alias("breadcrumbs"),
    )
    fitted = budget.fit_report_body(reports, limit=2000)
    return fitted.select(
        "conv_id", "turn", "fit_step", F.length("body").cast("bigint").alias("chars"), "keepalive"
    )
