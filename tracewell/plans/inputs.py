"""Raw telemetry records derived from the given tables, and the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import hashing
from tracewell.functions.let import computed_once
from tracewell.session import SPREAD

SALT = "catalogue-salt"
DATA_EPOCH = 1704067200  # 2024-01-01T00:00:00Z


def load(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A table.  Its splits decide the tasks.

    The tables of tests and bench are single files with one split.  Only where the session says so (`SPREAD`, which
    `local_session` sets) their rows are spread by `spread_by` for work that is heavy per row.
    """
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    tasks = spark.conf.get(SPREAD, None) if spread_by else None
    return table.repartition(int(tasks), spread_by) if tasks else table


def epoch(ts: Column) -> Column:
    """Whole seconds of a wall-clock timestamp read as UTC."""
    return F.unix_timestamp(ts.cast("timestamp"))


def raw_events(spark: SparkSession, folder: str, only: tuple[str, ...] = ()) -> DataFrame:
    """events: name, properties, user_id, ts, request, is_console, event_id, seq, at; or `only` some of them."""
    return events_as_raw(load(spark, folder, "events", "event_id"), only)


def events_as_raw(e: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    number = F.col("event_id").cast("string")
    user = F.col("user_id").cast("string")
    properties = F.concat(
        F.lit('{"props":'),
        F.col("props"),
        F.lit(',"api_token":"t-'),
        number,
        F.lit('","nested":{"password":"p","plan":"'),
        F.col("event_type"),
        F.lit('"},"link":"/exports/'),
        number,
        F.lit("/download?expires=1&signature=s"),
        number,
        F.lit('","note":"token=kept in prose"}'),
    )
    agent = F.when(F.col("user_id") % 7 == 0, "").otherwise(F.concat(F.lit("Mozilla/5.0 (visitor "), user, F.lit(")")))
    request = F.create_map(
        F.lit("REMOTE_ADDR"), F.concat(F.lit("10.0."), (F.col("user_id") % 250).cast("string"), F.lit(".1")),
        F.lit("HTTP_USER_AGENT"), agent,
        F.lit("HTTP_HOST"), F.lit("shop.example.com"),
        F.lit("REQUEST_URI"), F.concat(F.lit("/p/"), number, F.lit("?token=x"), number, F.lit("&page=2")),
        F.lit("HTTPS"), F.when(F.col("user_id") % 3 == 0, "off").otherwise("on"),
        F.lit("SERVER_PORT"), F.lit("80"),
    )
    columns = {
        "event_id": F.col("event_id"),
        "seq": F.col("event_id"),
        "at": epoch(F.col("ts")),
        "ts": F.col("ts"),
        "name": F.col("event_type"),
        "properties": F.parse_json(properties),
        "user_id": F.col("user_id"),
        "request": request,
        "is_console": F.col("user_id") % 10 == 0,
    }
    # Nothing is pruned through the barrier, so what is not wanted is left out before it.
    return computed_once(e.select(*[c.alias(name) for name, c in columns.items() if not only or name in only]))


def hmac_sql(value: str, salt: str = SALT) -> str:
    """HMAC-SHA256 of a SQL string expression."""
    key = salt.encode().ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in key).hex()
    outer = bytes(b ^ 0x5C for b in key).hex()
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({value}))))"


def json_bytes_sql(text: str) -> str:
    """Encoded size of a JSON text expression (without whole floats)."""
    t = f"({text})"
    astral = f"length(regexp_replace({t}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))"
    other = f"length(regexp_replace({t}, '[\\x00-\\x7F\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))"
    slashes = f"(length({t}) - length(replace({t}, '/', '')))"
    return f"(length({t}) + 5 * {other} + 11 * {astral} + {slashes})"


EVENTS_SQL = f"""
raw AS (
  SELECT event_id, user_id, event_type, ts, props, value,
         CAST(floor(epoch(ts)) AS BIGINT) AS secs,
         '10.0.' || (user_id % 250) || '.1' AS ip,
         CASE WHEN user_id % 7 = 0 THEN '' ELSE 'Mozilla/5.0 (visitor ' || user_id || ')' END AS ua
  FROM events
), items AS (
  SELECT event_id, user_id, secs, ts, event_type AS event_name,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp",
         '{{"api_token":"[REDACTED]","link":"/exports/' || event_id || '/download?expires=1&signature=[REDACTED]",' ||
         '"nested":{{"password":"[REDACTED]","plan":"' || event_type || '"}},"note":"token=kept in prose","props":' ||
         replace(props, ' ', '') || '}}' AS properties,
         CASE WHEN user_id % 10 = 0 THEN NULL ELSE
           (CASE WHEN user_id % 3 = 0 THEN 'http' ELSE 'https' END) || '://shop.example.com/p/' || event_id ||
           '?token=[REDACTED]&page=2' END AS url,
         CASE WHEN ua = '' THEN '' ELSE {hmac_sql("ua")} END AS user_agent_hash,
         {hmac_sql("ip || '|' || substr(ua, 1, 100) || '|' || strftime(ts, '%Y-%m-%d')")} AS session_id_hash
  FROM raw
), texts AS (
  SELECT *, '{{"event_name":"' || event_name || '","timestamp":"' || "timestamp" || '","properties":' || properties ||
         ',"user":{{"id":"' || user_id || '"}},"url":' || coalesce('"' || url || '"', 'null') ||
         ',"user_agent_hash":"' || user_agent_hash || '","session_id_hash":"' || session_id_hash || '"}}' AS data
  FROM items
), sized AS (
  SELECT *, {json_bytes_sql("data")} AS bytes FROM texts
)
"""


def type_of_event(event_type: Column) -> Column:
    """A record type for each kind of event, so that a backlog of all four types can be made."""
    return (
        F.when(event_type == "error", "errors")
        .when(event_type == "signup", "logs")
        .when(event_type == "purchase", "javascript_errors")
        .otherwise("events")
    )


TYPE_SQL = (
    "CASE event_type WHEN 'error' THEN 'errors' WHEN 'signup' THEN 'logs' "
    "WHEN 'purchase' THEN 'javascript_errors' ELSE 'events' END"
)


def backlog(spark: SparkSession, folder: str) -> DataFrame:
    """A spool of all four types: one envelope per event, its props as data."""
    return events_as_backlog(load(spark, folder, "events"))


def events_as_backlog(e: DataFrame) -> DataFrame:
    data = F.concat(F.lit('{"n":'), F.col("event_id").cast("string"), F.lit(',"p":'), F.col("props"), F.lit("}"))
    return e.select(
        type_of_event(F.col("event_type")).alias("type"),
        F.concat(F.lit("id-"), F.col("event_id").cast("string")).alias("id"),
        F.col("event_id").alias("seq"),
        epoch(F.col("ts")).alias("timestamp"),
        data.alias("data"),
        F.length(data).cast("bigint").alias("bytes"),
    )


BACKLOG_SQL = f"""
backlog AS (
  SELECT {TYPE_SQL} AS type, 'id-' || event_id AS id, event_id AS seq,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
         '{{"n":' || event_id || ',"p":' || props || '}}' AS data,
         length('{{"n":' || event_id || ',"p":' || props || '}}') AS bytes
  FROM events
)
"""


def salted_visit(value: Column) -> Column:
    return hashing.visit_hash(value, SALT)


# --- errors -----------------------------------------------------------------------------------


def raw_errors(spark: SparkSession, folder: str) -> DataFrame:
    """documents as errors: the text is the trace, the source the file."""
    d = load(spark, folder, "documents", "doc_id")
    number = F.col("doc_id").cast("string")
    request = F.create_map(
        F.lit("HTTP_HOST"), F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat("source", F.lit(".example.com"))),
        F.lit("SERVER_NAME"), F.lit("fallback.example.com"),
        F.lit("REQUEST_URI"), F.concat(F.lit("/"), "lang", F.lit("/"), number, F.lit("?api_key="), number, F.lit("&page=2")),
        F.lit("HTTPS"), F.when(F.col("doc_id") % 3 == 0, "OFF").when(F.col("doc_id") % 3 == 1, "on").otherwise(""),
        F.lit("REQUEST_METHOD"), F.when(F.col("doc_id") % 2 == 0, "get").otherwise("Post"),
        F.lit("HTTP_ACCEPT"), F.lit("text/html"),
        F.lit("HTTP_REFERER"), F.concat(F.lit("https://a.example.com/x?token="), number, F.lit("&q=1")),
        F.lit("HTTP_X_FORWARDED_FOR"), F.lit("10.0.0.1"),
        F.lit("HTTP_COOKIE"), F.lit("sid=1"),
        F.lit("CONTENT_TYPE"), F.lit("application/json"),
    )
    return computed_once(d.select(
        "doc_id",
        F.concat(F.lit("Failed with password=hunter"), number, F.lit(" for "), "source").alias("message"),
        F.concat(F.lit("/srv/app/src/"), "source", F.lit("/"), "lang", F.lit(".php")).alias("file"),
        (F.col("doc_id") % 40 + 1).alias("line"),
        F.lit("RuntimeException").alias("type"),
        F.lit("production").alias("environment"),
        F.col("text").alias("trace"),
        request.alias("request"),
        F.array(F.lit("bin/run"), "lang", F.concat(F.lit("--token=t"), number)).alias("argv"),
        (F.col("doc_id") % 5 == 0).alias("is_console"),
        F.timestamp_seconds(F.lit(DATA_EPOCH) + F.col("doc_id")).alias("ts"),
    ))


# --- browser reports --------------------------------------------------------------------------


def raw_reports(spark: SparkSession, folder: str) -> DataFrame:
    """error events as browser reports, on the page their user is on; some broken on purpose."""
    e = load(spark, folder, "events", "event_id").where("event_type = 'error'")
    pages = load(spark, folder, "pages").select("page_id", F.col("url").alias("page_url"))
    joined = e.join(pages, F.col("user_id") == F.col("page_id"), "left")
    number = F.col("event_id")
    text_number = number.cast("string")
    kind = number % 12
    message = (
        F.when(kind == 1, F.lit("   "))
        .when(kind == 2, F.concat(F.lit("Loading CHUNK "), text_number, F.lit(" failed")))
        .when(kind == 3, F.repeat(F.lit("m"), F.lit(2001)))
        .otherwise(F.concat(F.lit("Boom {token: abc"), text_number, F.lit("} at step "), (number % 5).cast("string")))
    )
    crumb = F.struct(
        F.lit("2024-01-01T00:00:00+00:00").alias("timestamp"),
        F.when(kind == 4, F.lit(None)).otherwise(F.lit("navigation")).alias("category"),
        F.lit("Page loaded").alias("message"),
        F.struct(F.col("page_url").alias("url"), F.lit("Bearer x").alias("authorization")).alias("data"),
    )
    crumbs = F.transform(F.sequence(F.lit(1), (number % 25 + 1).cast("int")), lambda i: F.struct(
        crumb["timestamp"].alias("timestamp"), crumb["category"].alias("category"),
        F.concat(crumb["message"], F.lit(" "), i.cast("string")).alias("message"), crumb["data"].alias("data"),
    ))
    info = F.struct(
        F.lit(1920).alias("screen_width"),
        F.when(kind == 5, F.lit("wide")).otherwise(F.lit("1080")).alias("screen_height"),
        F.lit("4g").alias("connection_type"),
        F.lit("x").alias("smuggled"),
    )
    payload = F.struct(
        message.alias("message"),
        F.when(kind == 6, F.lit("x")).otherwise((number % 300).cast("string")).alias("line"),
        F.lit(7).alias("column"),
        F.concat(F.lit("at app.js api_key=k"), text_number).alias("stack"),
        F.when(kind == 7, F.lit("TypeError")).alias("type"),
        F.col("page_url").alias("url"),
        crumbs.alias("breadcrumbs"),
        F.struct(F.lit("s3cret").alias("password"), (number % 9).alias("step")).alias("context"),
        info.alias("browser_info"),
        F.lit(True).alias("unknown_key"),
    )
    request = F.map_filter(
        F.create_map(
            F.lit("HTTP_HOST"), F.lit("Shop.Example.com:443"),
            F.lit("HTTP_ORIGIN"),
            F.when(kind == 8, F.lit("https://evil.example.net"))
            .when(kind == 9, F.lit("https://cdn.example.org:443/"))
            .when(kind == 10, F.lit("//no-scheme.example.com"))
            .when(kind == 11, F.lit(None))
            .otherwise(F.lit("HTTPS://shop.example.com:443")),
            F.lit("HTTP_REFERER"), F.when(kind == 11, F.lit(None)).otherwise(F.lit("https://shop.example.com/from?token=1")),
            F.lit("HTTP_USER_AGENT"), F.lit("Mozilla/5.0"),
        ),
        lambda _, v: v.isNotNull(),
    )
    reports = joined.select(
        F.col("event_id").alias("report_id"),
        F.parse_json(F.to_json(payload)).alias("payload"),
        request.alias("request"),
        F.col("user_id"),
        F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("s"), F.col("user_id").cast("string"))).alias("session_id"),
        F.col("ts").alias("received_at"),
        (F.col("user_id") % 11 != 0).alias("enabled"),
        (F.col("user_id") % 13 != 0).alias("feature_enabled"),
    )
    # As a stored table would: the payload is parsed once, not wherever it is read.
    return computed_once(reports)


ALLOWED_ORIGINS = ("https://cdn.example.org",)

REPORTS_SQL = """
reports AS (
  SELECT event_id AS report_id, event_id % 12 AS kind, user_id, ts, url AS page_url,
         CASE event_id % 12 WHEN 1 THEN '   ' WHEN 2 THEN 'Loading CHUNK ' || event_id || ' failed'
           WHEN 3 THEN repeat('m', 2001) ELSE 'Boom {token: abc' || event_id || '} at step ' || (event_id % 5) END AS message,
         event_id % 25 + 1 AS crumbs
  FROM (SELECT * FROM events WHERE event_type = 'error') e LEFT JOIN pages ON user_id = page_id
), judged AS (
  SELECT *,
    CASE WHEN user_id % 11 = 0 THEN 'disabled' WHEN user_id % 13 = 0 THEN 'feature_disabled'
      WHEN kind IN (8, 10) THEN 'origin_rejected'
      WHEN kind IN (1, 3, 4, 5, 6) OR (page_url IS NULL AND kind = 11) THEN 'invalid'
      WHEN kind = 2 THEN 'ignored' ELSE 'received' END AS disposition
  FROM reports
)
"""
