"""Responses, what they lead to, and pauses.

Responses are derived from the batches of the backlog: the status from the number of the batch,
counters from its size.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.operators import batching, delivery, spool
from tracewell.plans import inputs
from tracewell.plans.registry import query
from tracewell.session import new_table_path
from tracewell.sources import items as sources

_STATUSES = (200, 200, 429, 500, 401, 422, 200, 403, 0, 413, 201)


def packed(spark, folder):
    return batching.pack_batches(inputs.backlog(spark, folder), max_items=50)


def stored_batches(spark, folder):
    """The same batches as a table: what is sent is stored, and read again once answers are in."""
    path = new_table_path(spark, "batches")
    packed(spark, folder).write.partitionBy("type").parquet(path)
    return spark.read.parquet(path)


def sizes(batches):
    return batches.groupBy("type", "batch_no").agg(
        F.count(F.lit(1)).alias("items"), F.max("timestamp").alias("last_at")
    )


def raw_responses(spark, folder, sent=None):
    """One answer per batch, as it came over the wire."""
    batches = sizes(packed(spark, folder) if sent is None else sent)
    number = F.expr("batch_no div 50")
    k = (number % len(_STATUSES)).cast("int")
    status = F.element_at(F.array(*[F.lit(s) for s in _STATUSES]), k + 1)
    unprocessed = F.when(k == 1, F.least(F.lit(3), F.col("items"))).otherwise(0)
    failed = F.when(k == 6, F.least(F.lit(2), F.col("items"))).otherwise(0)
    body = F.when(
        status == 200,
        F.concat(
            F.lit('{"success":true,"items":{"received":'), F.col("items").cast("string"),
            F.lit(',"processed":'), (F.col("items") - unprocessed - failed).cast("string"),
            F.when(failed > 0, F.concat(F.lit(',"failed":'), failed.cast("string"))).otherwise(""),
            F.when(unprocessed > 0, F.concat(F.lit(',"unprocessed":'), unprocessed.cast("string"))).otherwise(""),
            F.lit("}"),
            F.when(unprocessed > 0, F.lit(',"unprocessed_indexes":[2,0,"1",0,99,1]')).otherwise(""),
            F.lit("}"),
        ),
    ).when(status == 500, "<html>oops</html>").when(
        status.isin(401, 422), F.concat(F.lit('{"success":false,"error":{"message":"no '), number.cast("string"), F.lit('"}}'))
    ).otherwise('{"success":false}')
    retry = F.when(status == 429, F.element_at(F.array(*[F.lit(x) for x in ("5", "", "0", " 90 s", "soon")]), (number % 5 + 1).cast("int")))
    unanswered = F.when((status == 0) & (number % 2 == 0), F.concat(F.lit("timed out after "), number.cast("string")))
    return batches.select(
        "type", "batch_no", "items", status.alias("status"), retry.alias("retry_after"), body.alias("body"), F.col("last_at").alias("at"),
        unanswered.alias("transport_error"),
    )


def decided(spark, folder, sent=None):
    return delivery.decide(sources.normalize_responses(raw_responses(spark, folder, sent)))


def stored_answers(spark, folder, batches):
    """Decided responses as a table of one row per batch: what follows from them reads it more than once."""
    path = new_table_path(spark, "answers")
    decided(spark, folder, batches).write.parquet(path)
    return spark.read.parquet(path)


RESPONSES_SQL = f"""
WITH {inputs.BACKLOG_SQL},
pos AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY seq) - 1 AS p FROM backlog),
items AS (SELECT *, p // 50 AS num, (p // 50) * 50 AS batch_no, p % 50 AS batch_pos FROM pos),
sizes AS (SELECT type, num, batch_no, count(*) AS items, max("timestamp") AS secs FROM items GROUP BY ALL),
resp AS (
  SELECT *, num % {len(_STATUSES)} AS k, {list(_STATUSES)}[CAST(num % {len(_STATUSES)} AS INTEGER) + 1] AS status,
    CASE WHEN num % {len(_STATUSES)} = 1 THEN least(3, items) ELSE 0 END AS unprocessed,
    CASE WHEN num % {len(_STATUSES)} = 6 THEN least(2, items) ELSE 0 END AS failed,
    ['5', '', '0', ' 90 s', 'soon'][CAST(num % 5 AS INTEGER) + 1] AS ra
  FROM sizes
),
dec AS (
  SELECT *, status NOT IN (200, 413, 422) AS requeue, status IN (413, 422) AS dropped,
    CASE WHEN status = 200 THEN 'none' WHEN status = 401 THEN 'global' ELSE 'feature' END AS pause_scope,
    CASE WHEN status = 200 THEN NULL WHEN status = 429 THEN (CASE num % 5 WHEN 0 THEN 5 WHEN 3 THEN 90 ELSE 60 END) ELSE 900 END AS pause_seconds,
    CASE WHEN status = 0 THEN 'network' ELSE CAST(status AS VARCHAR) END AS reason,
    status NOT IN (200, 401, 403, 413, 422, 429) AS transient,
    CASE WHEN unprocessed > 0 THEN [2, 0, 0, 99, 1] ELSE [] END AS idx
  FROM resp
)
"""


@query(
    "read_responses",
    f"""{RESPONSES_SQL} SELECT type, batch_no, status, CASE WHEN status = 429 THEN ra ELSE '' END AS retry_after,
          CASE WHEN status IN (401, 422) THEN 'no ' || num END AS error_message,
          CASE WHEN status = 200 THEN items ELSE 0 END AS received, CASE WHEN status = 200 THEN items - unprocessed - failed ELSE 0 END AS processed,
          0 AS ignored, failed, unprocessed, array_to_string(idx, ',') AS indexes, status IN (200, 201) AS success FROM dec""",
)
def read_responses(spark, folder):
    """Responses written as they came and read back normalised."""
    path = new_table_path(spark, "responses")
    raw_responses(spark, folder).drop("items").write.parquet(path)
    read = sources.read_responses(spark, path)
    return read.select(
        "type", "batch_no", "status", "retry_after", "error_message", "received", "processed", "ignored", "failed",
        "unprocessed", F.array_join("unprocessed_indexes", ",").alias("indexes"), "success",
    )


@query(
    "delivery_outcomes",
    f"""{RESPONSES_SQL} SELECT type, batch_no, status, requeue, dropped AS "drop", pause_scope, CAST(pause_seconds AS BIGINT) AS pause_seconds, reason, transient,
          array_to_string(idx, ',') AS requeue_indexes FROM dec""",
)
def delivery_outcomes(spark, folder):
    return decided(spark, folder).select(
        "type", "batch_no", "status", "requeue", "drop", "pause_scope", "pause_seconds", "reason", "transient",
        F.array_join("requeue_indexes", ",").alias("requeue_indexes"),
    )


@query(
    "outcome_diagnostics",
    f"""{RESPONSES_SQL}
        SELECT type, batch_no, CASE status WHEN 413 THEN 'critical' WHEN 429 THEN 'warning' ELSE 'error' END AS severity,
          CASE status WHEN 0 THEN 'Network error during batch send' WHEN 401 THEN 'API authentication failed, invalid or revoked API key'
            WHEN 403 THEN 'API request forbidden' WHEN 413 THEN 'Payload too large, indicates a client bug'
            WHEN 422 THEN 'Validation failed, indicates schema drift or malformed items' WHEN 429 THEN 'Rate limit exceeded'
            WHEN 500 THEN 'Server error during batch processing' ELSE 'Unexpected API response status' END AS diagnostic,
          CASE status WHEN 0 THEN CASE WHEN num % 2 = 0 THEN 'timed out after ' || num ELSE 'Unknown network error' END WHEN 401 THEN 'no ' || num WHEN 422 THEN 'no ' || num WHEN 403 THEN 'Forbidden' WHEN 413 THEN 'Payload Too Large' END AS detail
        FROM dec WHERE status <> 200
        UNION ALL SELECT type, batch_no, 'warning', 'Some items failed during processing', NULL FROM dec WHERE status = 200 AND failed > 0
        UNION ALL SELECT type, batch_no, 'info', 'Some items were not processed due to timeout', NULL FROM dec WHERE status = 200 AND unprocessed > 0""",
)
def outcome_diagnostics(spark, folder):
    notes = delivery.classify_outcomes(sources.normalize_responses(raw_responses(spark, folder)))
    return notes.select("type", "batch_no", "severity", "diagnostic", "detail")


@query(
    "routes",
    f"""{RESPONSES_SQL} SELECT type, batch_no, CASE type WHEN 'javascript_errors' THEN '/javascript-errors/store' WHEN 'logs' THEN '/v2/logs' ELSE '/' || type || '/store' END AS path,
          type AS wrapper, CASE type WHEN 'javascript_errors' THEN 'JavaScriptErrors' ELSE upper(type[1]) || type[2:] END AS feature,
          CASE type WHEN 'logs' THEN 'logging.timeout' ELSE type || '.timeout' END AS timeout_key FROM sizes""",
)
def routes(spark, folder):
    """Routing with one endpoint replaced by the caller's own."""
    table = delivery.endpoints(spark, {"logs": ("/v2/logs", "logs", "Logs", "logging.timeout")})
    return delivery.route(sizes(packed(spark, folder)).select("type", "batch_no"), table)


@query(
    "requeued_items",
    f"""{RESPONSES_SQL}, u AS (SELECT type, batch_no, unnest(idx) AS i, generate_subscripts(idx, 1) - 1 AS ordinal FROM dec)
        SELECT items.type, id, items.batch_no, CAST(ordinal AS INTEGER) AS ordinal FROM u JOIN items ON items.type = u.type AND items.batch_no = u.batch_no AND items.batch_pos = u.i
        UNION ALL SELECT type, id, batch_no, CAST(batch_pos AS INTEGER) FROM items SEMI JOIN (SELECT type, batch_no FROM dec WHERE requeue) d USING (type, batch_no)""",
)
def requeued_items(spark, folder):
    batches = stored_batches(spark, folder)
    answers = decided(spark, folder, batches)
    both = delivery.requeue_unprocessed(answers, batches).unionByName(delivery.requeue_batches(answers, batches))
    return both.select("type", "id", "batch_no", "ordinal")


@query(
    "next_spool",
    f"""{RESPONSES_SQL}, u AS (SELECT type, batch_no, unnest(idx) AS i, generate_subscripts(idx, 1) - 1 AS ordinal FROM dec),
          back AS (SELECT items.type, items.data, items.batch_no, ordinal FROM u JOIN items ON items.type = u.type AND items.batch_no = u.batch_no AND items.batch_pos = u.i
            UNION ALL SELECT type, data, batch_no, batch_pos FROM items SEMI JOIN (SELECT type, batch_no FROM dec WHERE requeue) d USING (type, batch_no)),
          kept AS (SELECT type, seq, data, id, "timestamp" FROM pos WHERE p >= 300 AND type <> 'logs'),
          tail AS (SELECT type, max(seq) AS top FROM pos GROUP BY type)
        SELECT * FROM kept
        UNION ALL
        SELECT * FROM (SELECT back.type, top + row_number() OVER (PARTITION BY back.type ORDER BY batch_no, ordinal) AS seq, data,
          'r-1800000000-' || back.type || '-' || (top + row_number() OVER (PARTITION BY back.type ORDER BY batch_no, ordinal)) AS id, 1800000000 AS "timestamp"
          FROM back JOIN tail ON back.type = tail.type)""",
)
def next_spool(spark, folder):
    """What a take leaves, and the requeued records behind it; of one type nothing is left."""
    batches = stored_batches(spark, folder)
    answers = stored_answers(spark, folder, batches)
    back = delivery.requeue_unprocessed(answers, batches).unionByName(delivery.requeue_batches(answers, batches))
    backlog = inputs.backlog(spark, folder)
    left = spool.discard_backlog(spool.remainder(backlog, spool.take_fifo(backlog, 300)), "logs")
    after = spool.next_spool(left, delivery.with_slot(back), 1_800_000_000, spool.last_given(backlog))
    return after.select("type", "seq", "data", "id", "timestamp")


@query(
    "pending_items",
    f"""{RESPONSES_SQL} SELECT type, count(*) AS items FROM items ANTI JOIN (SELECT type, batch_no FROM dec WHERE status = 200) d USING (type, batch_no) GROUP BY type""",
)
def pending_items(spark, folder):
    batches = stored_batches(spark, folder)
    done = decided(spark, folder, batches).where("status = 200").select("type", "batch_no")
    acknowledged = batches.join(done, ["type", "batch_no"], "left_semi")
    left = delivery.pending(inputs.backlog(spark, folder), acknowledged)
    return left.groupBy("type").agg(F.count(F.lit(1)).alias("items"))


_SUMMARY = """sum_ AS (SELECT type, CASE WHEN requeue THEN items WHEN unprocessed > 0 THEN least(items, 3) ELSE 0 END AS requeued,
   CASE WHEN dropped THEN items ELSE 0 END AS dropped_n, failed, items FROM dec),
 parts AS (SELECT type, 'requeued' AS disposition, requeued AS n FROM sum_ UNION ALL SELECT type, 'dropped', dropped_n FROM sum_
   UNION ALL SELECT type, 'failed', failed FROM sum_ UNION ALL SELECT type, 'sent', items - requeued - dropped_n - failed FROM sum_)"""


@query(
    "delivery_summary",
    f"""{RESPONSES_SQL}, {_SUMMARY} SELECT type, disposition, CAST(sum(n) AS BIGINT) AS items FROM parts GROUP BY ROLLUP (type, disposition)""",
)
def delivery_summary(spark, folder):
    batches = stored_batches(spark, folder)
    return delivery.delivery_summary(decided(spark, folder, batches), sizes(batches), totals=True)


@query(
    "item_dispositions",
    f"""{RESPONSES_SQL} SELECT items.type, CASE WHEN dropped THEN 'dropped' WHEN requeue OR list_contains(idx, batch_pos) THEN 'requeued' ELSE 'sent' END AS disposition, count(*) AS items
        FROM items JOIN dec ON items.type = dec.type AND items.batch_no = dec.batch_no GROUP BY ALL""",
)
def item_dispositions(spark, folder):
    batches = stored_batches(spark, folder)
    marked = delivery.item_dispositions(decided(spark, folder, batches), batches)
    return marked.groupBy("type", "disposition").agg(F.count(F.lit(1)).alias("items"))


@query(
    "response_rollup",
    f"""{RESPONSES_SQL} SELECT type, count(*) AS responses, CAST(sum(CASE WHEN status = 200 THEN items ELSE 0 END) AS BIGINT) AS received,
          CAST(sum(CASE WHEN status = 200 THEN items - unprocessed - failed ELSE 0 END) AS BIGINT) AS processed, 0 AS ignored,
          CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(unprocessed) AS BIGINT) AS unprocessed, 0 AS unbalanced FROM dec GROUP BY type""",
)
def response_rollup(spark, folder):
    return delivery.response_rollup(sources.normalize_responses(raw_responses(spark, folder)))


@query(
    "last_success",
    f"""{RESPONSES_SQL} SELECT type, max(secs) AS last_success_at FROM dec WHERE status = 200 GROUP BY type""",
)
def last_success(spark, folder):
    return delivery.last_success(sources.normalize_responses(raw_responses(spark, folder)))


_PAUSES = f"""{RESPONSES_SQL},
pauses AS (SELECT CASE WHEN pause_scope = 'global' THEN 'global' ELSE type END AS scope, secs AS started_at, secs + pause_seconds AS paused_until, reason
  FROM dec WHERE pause_scope <> 'none'
  UNION ALL SELECT 'errors', CAST(floor(epoch(ts)) AS BIGINT), NULL, 'cleared' FROM events WHERE event_type = 'signup')"""


def all_pauses(spark, folder):
    """Pauses from the responses, and clearings of one scope."""
    made = delivery.pauses_of(decided(spark, folder))
    e = inputs.load(spark, folder, "events").where("event_type = 'signup'")
    cleared = e.select(
        F.lit("errors").alias("scope"),
        inputs.epoch(F.col("ts")).alias("started_at"),
        F.lit(None).cast("bigint").alias("paused_until"),
        F.lit("cleared").alias("reason"),
    )
    return made.unionByName(cleared)


@query(
    "pause_table",
    f"""{_PAUSES} SELECT scope, count(*) AS pauses, min(started_at) AS first_at, max(paused_until) AS last_until FROM pauses GROUP BY scope""",
)
def pause_table(spark, folder):
    return all_pauses(spark, folder).groupBy("scope").agg(
        F.count(F.lit(1)).alias("pauses"), F.min("started_at").alias("first_at"), F.max("paused_until").alias("last_until")
    )


@query(
    "paused_runs",
    f"""{_PAUSES},
runs AS (SELECT event_id AS run_id, {inputs.TYPE_SQL} AS type, CAST(floor(epoch(ts)) AS BIGINT) + 30 AS at_ FROM events),
latest AS (SELECT scope, started_at, max(coalesce(paused_until, -1)) AS paused_until,
    arg_max(reason, coalesce(paused_until, -1)) AS reason FROM pauses GROUP BY scope, started_at),
asked AS (SELECT run_id, type, at_, 'global' AS scope FROM runs UNION ALL SELECT run_id, type, at_, type FROM runs),
hits AS (SELECT asked.*, latest.paused_until, latest.reason FROM asked ASOF LEFT JOIN latest ON asked.scope = latest.scope AND asked.at_ >= latest.started_at),
act AS (SELECT run_id, type, at_, max(CASE WHEN scope = 'global' AND paused_until > at_ THEN reason END) AS g, max(CASE WHEN scope <> 'global' AND paused_until > at_ THEN reason END) AS f
  FROM hits GROUP BY run_id, type, at_)
SELECT run_id, type, g IS NOT NULL OR f IS NOT NULL AS paused, CASE WHEN g IS NOT NULL THEN 'global' WHEN f IS NOT NULL THEN type END AS pause_scope,
  coalesce(g, f) AS reason FROM act""",
)
def paused_runs(spark, folder):
    runs = inputs.load(spark, folder, "events").select(
        F.col("event_id").alias("run_id"),
        inputs.type_of_event(F.col("event_type")).alias("type"),
        (inputs.epoch(F.col("ts")) + 30).alias("at"),
    )
    path = new_table_path(spark, "pauses")
    all_pauses(spark, folder).write.parquet(path)
    found = delivery.paused_at(runs, spark.read.parquet(path))
    return found.select("run_id", "type", "paused", "pause_scope", "reason")


@query(
    "blocked_types",
    f"""{RESPONSES_SQL}, runs AS (SELECT num AS run_id, type, status, CASE type WHEN 'errors' THEN 1 WHEN 'events' THEN 2 WHEN 'logs' THEN 3 ELSE 4 END AS r FROM dec),
          f AS (SELECT run_id, min(r) AS first_r FROM runs WHERE status = 401 GROUP BY run_id)
        SELECT run_id, t.type FROM f, (VALUES ('errors', 1), ('events', 2), ('logs', 3), ('javascript_errors', 4)) t(type, r) WHERE t.r > first_r""",
)
def blocked_types(spark, folder):
    """Types the runs never reached, a run being the batches of one number."""
    results = decided(spark, folder).select(F.expr("batch_no div 50").alias("run_id"), "type", "status")
    return delivery.blocked_types(results)


@query(
    "minute_rates",
    """SELECT CAST(epoch(time_bucket(INTERVAL '1 minute', ts)) AS BIGINT) AS minute, event_type, count(*) AS requests, count(*) > 1 AS over_limit FROM events GROUP BY ALL""",
)
def minute_rates(spark, folder):
    e = inputs.load(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    flagged = delivery.rate_flags(e, keys=("event_type",), limit=1)
    return flagged.select(F.unix_timestamp("minute").alias("minute"), "event_type", "requests", "over_limit")
