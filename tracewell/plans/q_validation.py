"""Contract checks on items, raw records, reports and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions.let import computed_once
from tracewell.operators import batching, budget, shape, validate
from tracewell.plans import inputs
from tracewell.plans.registry import query
from tracewell.session import new_table_path

_E, _R = inputs.EVENTS_SQL, inputs.REPORTS_SQL


@query(
    "contract_violations",
    """SELECT event_id, CASE WHEN user_id % 7 = 0 THEN 'user_agent_hash: size 64 characters, found 0' ELSE '' END ||
         CASE WHEN event_type = 'view' AND user_id % 7 = 0 THEN '; ' ELSE '' END ||
         CASE WHEN event_type = 'view' THEN 'event_name: max 50 characters, found ' || length(repeat('view_', 11)) ELSE '' END AS found
       FROM events""",
)
def contract_violations(spark, folder):
    """Typed event items against the event rules; the order of the list is that of the rules."""
    raw = inputs.raw_events(spark, folder)
    long_name = F.when(F.col("name") == "view", F.repeat(F.lit("view_"), F.lit(11))).otherwise(F.col("name"))
    shaped = computed_once(shape.shape_events(raw.withColumn("name", long_name), inputs.SALT, keep=("event_id",)))
    found = validate.validate(shaped, "events")
    return found.select("event_id", F.array_join(F.reverse("violations"), "; ").alias("found"))


def _raw_error_records(spark, folder):
    """documents as raw error records of varying faults, one VARIANT each."""
    d = inputs.load(spark, folder, "documents", "doc_id")
    k = F.col("doc_id") % 8
    number = F.col("doc_id").cast("string")
    fields = F.concat(
        F.lit('{"file":"a.php","type":"E","environment":"prod","timestamp":"'),
        F.when(k == 1, "yesterday-ish").otherwise("2024-01-01T00:00:00+00:00"),
        F.lit('","line":'),
        F.when(k == 2, '"12"').otherwise(number),
        F.when(k == 3, F.lit("")).otherwise(F.concat(F.lit(',"message":'), F.to_json(F.struct(F.col("text").alias("m"))))),
        F.when(k == 4, ',"headers":{"accept":["a",5],"host":"x"}').otherwise(""),
        F.when(k == 5, ',"method":"FETCH","surprise":1,"laravel_version":"11"').otherwise(""),
        F.when(k == 6, ',"console_arguments":[1,"ok",null]').otherwise(""),
        F.lit("}"),
    )
    return d.select("doc_id", F.parse_json(fields).alias("record"))


@query(
    "raw_record_violations",
    """SELECT doc_id, CASE doc_id % 8
         WHEN 1 THEN 'message: type string, found array; timestamp: type date, found string'
         WHEN 2 THEN 'message: type string, found array; line: type integer, found string'
         WHEN 3 THEN 'message: missing'
         WHEN 4 THEN 'message: type string, found array; headers.host: type array, found string; headers.accept.1: type string, found integer'
         WHEN 5 THEN 'surprise: not a field of this type; message: type string, found array; method: not in {GET,POST,PUT,PATCH,DELETE,HEAD,OPTIONS}'
         WHEN 6 THEN 'message: type string, found array; console_arguments.0: type string, found integer'
         ELSE 'message: type string, found array' END AS found,
         CASE WHEN doc_id % 8 = 5 THEN 1 ELSE 0 END AS unexpected
       FROM documents""",
)
def raw_record_violations(spark, folder):
    """VARIANT records against the strict error rules, nested and wildcard paths included."""
    found = validate.unexpected_fields(
        validate.validate(_raw_error_records(spark, folder), "errors", record="record"), "errors"
    )
    return found.select(
        "doc_id", F.array_join("violations", "; ").alias("found"), F.size("unexpected").alias("unexpected")
    )


_PROBLEMS = """CASE WHEN kind = 1 THEN 'message=The message field is required.' WHEN kind = 3 THEN 'message=The message field must not be greater than 2000 characters.' END,
  CASE WHEN kind = 6 THEN 'line=The line field must be an integer.' END,
  CASE WHEN page_url IS NULL AND kind = 11 THEN 'url=The url field is required.' END,
  CASE WHEN kind = 4 THEN array_to_string(list_transform(range(0, crumbs), lambda i: 'breadcrumbs.' || i || '.category=The breadcrumbs.' || i || '.category field is required.'), '; ') END,
  CASE WHEN kind = 5 THEN 'browser_info.screen_height=The browser_info.screen_height field must be a number.' END"""


@query(
    "report_problems",
    f"""WITH {_R} SELECT report_id, concat_ws('; ', {_PROBLEMS}) AS problems FROM reports""",
)
def report_problems(spark, folder):
    found = validate.validate_browser_report(inputs.raw_reports(spark, folder))
    listed = F.transform("problems", lambda p: F.concat(p["field"], F.lit("="), p["message"]))
    return found.select("report_id", F.array_join(listed, "; ").alias("problems"))


@query(
    "report_funnel",
    f"""WITH {_R}, sampled AS (SELECT *, CASE WHEN disposition = 'received' AND
            CAST('0x' || substr(md5(CAST(report_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 > 0.7 THEN 'sampled_out' ELSE disposition END AS d FROM judged)
        SELECT d AS disposition, CASE WHEN d IN ('disabled', 'feature_disabled', 'origin_rejected') THEN 403 WHEN d = 'invalid' THEN 422 ELSE 200 END AS status,
          count(*) AS reports FROM sampled GROUP BY ALL""",
)
def report_funnel(spark, folder):
    classified = validate.classify_reports(inputs.raw_reports(spark, folder), inputs.ALLOWED_ORIGINS, rate=0.7)
    return validate.report_funnel(classified)


@query(
    "abuse_checks",
    """WITH p AS (SELECT conv_id, turn, text, CASE turn % 4 WHEN 0 THEN 'debug' ELSE 'chat_turn' END AS name FROM conversations)
       SELECT conv_id, turn, concat_ws(',', CASE WHEN name = 'debug' THEN 'forbidden_event_name' END,
           CASE WHEN length(text) > 500 THEN 'max_property_value_chars' END,
           CASE WHEN turn % 5 = 1 THEN 'max_property_repetition_ratio' END,
           CASE WHEN turn % 3 = 2 THEN 'max_consecutive_character_repetition' END) AS abuse
       FROM p""",
)
def abuse_checks(spark, folder):
    c = inputs.load(spark, folder, "conversations", "conv_id")
    turn = F.col("turn")
    run = F.when(turn % 3 == 2, F.repeat(F.lit("z"), F.lit(51))).otherwise(F.repeat(F.lit("z"), F.lit(50)))
    text, same = F.col("text").alias("text"), [F.lit(1).alias(f"same{i}") for i in range(9)]
    short = F.to_variant_object(F.struct(text, run.alias("run")))
    alike = F.to_variant_object(F.struct(text, *same, run.alias("run")))
    events = c.select(
        "conv_id",
        "turn",
        F.when(turn % 4 == 0, "debug").otherwise("chat_turn").alias("event_name"),
        F.when(turn % 5 == 1, alike).otherwise(short).alias("properties"),
    )
    checked = validate.event_abuse_checks(events, item_bytes=F.lit(0))
    return checked.select("conv_id", "turn", F.array_join("abuse", ",").alias("abuse"))


@query(
    "oversize_events",
    f"""SELECT doc_id, {inputs.json_bytes_sql("'{\"event_name\":\"doc_read\",\"timestamp\":null,\"properties\":{\"text\":' || CAST(to_json(text) AS VARCHAR) || '}}'")} > 5120 AS oversize FROM documents""",
)
def oversize_events(spark, folder):
    d = inputs.load(spark, folder, "documents", "doc_id")
    events = d.select(
        "doc_id",
        F.lit("doc_read").alias("event_name"),
        F.lit(None).cast("string").alias("timestamp"),
        F.to_variant_object(F.struct("text")).alias("properties"),
    )
    checked = validate.event_abuse_checks(events)
    return checked.select("doc_id", F.array_contains("abuse", "max_item_bytes").alias("oversize"))


@query(
    "batch_verdicts",
    f"""WITH {_E}, placed AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS chunk FROM sized)
        SELECT 'events' AS type, chunk * 100 AS batch_no, count(*) AS items, count(*) FILTER (user_agent_hash = '') AS invalid_items,
          CASE WHEN count(*) FILTER (user_agent_hash = '') > 0 THEN 422 ELSE 200 END AS status
        FROM placed GROUP BY chunk""",
)
def batch_verdicts(spark, folder):
    shaped = shape.shape_events(inputs.raw_events(spark, folder), inputs.SALT, keep=("event_id", "seq"))
    checked = validate.validate(shaped, "events")
    slim = checked.select(F.lit("events").alias("type"), "seq", F.lit(0).cast("bigint").alias("bytes"), "violations")
    # Numbering reads its input twice, so what was judged is stored once.
    path = new_table_path(spark, "judged")
    slim.write.parquet(path)
    return validate.batch_verdict(batching.pack_batches(spark.read.parquet(path), max_items=100))


@query(
    "contract_drift",
    """SELECT * FROM (VALUES ('event_name', TRUE, TRUE, TRUE), ('timestamp', TRUE, TRUE, TRUE), ('properties', TRUE, TRUE, FALSE),
           ('user', TRUE, TRUE, FALSE), ('url', TRUE, TRUE, FALSE), ('user_agent_hash', TRUE, TRUE, FALSE),
           ('session_id_hash', TRUE, FALSE, FALSE), ('visitor', FALSE, TRUE, FALSE)) v(field, declared, emitted, required)
       CROSS JOIN (SELECT count(*) AS rows, count(*) FILTER (user_id % 10 = 0) AS consoles, count(*) FILTER (event_type = 'view') AS views FROM events) t
       CROSS JOIN LATERAL (SELECT CASE field WHEN 'url' THEN consoles WHEN 'session_id_hash' THEN rows WHEN 'event_name' THEN views ELSE 0 END AS null_rows) n
       CROSS JOIN LATERAL (SELECT NOT declared OR (required AND null_rows > 0) AS drift) d""".replace(
        "SELECT * FROM", "SELECT field, declared, emitted, required, null_rows, rows, drift FROM", 1
    ),
)
def contract_drift(spark, folder):
    raw = inputs.raw_events(spark, folder)
    shaped = shape.shape_events(raw, inputs.SALT)
    emitted = (
        shaped.withColumnRenamed("session_id_hash", "visitor")
        .withColumn("event_name", F.when(F.col("event_name") != "view", F.col("event_name")))
    )
    return validate.contract_drift_report(emitted, "events")


@query(
    "dropped_items",
    """WITH d AS (SELECT lang, source, doc_id % 9 * 400 AS m, doc_id % 5 * 900 AS c FROM documents),
         s AS (SELECT lang, length('{"level":"","message":"","channel":""}') + length(source) AS frame, m, c,
             CASE WHEN m > 1000 THEN 1015 ELSE m END AS m_cut, CASE WHEN c > 1000 THEN 1015 ELSE c END AS c_cut FROM d)
       SELECT lang AS type, CASE WHEN frame + m + c <= 2000 THEN 'ok' WHEN frame + m_cut + c_cut <= 2000 THEN 'shrunk' ELSE 'dropped' END AS budget_status,
         count(*) AS items FROM s GROUP BY ALL""",
)
def dropped_items(spark, folder):
    """Log items over a low budget: some fit once their long strings are cut, others are dropped."""
    d = inputs.load(spark, folder, "documents")
    rows = d.select(
        "lang", F.col("source").alias("level"), F.repeat(F.lit("m"), (F.col("doc_id") % 9 * 400).cast("int")).alias("message"),
        F.repeat(F.lit("c"), (F.col("doc_id") % 5 * 900).cast("int")).alias("channel"),
    )
    sized = budget.item_budget(rows, "logs", keep=("lang",), max_item=2000, max_field=1000, dropped_too=True)
    return sized.groupBy(F.col("lang").alias("type"), "budget_status").agg(F.count(F.lit(1)).alias("items"))


@query(
    "budget_report",
    f"""WITH {_E} SELECT 'events' AS type, 'ok' AS budget_status, count(*) AS items, CAST(sum(bytes) AS BIGINT) AS bytes FROM sized""",
)
def budget_report(spark, folder):
    shaped = shape.shape_events(inputs.raw_events(spark, folder), inputs.SALT, keep=("event_id",))
    sized = budget.item_budget(shaped, "events", keep=("event_id",), dropped_too=True)
    return budget.budget_report(sized.withColumn("type", F.lit("events")))
