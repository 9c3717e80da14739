"""Redaction in text, URLs, paths and nested data; caps and sizes of text."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell import contracts as C
from tracewell.functions import redact, sizing, text
from tracewell.operators import shape, validate
from tracewell.plans import inputs
from tracewell.plans.registry import query

_FRAGMENTS = "password|passwd|secret|token|api_key|apikey|api-key|authorization|signature|credential"
_TEXT_RE2 = (
    rf"(?i)(^|[^\w.\-])([\w.\-]*(?:{_FRAGMENTS})[\w.\-]*[\"'']?\s*[=:]\s*)"
    r"(?:\"(?:[^\"\\]|\\.)*\"|''(?:[^''\\]|\\.)*''|[\"''][^\n]*|(?:Bearer|Basic|Digest|Token)[ \t]+[^\s,;&\"'']+|[^\s,;&\"'']+)"
)
_REDACTED_TEXT = f"regexp_replace(text, '{_TEXT_RE2}', '\\1\\2[REDACTED]', 'g')"


@query(
    "redact_docs",
    f"""SELECT doc_id, md5({_REDACTED_TEXT}) AS redacted_md5, length({_REDACTED_TEXT}) AS redacted_chars,
        len(regexp_extract_all(text, '{_TEXT_RE2}')) AS redactions FROM documents""",
)
def redact_docs(spark, folder):
    d = inputs.load(spark, folder, "documents", "doc_id")
    clean = d.select("doc_id", redact.count_redactions(F.col("text")).alias("redactions"), redact.redact_text(F.col("text")).alias("clean"))
    return clean.select(
        "doc_id", F.md5("clean").alias("redacted_md5"), F.length("clean").alias("redacted_chars"), "redactions"
    )


@query(
    "redaction_counts",
    f"""WITH c AS (SELECT lang, len(regexp_extract_all(text, '{_TEXT_RE2}')) AS n,
          len(regexp_extract_all(source, '{_TEXT_RE2}')) AS m FROM documents)
        SELECT lang, 'text' AS "column", count(*) FILTER (n > 0) AS redacted_rows, CAST(sum(n) AS BIGINT) AS redacted_values
        FROM c GROUP BY lang
        UNION ALL SELECT lang, 'source', count(*) FILTER (m > 0), CAST(sum(m) AS BIGINT) FROM c GROUP BY lang""",
)
def redaction_counts(spark, folder):
    d = inputs.load(spark, folder, "documents", "doc_id")
    return validate.redaction_report(d, ["text", "source"], by=["lang"])


@query(
    "redact_page_urls",
    """SELECT page_id, regexp_replace(url, '([?&][^=&#]*ref[^=&#]*=)[^&#]*', '\\1[REDACTED]', 'gi') AS url FROM pages""",
)
def redact_page_urls(spark, folder):
    pages = inputs.load(spark, folder, "pages")
    return pages.select("page_id", redact.redact_url(F.col("url"), (*C.SENSITIVE_FRAGMENTS, "ref")).alias("url"))


@query(
    "redact_callback_urls",
    """SELECT page_id,
         split_part(url, '#', 1) || '#access_token=[REDACTED]&expires_in=' || page_id AS query_shaped,
         split_part(url, '#', 1) || '#/reset/[REDACTED]' AS route_shaped,
         split_part(url, '#', 1) || '#section token-2' AS anchor
       FROM pages""",
)
def redact_callback_urls(spark, folder):
    """Fragments: query-shaped ones lose parameters, routes lose segments, anchors stay."""
    pages = inputs.load(spark, folder, "pages")
    base = F.substring_index("url", "#", 1)
    number = F.col("page_id").cast("string")
    login = F.concat(base, F.lit("#access_token=tk"), number, F.lit("&expires_in="), number)
    route = F.concat(base, F.lit("#/reset/tk"), number)
    anchor = F.concat(base, F.lit("#section token-2"))
    secret = F.array(F.concat(F.lit("tk"), number))
    return pages.select(
        "page_id",
        redact.redact_url(login).alias("query_shaped"),
        redact.redact_url_path(route, secret).alias("route_shaped"),
        redact.redact_url_path(redact.redact_url(anchor), secret).alias("anchor"),
    )


@query(
    "redact_url_paths",
    """SELECT page_id,
         regexp_replace(url, '^(https?://[^/]+)/[^/?#]+/[^/?#]+', '\\1/[REDACTED]/[REDACTED]') AS url
       FROM pages""",
)
def redact_url_paths(spark, folder):
    """Secret path segments resolved per URL from a route table: one route per document language, and one for any."""
    pages = inputs.load(spark, folder, "pages")
    langs = inputs.load(spark, folder, "documents").select("lang").distinct()
    named = langs.select(
        F.concat(F.lit("/"), "lang", F.lit("/{page}")).alias("pattern"), F.array(F.lit("page")).alias("secret_params")
    )
    general = langs.agg(F.count(F.lit(1))).select(
        F.lit("/{lang}/{page}").alias("pattern"), F.array(F.lit("lang")).alias("secret_params")
    )
    resolved = shape.attach_path_secrets(pages, named.unionByName(general))
    return resolved.select("page_id", redact.redact_url_path(F.col("url"), F.col("path_secrets")).alias("url"))


@query(
    "nested_depth",
    """SELECT event_id, CASE WHEN event_id % 30 < 20
         THEN repeat('{"a":', CAST(event_id % 30 AS INTEGER)) || '[1,"x"]' || repeat('}', CAST(event_id % 30 AS INTEGER))
         ELSE repeat('{"a":', 20) || '"[Max depth exceeded]"' || repeat('}', 20) END AS data
       FROM events WHERE event_id % 30 <> 19
       UNION ALL
       SELECT event_id, repeat('{"a":', 19) || '["[Max depth exceeded]","[Max depth exceeded]"]' || repeat('}', 19)
       FROM events WHERE event_id % 30 = 19""",
)
def nested_depth(spark, folder):
    e = inputs.load(spark, folder, "events", "event_id")
    n = (F.col("event_id") % 30).cast("int")
    nested = F.concat(F.repeat(F.lit('{"a":'), n), F.lit('[1,"x"]'), F.repeat(F.lit("}"), n))
    return e.select("event_id", F.to_json(redact.redact_variant(F.parse_json(nested))).alias("data"))


_DOC_JSON = inputs.json_bytes_sql("CAST(to_json(text) AS VARCHAR)")


@query(
    "json_size_report",
    f"""SELECT lang, count(*) AS docs, CAST(sum({_DOC_JSON}) AS BIGINT) AS json_bytes, max({_DOC_JSON}) AS largest
        FROM documents GROUP BY lang""",
)
def json_size_report(spark, folder):
    d = inputs.load(spark, folder, "documents", "doc_id")
    sized = d.select("lang", sizing.json_bytes(F.col("text")).alias("n"))
    return sized.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").alias("json_bytes"), F.max("n").alias("largest")
    )


@query(
    "float_sizes",
    """WITH t AS (SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_partkey || '.' || l_suppkey || l_orderkey || 'e' || (l_orderkey % 560 - 280) AS DOUBLE) AS v FROM lineitem),
          s AS (SELECT id, CAST(v AS VARCHAR) AS shown FROM t),
          p AS (SELECT id, regexp_extract(shown, '^([0-9]+)', 1) AS whole, regexp_extract(shown, '\.([0-9]+)', 1) AS rest,
                  coalesce(TRY_CAST(nullif(regexp_extract(shown, 'e([+-]?[0-9]+)', 1), '') AS INTEGER), 0) AS power FROM s),
          d AS (SELECT id, trim(whole || rest, '0') AS digits, length(whole) - (length(whole || rest) - length(ltrim(whole || rest, '0'))) + power AS p FROM p)
        SELECT id, CASE WHEN digits = '' THEN 1
            WHEN p < -3 OR p > 17 THEN greatest(length(digits), 2) + 3 + length(CAST(abs(p - 1) AS VARCHAR))
            WHEN p <= 0 THEN 2 - p + length(digits) WHEN length(digits) <= p THEN p ELSE length(digits) + 1 END AS bytes FROM d""",
)
def float_sizes(spark, folder):
    """Floats of all magnitudes as they are encoded."""
    rows = inputs.load(spark, folder, "lineitem", "l_orderkey")
    text = F.concat("l_partkey", F.lit("."), "l_suppkey", "l_orderkey", F.lit("e"), (F.col("l_orderkey") % 560 - 280).cast("string"))
    sized = sizing.json_bytes(text.cast("double"), T.DoubleType())
    return rows.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), sized.cast("int").alias("bytes"))


@query(
    "truncate_docs",
    """SELECT doc_id, md5(CASE WHEN length(text) > 5000 THEN substr(text, 1, 4985) || '... (truncated)' ELSE text END) AS trace_md5,
         least(length(text), 5000) AS trace_chars FROM documents""",
)
def truncate_docs(spark, folder):
    d = inputs.load(spark, folder, "documents")
    cut = d.select("doc_id", text.truncate_with_suffix(F.col("text"), C.MAX_ERROR_TRACE).alias("t"))
    return cut.select("doc_id", F.md5("t").alias("trace_md5"), F.length("t").alias("trace_chars"))


@query(
    "cap_context_bytes",
    f"""SELECT doc_id, {_DOC_JSON} + 8 AS json_bytes,
         CASE WHEN {_DOC_JSON} + 8 > 4000 THEN '{{"_truncated":"Context exceeded 50KB limit and was removed"}}'
              ELSE NULL END AS marker
       FROM documents""",
)
def cap_context_bytes(spark, folder):
    """Nested data over its byte limit is replaced whole (a lower limit, so that documents reach it)."""
    d = inputs.load(spark, folder, "documents", "doc_id")
    data = F.to_variant_object(F.struct(F.col("text").alias("doc")))
    sized = d.select("doc_id", F.to_json(data).alias("j"), sizing.cap_bytes(data, 4000, C.CONTEXT_REASON).alias("c"))
    shown = F.to_json("c")
    return sized.select(
        "doc_id",
        sizing.json_text_bytes(F.col("j")).alias("json_bytes"),
        F.when(F.startswith(shown, F.lit('{"_truncated"')), shown).alias("marker"),
    )
