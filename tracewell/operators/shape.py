"""Raw records to items: fixed field sets, redacted before they are cut.

Each function is one projection (or one join with a table the reference asks through a callback).
Columns named in `keep` travel along unchanged, so that later steps still know the record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions import hashing, redact, rules, sizing, text, url
from tracewell.functions.let import let


def _keep(df: DataFrame, keep, fields: list[Column]) -> DataFrame:
    return df.select(*[F.col(k) for k in keep], *fields)


def empty_object() -> Column:
    return F.parse_json(F.lit("{}"))


#: A caller's own rule for free text: a string column in, a string column out.
Redactor = Callable[[Column], Column]


def _clean(value: Column, fragments, redactor: Redactor | None) -> Column:
    redacted = redact.redact_text(value, fragments)
    return redactor(redacted) if redactor else redacted


def _free_shape(value: Column, secrets, fragments) -> Column:
    """Nested data as it may leave the host; anything but a list or an object becomes empty."""
    nested = rules.variant_kind(value) == "array"
    return F.when(nested, redact.redact_variant(value, fragments, secrets)).otherwise(empty_object())


# --- events -----------------------------------------------------------------------------------


def shape_visits(df: DataFrame, salt: str, keep=()) -> DataFrame:
    """What daily activity needs of raw events, from `ts, request` alone: the time and the visitor."""
    agent = url.context_value(F.col("request"), "HTTP_USER_AGENT")
    address = url.context_value(F.col("request"), "REMOTE_ADDR")
    visitor = hashing.session_hash(address, agent, F.col("ts"), salt)
    return df.select(*keep, text.iso_timestamp(F.col("ts")).alias("timestamp"), visitor.alias("session_id_hash"))


def shape_events(
    df: DataFrame,
    salt: str,
    keep=(),
    secrets=None,
    fragments=C.SENSITIVE_FRAGMENTS,
) -> DataFrame:
    """Raw `name, properties, user_id, ts, request, is_console` to the seven event fields."""
    agent = url.context_value(F.col("request"), "HTTP_USER_AGENT")
    address = url.context_value(F.col("request"), "REMOTE_ADDR")
    full_url = url.event_request_url(F.col("request"), F.col("is_console"))
    return _keep(
        df,
        keep,
        [
            F.col("name").alias("event_name"),
            text.iso_timestamp(F.col("ts")).alias("timestamp"),
            _free_shape(F.col("properties"), secrets, fragments).alias("properties"),
            F.when(F.col("user_id").isNotNull(), F.struct(F.col("user_id").cast("string").alias("id"))).alias("user"),
            redact.redact_url_path(redact.redact_url(full_url, fragments), secrets).alias("url"),
            hashing.user_agent_hash(agent, salt).alias("user_agent_hash"),
            hashing.session_hash(address, agent, F.col("ts"), salt).alias("session_id_hash"),
        ],
    )


# --- logs -------------------------------------------------------------------------------------


def log_extra(
    extra: Column,
    environment: Column,
    runtime_version: Column,
    framework: Column | None = None,
    framework_version: Column | None = None,
    limit: int = C.MAX_LOG_EXTRA_BYTES,
) -> Column:
    """The record's own extra, capped, then the environment vocabulary, which wins."""
    own = sizing.cap_bytes(extra, limit, C.EXTRA_REASON).try_cast("map<string,variant>")
    pairs = [
        ("environment", F.coalesce(environment, F.lit("")), None),
        ("php_version", F.coalesce(runtime_version, F.lit("")), None),
    ]
    for key, value in (("framework", framework), ("framework_version", framework_version)):
        if value is not None:
            pairs.append((key, value, F.coalesce(value != "", F.lit(False))))
    stated = F.map_from_entries(
        F.array_compact(
            F.array(
                *[
                    F.when(F.lit(True) if present is None else present, F.struct(F.lit(k), v.cast("variant")))
                    for k, v, present in pairs
                ]
            )
        )
    )
    kept = F.map_filter(
        F.coalesce(own, F.create_map().cast("map<string,variant>")),
        lambda k, _: ~F.array_contains(F.map_keys(stated), k),
    )
    return F.to_variant_object(F.map_concat(kept, stated))


def shape_logs(
    df: DataFrame,
    keep=(),
    environment: str = "production",
    runtime_version: str = "",
    framework: str | None = None,
    framework_version: str | None = None,
    secrets=None,
    fragments=C.SENSITIVE_FRAGMENTS,
    redactor: Redactor | None = None,
) -> DataFrame:
    """Raw `level, message, context, channel, ts, extra` to the six log fields; `redactor` goes over free text last."""
    context = _free_shape(F.col("context"), secrets, fragments)
    extra = _free_shape(F.col("extra"), secrets, fragments)
    return _keep(
        df,
        keep,
        [
            F.lower("level").alias("level"),
            text.truncate_with_suffix(_clean(F.col("message"), fragments, redactor), C.MAX_LOG_MESSAGE).alias(
                "message"
            ),
            sizing.cap_bytes(context, C.MAX_LOG_CONTEXT_BYTES, C.CONTEXT_REASON).alias("context"),
            F.col("channel"),
            text.iso_timestamp(F.col("ts")).alias("timestamp"),
            log_extra(
                extra,
                F.lit(environment),
                F.lit(runtime_version),
                F.lit(framework) if framework else None,
                F.lit(framework_version) if framework_version else None,
            ).alias("extra"),
        ],
    )


# --- errors -----------------------------------------------------------------------------------


def console_command(argv: Column, fragments=C.SENSITIVE_FRAGMENTS) -> Column:
    """The command line, scrubbed; the contract's limit on it is not applied here."""
    present = F.filter(argv, lambda a: a.isNotNull())
    return F.when(F.size(present) > 0, redact.redact_text(F.array_join(present, " "), fragments))


def console_arguments(
    argv: Column, fragments=C.SENSITIVE_FRAGMENTS, count: int = C.MAX_ARGV, limit: int = C.MAX_ARGV_VALUE
) -> Column:
    present = F.slice(F.filter(argv, lambda a: a.isNotNull()), 1, count)
    return F.transform(present, lambda a: text.truncate_with_suffix(redact.redact_text(a, fragments), limit))


def shape_errors(
    df: DataFrame,
    keep=(),
    project_root: str | None = None,
    runtime_version: str = "",
    framework: str | None = None,
    framework_version: str | None = None,
    secrets=None,
    referer_secrets=None,
    fragments=C.SENSITIVE_FRAGMENTS,
    redactor: Redactor | None = None,
) -> DataFrame:
    """Raw errors to the nineteen error fields, all always present; `redactor` goes over free text last.

    Reads `message, file, line, type, environment, trace, request, argv, is_console, ts`, and
    where given `context, highlight_line` (from `source_preview`) and `user` (from `attach_user`).
    """
    console = F.coalesce(F.col("is_console"), F.lit(False))

    def given(name: str, dtype: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(dtype)

    def on_web(value: Column) -> Column:
        return F.when(~console, value)

    def on_console(value: Column) -> Column:
        return F.when(console, value)

    request = F.col("request")
    full_url = redact.redact_url_path(
        redact.redact_url(url.error_request_url(request), fragments), secrets
    )
    return _keep(
        df,
        keep,
        [
            text.truncate_with_suffix(_clean(F.col("message"), fragments, redactor), C.MAX_ERROR_MESSAGE).alias(
                "message"
            ),
            text.bound_file_path(F.col("file"), project_root).alias("file"),
            F.col("line").cast("bigint").alias("line"),
            F.col("type"),
            F.col("environment"),
            text.truncate_with_suffix(_clean(F.col("trace"), fragments, redactor), C.MAX_ERROR_TRACE).alias("trace"),
            on_web(url.mask_headers(url.request_headers(request), referer_secrets, fragments)).alias("headers"),
            given("context", "string").alias("context"),
            given("highlight_line", "bigint").cast("bigint").alias("highlight_line"),
            given("user", "struct<id:string,email:string>").alias("user"),
            text.iso_timestamp(F.col("ts")).alias("timestamp"),
            on_web(text.truncate_with_suffix(full_url, C.MAX_URL)).alias("url"),
            on_web(F.upper(url.context_value(request, "REQUEST_METHOD"))).alias("method"),
            F.lit(runtime_version).alias("php_version"),
            F.lit(framework or None).cast("string").alias("framework"),
            F.lit(framework_version or None).cast("string").alias("framework_version"),
            console.alias("is_console"),
            on_console(console_command(F.col("argv"), fragments)).alias("console_command"),
            on_console(console_arguments(F.col("argv"), fragments)).alias("console_arguments"),
        ],
    )


def preview_window(content: Column, line: Column, lines: Column | None = None) -> tuple[Column, Column]:
    """Eleven lines around a line, dedented, and the line's place among them.

    `content` is a whole file.  Every line but the last ends in a newline that stays with it.
    `lines` is the content split at its newlines, where that has been done already.
    """
    start = F.greatest(F.lit(0), line.cast("int") - C.PREVIEW_LINES_BEFORE - 1)
    lines = F.split(content, "\n", -1) if lines is None else lines
    total = F.size(lines) - F.when(F.endswith(content, F.lit("\n")) | (content == ""), 1).otherwise(0)
    end = F.least(total, start + C.PREVIEW_LINES)
    window = F.slice(lines, start + 1, F.greatest(end - start, F.lit(0)))

    def tidy(code: Column) -> Column:
        long = F.length(code) > C.MAX_PREVIEW_LINE
        cut = F.concat(F.substring(code, 1, C.MAX_PREVIEW_LINE), F.lit(C.TRUNCATION_SUFFIX))
        return text.rtrim_space(F.when(long, cut).otherwise(code))

    def dedent(codes: Column) -> Column:
        filled = F.filter(codes, lambda c: c != "")
        indents = F.transform(filled, lambda c: F.length(F.regexp_extract(c, r"^([\s\p{Z}]*+)", 1)))
        shared = F.coalesce(F.array_min(indents), F.lit(0))
        shifted = F.transform(codes, lambda c: F.when(c != "", F.substr(c, shared + 1)).otherwise(c))
        return F.array_join(shifted, "\n")

    joined = F.get(F.transform(F.array(F.transform(window, tidy)), dedent), F.lit(0))
    # The newline after the last line of the window stays when the file goes on or ends in one.
    ended = (end > start) & ((end < F.size(lines)) & (end > 0))
    return F.concat(joined, F.when(ended, "\n").otherwise("")), (line - start).cast("bigint")


def source_preview(errors: DataFrame, source_files: DataFrame, path: str = "file", line: str = "line") -> DataFrame:
    """Adds `context` and `highlight_line` from a `source_files(path, text)` table.

    The lines that errors name are gathered per file and the file is split once for all of them,
    so a file that many errors point at is neither joined nor split once per error or line.  A file
    has fewer lines than bytes: lines beyond that look alike and count as one.
    """
    beyond = C.MAX_SOURCE_FILE_BYTES + C.PREVIEW_LINES_BEFORE + 1
    spot = F.least(F.col(line).cast("bigint"), F.lit(beyond))
    spots = (
        errors.select(F.col(path).alias("_path"), spot.alias("_line"))
        .where(F.col("_path").isNotNull() & F.col("_line").isNotNull())
        .groupBy("_path")
        .agg(F.collect_set("_line").alias("_named"))
    )
    files = (
        source_files.select(F.col("path").alias("_path"), F.col("text").alias("_text"))
        .where((F.col("_path") != "") & (F.octet_length("text") < C.MAX_SOURCE_FILE_BYTES))
        .join(spots.select("_path"), "_path", "left_semi")
        .groupBy("_path")
        .agg(F.min("_text").alias("_text"))  # a path that is there twice would double its errors
    )

    def seen(named: Column) -> Column:
        context, highlight = preview_window(F.col("_text"), named, F.col("_lines"))
        return F.struct(named.alias("_line"), context.alias("context"), highlight.alias("highlight_line"))

    previews = (
        spots.join(files, "_path")
        .withColumn("_lines", F.split("_text", "\n", -1))
        .select("_path", F.explode(F.transform("_named", seen)).alias("_seen"))
        .select("_path", "_seen.*")
    )
    same = (F.col(path) == F.col("_path")) & (spot == F.col("_line"))
    return errors.join(previews, same, "left").drop("_path", "_line")


def normalize_framework(df: DataFrame) -> DataFrame:
    """The legacy version column becomes the framework pair; an explicit pair wins."""
    for legacy, framework in C.LEGACY_FRAMEWORK.items():
        if legacy not in df.columns:
            continue
        old = F.nullif(F.col(legacy), F.lit(""))
        implied = F.when(old.isNotNull() & F.col("framework").isNull() & F.col("framework_version").isNull(), old)
        df = df.withColumns(
            {
                "framework": F.when(implied.isNotNull(), F.lit(framework)).otherwise(F.col("framework")),
                "framework_version": F.coalesce(implied, F.col("framework_version")),
            }
        ).drop(legacy)
    return df


# --- browser errors ---------------------------------------------------------------------------


_member = rules.variant_field


def _string_member(value: Column, name: str) -> Column:
    """A member that is a string; any other kind counts as absent."""
    return let(
        _member(value, name), lambda m: F.when(rules.variant_kind(m) == "string", m.try_cast("string"))
    )


def _scalar_member(value: Column, name: str) -> Column:
    """A scalar member as the text it prints as, booleans as 1 and nothing."""

    def shown(m: Column) -> Column:
        kind = m["k"]
        return (
            F.when(kind == "boolean", F.when(m["v"].try_cast("boolean"), "1").otherwise(""))
            .when(kind == "array", F.lit(None))
            .otherwise(m["v"].try_cast("string"))
        )

    member = _member(value, name)
    return let(F.struct(member.alias("v"), rules.variant_kind(member).alias("k")), shown)


NUMERIC = r"^[ \t\n\r\x0B\f]*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?[ \t\n\r\x0B\f]*\z"


def _int_member(value: Column, name: str) -> Column:
    """A number, or a numeric string, cut to an integer; booleans do not count."""

    def whole(m: Column) -> Column:
        trimmed = F.regexp_replace(m["t"], r"[ \t\n\r\x0B\f]+", "")
        number = F.coalesce(trimmed.try_cast("bigint"), trimmed.try_cast("double").try_cast("bigint"))
        return F.when((m["k"] != "boolean") & m["t"].rlike(NUMERIC), number)

    member = _member(value, name)
    return let(F.struct(member.try_cast("string").alias("t"), rules.variant_kind(member).alias("k")), whole)


def browser_info(value: Column) -> Column:
    """Exactly the seven known keys, absent ones null."""
    return F.to_variant_object(F.struct(*[_member(value, k).alias(k) for k in C.BROWSER_INFO_KEYS]))


def last_breadcrumbs(
    crumbs: Column,
    n: int = C.MAX_BREADCRUMBS,
    data_limit: int = C.MAX_BREADCRUMB_DATA_BYTES,
    secrets=None,
    fragments=C.SENSITIVE_FRAGMENTS,
) -> Column:
    """The last `n` breadcrumbs of a VARIANT list, each rebuilt as its four fields."""
    empty = F.array().cast("array<struct<timestamp:string,category:string,message:string,data:variant>>")
    if n <= 0:
        return empty
    listed = F.coalesce(
        crumbs.try_cast("array<variant>"), F.map_values(crumbs.try_cast("map<string,variant>"))
    )
    size = F.size(listed)
    kept = F.slice(listed, F.greatest(size - n, F.lit(0)) + 1, n)

    def rebuild(crumb: Column) -> Column:
        data = _free_shape(_member(crumb, "data"), secrets, fragments)
        return F.struct(
            _scalar_member(crumb, "timestamp").alias("timestamp"),
            _scalar_member(crumb, "category").alias("category"),
            _scalar_member(crumb, "message").alias("message"),
            sizing.cap_bytes(data, data_limit, C.BREADCRUMB_REASON).alias("data"),
        )

    return F.coalesce(F.transform(kept, rebuild), empty)


def shape_js_errors(
    df: DataFrame,
    salt: str,
    keep=(),
    environment: str = "production",
    max_breadcrumbs: int = C.MAX_BREADCRUMBS,
    secrets=None,
    fragments=C.SENSITIVE_FRAGMENTS,
) -> DataFrame:
    """Raw `payload` (VARIANT), `request`, `user_id`, `session_id`, `received_at` to fifteen fields.

    The item is rebuilt: unknown keys go, and what the server knows is never read from the payload.
    """
    payload = F.col("payload")
    stamp = _string_member(payload, "timestamp")
    context = _free_shape(_member(payload, "context"), secrets, fragments)
    page = F.coalesce(_scalar_member(payload, "url"), F.lit(""))
    return _keep(
        df,
        keep,
        [
            redact.redact_text(F.coalesce(_scalar_member(payload, "message"), F.lit("")), fragments).alias("message"),
            redact.redact_text(_string_member(payload, "stack"), fragments).alias("stack"),
            F.coalesce(_string_member(payload, "type"), F.lit("Error")).alias("type"),
            _string_member(payload, "filename").alias("filename"),
            _int_member(payload, "line").alias("line"),
            _int_member(payload, "column").alias("column"),
            url.context_value(F.col("request"), "HTTP_USER_AGENT").alias("user_agent"),
            redact.redact_url_path(redact.redact_url(page, fragments), secrets).alias("url"),
            F.when(text.is_blank(stamp), text.iso_timestamp(F.col("received_at"))).otherwise(stamp).alias("timestamp"),
            F.lit(environment).alias("environment"),
            F.col("user_id").cast("string").alias("user_id"),
            hashing.visit_hash(F.col("session_id"), salt).alias("session_id"),
            last_breadcrumbs(_member(payload, "breadcrumbs"), max_breadcrumbs, secrets=secrets, fragments=fragments).alias(
                "breadcrumbs"
            ),
            sizing.cap_bytes(context, C.MAX_JS_CONTEXT_BYTES, C.CONTEXT_REASON).alias("context"),
            browser_info(_member(payload, "browser_info")).alias("browser_info"),
        ],
    )


def error_signal_defaults(df: DataFrame) -> DataFrame:
    """Browser signals to reports.

    `source` is error, rejection, console or manual; `reason_kind` tells whether a rejection's
    reason was an error, a string, an object or nothing; missing parts get their defaults.
    """
    source, kind = F.col("source"), F.col("reason_kind")

    def filled(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    own = filled("message")
    message = (
        F.when(source == "error", F.coalesce(own, F.lit("Unknown error")))
        .when(
            source == "rejection",
            F.when(kind == "string", F.coalesce(F.col("message"), F.lit("")))
            .when(kind.isin("error", "object"), F.coalesce(own, F.lit("Unhandled Promise Rejection")))
            .otherwise(F.lit("Unhandled Promise Rejection")),
        )
        .when(source == "console", F.concat(F.lit("Console Error: "), F.coalesce(F.col("message"), F.lit(""))))
        .otherwise(F.coalesce(F.col("message"), F.lit("")))
    )
    named = filled("type")
    kind_name = (
        F.when(source == "error", F.coalesce(named, F.lit("Error")))
        .when(
            source == "rejection",
            F.when(kind == "error", F.coalesce(named, F.lit("UnhandledRejection"))).otherwise(F.lit("UnhandledRejection")),
        )
        .when(source == "console", F.lit("ConsoleError"))
        .otherwise(F.coalesce(named, F.lit("ManualError")))
    )
    has_stack = (source != "rejection") | F.coalesce(kind == "error", F.lit(False))
    is_error = source == "error"
    return df.withColumns(
        {
            "message": message,
            "type": kind_name,
            "stack": F.when(has_stack, F.coalesce(F.col("stack"), F.lit(""))).otherwise(F.lit("")),
            "filename": F.when(is_error, F.coalesce(F.col("filename"), F.lit(""))).otherwise(F.lit("")),
            "line": F.when(is_error, F.coalesce(F.col("line"), F.lit(0))).otherwise(F.lit(0)).cast("bigint"),
            "column": F.when(is_error, F.coalesce(F.col("column"), F.lit(0))).otherwise(F.lit(0)).cast("bigint"),
        }
    )


def attach_user(
    df: DataFrame,
    users: DataFrame | None,
    on: str = "resolver_key",
    explicit: str | None = "user_id",
    email_opt_in: bool = False,
    with_email: bool = True,
) -> DataFrame:
    """Adds `user`: an explicit id wins, else the row of `users(key, id, email)`, else null."""
    id_type = "struct<id:string,email:string>" if with_email else "struct<id:string>"
    resolved_id: Column = F.lit(None).cast("string")
    resolved_email: Column = F.lit(None).cast("string")
    if users is not None:
        # One row per key, or a key that is there twice would double its records.
        row = F.min(F.struct(F.col("id").cast("string").alias("id"), F.col("email").alias("email"))).alias("_u")
        side = users.groupBy(F.col("key").alias("_key")).agg(row).select("_key", F.col("_u.id").alias("_id"), F.col("_u.email").alias("_email"))
        df = df.join(side, df[on] == side["_key"], "left")
        resolved_id, resolved_email = F.col("_id"), F.col("_email")
    given = F.col(explicit).cast("string") if explicit else F.lit(None).cast("string")
    chosen = F.coalesce(given, resolved_id)
    fields = [chosen.alias("id")]
    if with_email:
        shown = F.when(given.isNull(), resolved_email) if email_opt_in else F.lit(None).cast("string")
        fields.append(shown.alias("email"))
    out = df.withColumn("user", F.when(chosen.isNotNull(), F.struct(*fields)).cast(id_type))
    return out.drop("_key", "_id", "_email")


MOST_ROUTES = 10_000  # that may be broadcast, and shapes of routes


def attach_path_secrets(df: DataFrame, routes: DataFrame, url_column: str = "url", out: str = "path_secrets") -> DataFrame:
    """Adds the secret path segments of each row's URL, from `routes(pattern, secret_params)`.

    A pattern is a path such as `/reset/{token}`.  Up to `MOST_ROUTES` routes are grouped by what a URL must
    have to match, the number of segments and the first literal one, or, after a leading parameter, the
    second, and are broadcast.  More routes are looked up by their shapes, see `_by_shape`.
    """
    if routes.limit(MOST_ROUTES + 1).count() > MOST_ROUTES:
        return _by_shape(df, routes, url_column, out)
    cut = F.split(F.regexp_replace("pattern", r"^/|/$", ""), "/", -1)

    def literal(i: int) -> Column:
        part = F.get(F.col("parts"), F.lit(i))
        return F.when(~F.startswith(part, F.lit("{")), part)

    grouped = (
        routes.select(cut.alias("parts"), "secret_params")
        .select(
            F.size("parts").alias("_n"), literal(0).alias("_first"),
            F.when(literal(0).isNull(), literal(1)).alias("_second"), F.struct("parts", "secret_params").alias("route"),
        )
        .groupBy("_n", "_first", "_second")
        .agg(F.collect_list("route").alias("_routes"))
    )
    rows = df.withColumn("_segments", F.split(_bare_path(url_column), "/", -1)).withColumns(
        {"_n": F.size("_segments"), "_first": F.get("_segments", F.lit(0)), "_second": F.get("_segments", F.lit(1))}
    )
    by_first = grouped.where("_first IS NOT NULL").select("_n", "_first", F.col("_routes").alias("_by_first"))
    by_second = grouped.where("_second IS NOT NULL").select("_n", "_second", F.col("_routes").alias("_by_second"))
    general = grouped.where("_first IS NULL AND _second IS NULL").select("_n", F.col("_routes").alias("_general"))
    by_first, by_second, general = map(F.broadcast, (by_first, by_second, general))
    joined = rows.join(by_first, ["_n", "_first"], "left").join(by_second, ["_n", "_second"], "left").join(general, "_n", "left")
    none = F.array().cast("array<struct<parts:array<string>,secret_params:array<string>>>")
    candidates = F.concat(*(F.coalesce(c, none) for c in ("_by_first", "_by_second", "_general")))

    def is_param(part: Column) -> Column:
        return F.startswith(part, F.lit("{"))

    def matches(route: Column) -> Column:
        pairs = F.arrays_zip(route["parts"].alias("p"), F.col("_segments").alias("s"))
        return F.forall(pairs, lambda z: F.when(is_param(z["p"]), z["s"] != "").otherwise(z["p"] == z["s"]))

    def found(route: Column) -> Column:
        pairs = F.arrays_zip(route["parts"].alias("p"), F.col("_segments").alias("s"))
        secret = F.filter(
            pairs,
            lambda z: is_param(z["p"]) & F.array_contains(route["secret_params"], F.regexp_replace(z["p"], r"[{}]", "")),
        )
        return F.transform(secret, lambda z: z["s"])

    secrets = F.array_distinct(F.flatten(F.transform(F.filter(candidates, matches), found)))
    return joined.withColumn(out, secrets).drop("_segments", "_n", "_first", "_second", "_by_first", "_by_second", "_general")


def _bare_path(url_column: str) -> Column:
    """The path of a URL without the slashes at its ends."""
    origin_free = F.regexp_replace(url_column, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://|//)[^/?#]*", "")
    return F.regexp_replace(F.regexp_extract(origin_free, r"^([^?#]*)", 1), r"^/|/$", "")


def _by_shape(df: DataFrame, routes: DataFrame, url_column: str, out: str) -> DataFrame:
    """`attach_path_secrets` for any number of routes, by one equality join.

    The shape of a route says which of its segments are parameters.  Routes of a shape that have the same literals are one
    row, so a path meets at most one row per shape of its length; there are few shapes, however many routes.
    Each path is looked up once, whatever the number of rows that have it.
    """

    def is_param(part: Column) -> Column:
        return F.startswith(part, F.lit("{"))

    def secret(part: Column) -> Column:
        return is_param(part) & F.array_contains("secret_params", F.regexp_replace(part, r"[{}]", ""))

    parts = F.split(F.regexp_replace("pattern", r"^/|/$", ""), "/", -1)
    shaped = routes.select(parts.alias("parts"), "secret_params").select(
        F.size("parts").alias("_n"),
        F.array_join(F.transform("parts", lambda p: F.when(is_param(p), "1").otherwise("0")), "").alias("_shape"),
        F.array_join(F.transform("parts", lambda p: F.when(is_param(p), "").otherwise(p)), "/").alias("_literals"),
        F.array_compact(F.transform("parts", lambda p, i: F.when(secret(p), i))).alias("_places"),
    )
    telling = shaped.where(F.size("_places") > 0).groupBy("_n", "_shape", "_literals").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_places")))).alias("_places")  # at most one per segment
    )
    shapes = telling.select("_n", "_shape").distinct()
    if shapes.limit(MOST_ROUTES + 1).count() <= MOST_ROUTES:
        shapes = F.broadcast(shapes)
    paths = df.select(_bare_path(url_column).alias("_path")).where("_path IS NOT NULL").distinct()
    cut = paths.withColumn("_segments", F.split("_path", "/", -1)).withColumn("_n", F.size("_segments"))

    def given(i: Column) -> Column:
        return F.substring("_shape", i + 1, F.lit(1)) == "1"

    tried = cut.join(shapes, "_n").withColumn(
        "_literals", F.array_join(F.transform("_segments", lambda s, i: F.when(given(i), "").otherwise(s)), "/")
    )
    # A parameter is never empty.
    tried = tried.where(~F.exists(F.transform("_segments", lambda s, i: given(i) & (s == "")), lambda e: e))
    found = tried.join(telling, ["_n", "_shape", "_literals"]).select(
        "_path", F.transform("_places", lambda i: F.get("_segments", i)).alias("_found")
    )
    by_path = found.groupBy("_path").agg(F.array_distinct(F.flatten(F.collect_list("_found"))).alias(out))
    joined = df.withColumn("_path", _bare_path(url_column)).join(by_path, "_path", "left").drop("_path")
    return joined.withColumn(out, F.coalesce(out, F.array().cast("array<string>"))).select(*df.columns, out)
