"""Request URLs, headers and origins read from a request context (`map<string,string>`)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions import redact, text
from tracewell.functions.let import let


def context_value(context: Column, key: str) -> Column:
    """A context value; an empty one counts as absent."""
    return F.nullif(F.try_element_at(context, F.lit(key)), F.lit(""))


def error_request_url(context: Column) -> Column:
    """URL of the request an error happened in.

    A host that is set but empty is an answer (the URI alone), and only the HTTPS flag decides
    the scheme.
    """
    host = F.coalesce(
        F.try_element_at(context, F.lit("HTTP_HOST")), F.try_element_at(context, F.lit("SERVER_NAME")), F.lit("")
    )
    uri = F.coalesce(F.try_element_at(context, F.lit("REQUEST_URI")), F.lit(""))
    https = context_value(context, "HTTPS")
    scheme = F.when(https.isNotNull() & (F.lower(https) != "off"), "https").otherwise("http")
    return F.nullif(F.when(host == "", uri).otherwise(F.concat(scheme, F.lit("://"), host, uri)), F.lit(""))


def event_request_url(context: Column, is_console: Column | None = None) -> Column:
    """URL of the request an event was recorded in.

    Empty values are absent; without a host there is no URL; the scheme is the HTTPS flag, else
    the declared scheme, else what the port says.
    """
    host = F.coalesce(context_value(context, "HTTP_HOST"), context_value(context, "SERVER_NAME"))
    https = context_value(context, "HTTPS")
    scheme = (
        F.when(https.isNotNull() & (F.lower(https) != "off"), F.lit("https"))
        .when(
            context_value(context, "REQUEST_SCHEME").isNotNull(),
            F.lower(context_value(context, "REQUEST_SCHEME")),
        )
        .when(context_value(context, "SERVER_PORT") == "443", F.lit("https"))
        .otherwise(F.lit("http"))
    )
    url = F.concat(
        scheme, F.lit("://"), host, F.coalesce(context_value(context, "REQUEST_URI"), F.lit("/"))
    )
    return url if is_console is None else F.when(F.coalesce(is_console, F.lit(False)), F.lit(None)).otherwise(url)


def request_headers(context: Column) -> Column:
    """Headers in context order as `array<struct<name, values>>`; null when there are none.

    Two context keys may name one header: it keeps its first place and its last value.
    """
    named = F.transform(
        F.map_entries(context),
        lambda e: F.struct(
            F.lower(
                F.replace(
                    F.when(F.startswith(e["key"], F.lit("HTTP_")), F.substr(e["key"], F.lit(6)))
                    .when(e["key"].isin("CONTENT_TYPE", "CONTENT_LENGTH"), e["key"])
                    .otherwise(""),
                    F.lit("_"),
                    F.lit("-"),
                )
            ).alias("name"),
            e["value"].alias("value"),
        ),
    )
    kept = F.filter(named, lambda h: (h["name"] != "") & h["value"].isNotNull())

    def first_place(headers: Column) -> Column:
        firsts = F.filter(headers, lambda h, i: F.array_position(headers["name"], h["name"]) == i + 1)
        return F.transform(
            firsts,
            lambda h: F.struct(
                h["name"].alias("name"),
                F.array(
                    F.element_at(F.filter(headers, lambda x: x["name"] == h["name"]), -1)["value"]
                ).alias("values"),
            ),
        )

    return let(let(kept, first_place), lambda headers: F.when(F.size(headers) > 0, headers))


def mask_headers(
    headers: Column,
    referer_secrets=None,
    fragments=C.SENSITIVE_FRAGMENTS,
    safe=C.SAFE_HEADERS,
    limit: int = C.MAX_HEADERS,
    value_limit: int = C.MAX_HEADER_VALUE,
) -> Column:
    """The first headers; one that is not known to be safe shows that it was sent, not its value."""

    def value(name: Column, v: Column) -> Column:
        v = F.coalesce(v, F.lit(""))
        scrubbed = redact.redact_url_path(redact.redact_url(v, fragments), referer_secrets)
        return text.truncate_with_suffix(F.when(name == "referer", scrubbed).otherwise(v), value_limit)

    masked = F.transform(
        F.slice(headers, 1, limit),
        lambda h: F.struct(
            h["name"].alias("name"),
            F.when(h["name"].isin(*safe), F.transform(h["values"], lambda v: value(h["name"], v)))
            .otherwise(F.array(F.lit(C.MASKED)))
            .alias("values"),
        ),
    )
    return F.when(F.size(headers) > 0, masked)


_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@\[\]\s]+)(?::(\d{1,5}))?(?:[/?#].*)?\z"


def normalize_origin(value: Column) -> Column:
    """`scheme://host[:port]` in lower case without a default port; null when it is no origin."""
    pattern = "(?s)" + _ORIGIN
    parts = F.struct(
        F.lower(F.regexp_extract(value, pattern, 1)).alias("scheme"),
        F.lower(F.regexp_extract(value, pattern, 2)).alias("host"),
        F.regexp_extract(value, pattern, 3).try_cast("int").alias("port"),
    )

    def shown(p: Column) -> Column:
        default = ((p["scheme"] == "http") & (p["port"] == 80)) | ((p["scheme"] == "https") & (p["port"] == 443))
        port = F.when(
            p["port"].isNotNull() & ~F.coalesce(default, F.lit(False)), F.concat(F.lit(":"), p["port"].cast("string"))
        ).otherwise("")
        origin = F.concat(p["scheme"], F.lit("://"), p["host"], port)
        return F.when((p["scheme"] != "") & F.coalesce(p["port"] <= 65535, F.lit(True)), origin)

    return let(parts, shown)


def authority_of(origin: Column) -> Column:
    return F.regexp_replace(origin, r"^[^:]*://", "")


def normalize_authority(host: Column) -> Column:
    """A Host header in lower case, trimmed, without port 80 or 443."""
    trimmed = F.lower(F.regexp_replace(text.trim_space(host), r"/++\z", ""))
    return F.regexp_replace(trimmed, r":\s*+0*+(?:80|443)\z", "")


def origin_allowed(context: Column, allowed: tuple[str, ...] | list[str] = ()) -> Column:
    """Same-origin rule of browser reports.

    The Origin, else the Referer; neither means allowed, one that is no origin means rejected.
    It must name the request's own host, or an allowlist entry: a full origin (then the scheme
    counts) or a bare authority.
    """
    asked = F.struct(
        F.coalesce(context_value(context, "HTTP_ORIGIN"), context_value(context, "HTTP_REFERER")).alias("source"),
        F.coalesce(context_value(context, "HTTP_HOST"), context_value(context, "SERVER_NAME")).alias("host"),
    )
    entries = [e for e in allowed if e]
    origins = F.array_compact(F.array(*[normalize_origin(F.lit(e)) for e in entries]).cast("array<string>"))
    authorities = F.array_compact(
        F.array(
            *[F.when(normalize_origin(F.lit(e)).isNull(), normalize_authority(F.lit(e))) for e in entries]
        ).cast("array<string>")
    )

    def judge(source: Column, host: Column, origin: Column) -> Column:
        accepted = normalize_authority(host) == authority_of(origin)
        accepted = F.coalesce(accepted, F.lit(False))
        if entries:
            accepted = accepted | F.array_contains(origins, origin) | F.array_contains(authorities, authority_of(origin))
        return F.when(source.isNull(), F.lit(True)).when(origin.isNull(), F.lit(False)).otherwise(accepted)

    return let(asked, lambda a: let(normalize_origin(a["source"]), lambda origin: judge(a["source"], a["host"], origin)))
