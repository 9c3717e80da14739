"""Redaction of secrets in text, URLs, URL paths and nested data.

A key is sensitive when it contains one of the fragments, in any case.  All patterns run in time
linear in the text: a match starts only where a key starts, and what follows is possessive.
Where a rule has to guess, it redacts more, not less.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions.let import let

# Absolute, protocol-relative or relative; no white space and none of the characters that only
# prose, JSON and code hold; any query is a run of key=value pairs.
# White space is listed one by one: a class of single characters is one look at a table, a class with `\s` in it is a test of each.
_WHITE = r" \t\n\x0B\f\r"
_PAIR = rf"[^{_WHITE}\"'<>{{}}|\\^`=&?#]++=[^{_WHITE}\"'<>{{}}|\\^`&#]*+"
_PAIRS = rf"{_PAIR}(?:&{_PAIR})*+"
URL_SHAPE = (
    rf"^(?=[^{_WHITE}/?#]*+[/?#])(?:[A-Za-z][A-Za-z0-9+.\-]*+:)?+[^{_WHITE}\"'<>{{}}|\\^`\[\],;?#]*+"
    rf"(?:\?(?:{_PAIRS})?+)?+(?:#[^{_WHITE}\"'<>{{}}|\\^`]*+)?+\z"
)
QUERY_SHAPE = rf"^{_PAIRS}\z"
# scheme and authority | path | query | fragment
_URL_PARTS = r"(?s)^((?:[A-Za-z][A-Za-z0-9+.\-]*://|//)[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?\z"


def _alternatives(fragments) -> str:
    """The fragments as one piece of a pattern.  Most places in a text begin none: their first letters are asked for at once."""
    named = [f for f in fragments if f]
    if not named:
        return ""
    firsts = "".join(re.escape(c) for c in dict.fromkeys(f[0] for f in named))
    return rf"(?=[{firsts}])(?:{'|'.join(re.escape(f) for f in named)})"


def sensitive_key_pattern(fragments=C.SENSITIVE_FRAGMENTS) -> str:
    return f"(?i)(?:{_alternatives(fragments)})"


def text_pattern(fragments=C.SENSITIVE_FRAGMENTS) -> str:
    """Groups: 1 the key with its quotes and separator; the rest of the match is the value."""
    # The lookbehind lets a key be entered at its first character only, however long it is.
    key = rf"(?<![\w.\-])(?=[\w.\-]*?(?:{_alternatives(fragments)}))[\w.\-]*+"
    quoted = r"\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\"|'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    unclosed = r"[\"'][^\n]*+"
    scheme = r"(?:Bearer|Basic|Digest|Token)[ \t]++[^\s,;&\"']++"
    bare = r"[^\s,;&\"']++"
    return rf"(?i)({key}[\"']?\s*+[=:]\s*+)(?:{quoted}|{unclosed}|{scheme}|{bare})"


def redact_text(value: Column, fragments=C.SENSITIVE_FRAGMENTS, marker: str = C.REDACTED) -> Column:
    """`key=value`, `key: value` and `"key":"value"` lose their values."""
    pattern = text_pattern(fragments)
    # Most texts name no sensitive key at all; a plain search skips the costlier replace.
    key = sensitive_key_pattern(fragments)
    return let(value, lambda v: F.when(v.rlike(key), F.regexp_replace(v, pattern, f"$1{marker}")).otherwise(v))


def count_redactions(value: Column, fragments=C.SENSITIVE_FRAGMENTS) -> Column:
    return F.coalesce(F.regexp_count(value, F.lit(text_pattern(fragments))), F.lit(0))


def _redact_pairs(pairs: Column, fragments, marker: str) -> Column:
    pattern = rf"(?i)((?:^|[?#&])[^=&]*?(?:{_alternatives(fragments)})[^=&]*+=)[^&]*+"
    return F.regexp_replace(pairs, pattern, f"$1{marker}")


def redact_url(url: Column, fragments=C.SENSITIVE_FRAGMENTS, marker: str = C.REDACTED) -> Column:
    """Sensitive parameters of the query, and of a fragment shaped like one; nothing else moves."""

    named = rf"[^=&#]*?(?:{_alternatives(fragments)})[^=&#]*+="
    # From the first ? on, pair by pair: those before a sensitive one stay as they are.
    query = rf"(?i)((?:^[^?#]*+\?|\G(?!^)&)(?:(?!{named})[^&#]*+&)*+{named})[^&#]*+"

    def clean_fragment(u: Column) -> Column:
        fragment = F.regexp_extract(u, r"(?s)(#.*+)", 1)
        rest = let(
            fragment,
            lambda f: F.when(
                F.substr(f, F.lit(2)).rlike(QUERY_SHAPE), _redact_pairs(f, fragments, marker)
            ).otherwise(f),
        )
        return F.concat(F.substring_index(u, "#", 1), rest)

    def clean(u: Column) -> Column:
        rewritten = F.regexp_replace(u, query, f"$1{marker}")
        whole = let(rewritten, lambda r: F.when(F.contains(r, F.lit("#")), clean_fragment(r)).otherwise(r))
        return F.when(u.rlike(sensitive_key_pattern(fragments)), whole).otherwise(u)

    return let(url, clean)


def _redact_segments(path: Column, secrets: Column, marker: str) -> Column:
    return F.array_join(
        F.transform(
            F.split(path, "/", -1),
            lambda s: F.when((s != "") & F.array_contains(secrets, s), F.lit(marker)).otherwise(s),
        ),
        "/",
    )


def _secrets_column(secrets) -> Column | None:
    if secrets is None or isinstance(secrets, Column):
        return secrets
    return F.array(*[F.lit(s) for s in secrets]) if len(secrets) else None


def redact_url_path(url: Column, secrets, marker: str = C.REDACTED) -> Column:
    """Path segments, and segments of the fragment, that equal a declared secret.

    `secrets` is a list, or an array column holding the secrets of the row's own URL.
    """
    values = _secrets_column(secrets)
    if values is None:
        return url

    def route(fragment: Column) -> Column:
        path = F.regexp_extract(fragment, r"(?s)^([^?]*+)", 1)
        return let(
            path,
            lambda p: F.concat(
                F.lit("#"), _redact_segments(p, values, marker), F.substr(fragment, F.length(p) + 1)
            ),
        )

    def clean(u: Column) -> Column:
        origin, path, query, fragment = (F.regexp_extract(u, _URL_PARTS, i) for i in range(1, 5))
        clean_fragment = F.when(F.contains(u, F.lit("#")), route(F.substr(fragment, F.lit(2)))).otherwise(F.lit(""))
        rebuilt = F.concat(origin, _redact_segments(path, values, marker), query, clean_fragment)
        known = F.coalesce(F.size(values), F.lit(0)) > 0
        return F.when(known & u.isNotNull(), rebuilt).otherwise(u)

    return let(url, clean)


_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# A key with its colon, a string, a bracket, a comma, or another scalar.
_TOKEN = rf'({_STRING}:|{_STRING}|[\[\]{{}},]|[^\[\]{{}},"]++)'


def _container_pattern(depth: int) -> str:
    """A JSON object or array nested at most `depth` levels, as one linear-time pattern."""
    inside = rf'[^{{}}\[\]"]++|{_STRING}'
    pattern = rf"[\[{{](?:{inside})*+[\]}}]"
    for _ in range(depth - 1):
        pattern = rf"[\[{{](?:{inside}|{pattern})*+[\]}}]"
    return pattern


def too_deep(text: Column, max_depth: int = C.MAX_DEPTH) -> Column:
    """Whether JSON text nests `max_depth` containers or more.

    Few documents have that many brackets at all; of those, a match against everything that is
    nested less tells.
    """
    many = text.rlike(rf"\A(?:[^\[{{]*+[\[{{]){{{max(max_depth, 0)}}}")
    return many & ~text.rlike(rf"^{_container_pattern(max_depth - 1)}\z")


def sanitize_depth_json(text: Column, max_depth: int = C.MAX_DEPTH) -> Column:
    """Values at depth `max_depth` or deeper (the root has depth 0) become a marker.

    Only text that is nested so deeply is rewritten, token by token.
    """
    marker = F.lit(f'"{C.MAX_DEPTH_MARKER}"')

    def step(state: Column, token: Column) -> Column:
        opens, closes = token.isin("[", "{"), token.isin("]", "}")
        structure = closes | (token == ",") | token.rlike(r'^".*":\z')
        emitted = (
            F.when((state["depth"] < max_depth) | ((state["depth"] == max_depth) & structure), token)
            .when(state["depth"] == max_depth, marker)
            .otherwise("")
        )
        return F.struct(
            (state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"),
            F.concat(state["out"], emitted).alias("out"),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(1))
    rewritten = F.aggregate(tokens, start, step, lambda state: state["out"])
    return F.when(too_deep(text, max_depth), rewritten).otherwise(text)


def _redact_json_urls(text: Column, fragments, secrets: Column | None, marker: str) -> Column:
    """String values shaped like URLs.  Such a string holds neither quotes nor backslashes, so it
    is one whole piece of the text split at its quotes."""

    named = rf'(?i)[?#&][^"=&]*(?:{_alternatives(fragments)})[^"=&]*='

    def piece(pieces: Column):
        def clean(x: Column, i: Column) -> Column:
            # Few pieces hold a parameter or a secret at all; the rest is asked of those only.
            candidate = F.contains(x, F.lit("=")) & x.rlike(named)
            if secrets is not None:
                candidate = candidate | F.coalesce(F.exists(secrets, lambda s: F.contains(x, s)), F.lit(False))
            opened = ~F.coalesce(F.get(pieces, i - 1).rlike(r"(?<!\\)(?:\\\\)*+\\\z"), F.lit(False))
            is_key = F.startswith(F.coalesce(F.get(pieces, i + 1), F.lit("")), F.lit(":"))
            redacted = redact_url_path(redact_url(x, fragments, marker), secrets, marker)
            return F.when(candidate & x.rlike(URL_SHAPE) & opened & ~is_key, redacted).otherwise(x)

        return clean

    def rejoin(t: Column) -> Column:
        joined = F.array_join(let(F.split(t, '"', -1), lambda p: F.transform(p, piece(p))), '"')
        return joined if secrets is not None else F.when(t.rlike(named), joined).otherwise(t)

    return let(text, rejoin)


def _rewrite_json(text: Column, fragments, values: Column | None, max_depth: int, marker: str) -> Column:
    alternatives = _alternatives(fragments)
    # A key: a string that starts after { or , and ends before a colon.  The possessive run stops at the first fragment, or
    # at the closing quote, where no fragment can follow.
    fragment_ahead = rf'(?=(?:(?!{alternatives})(?:[^"\\]|\\.))*+(?:{alternatives}))'
    key = rf"(?<=[{{,])(?={_STRING}:)(\"{fragment_ahead}[^\"\\]*+(?:\\.[^\"\\]*+)*+\":)"
    value = rf"(?:{_STRING}|{_container_pattern(max_depth)}|[^,\]}}]++)"
    shallow = sanitize_depth_json(text, max_depth)
    keyed = F.regexp_replace(shallow, rf"(?i){key}{value}", f'$1"{marker}"')
    return _redact_json_urls(keyed, fragments, values, marker)


def _may_change(text: Column, fragments, values: Column | None, max_depth: int) -> Column:
    """Nested data changes only if its text names a fragment, holds a secret or is too deep."""
    suspect = text.rlike(sensitive_key_pattern(fragments))
    if values is not None:
        suspect = suspect | F.coalesce(F.exists(values, lambda s: F.contains(text, s)), F.lit(False))
    return suspect | too_deep(text, max_depth)


def redact_json(
    text: Column,
    fragments=C.SENSITIVE_FRAGMENTS,
    secrets=None,
    max_depth: int = C.MAX_DEPTH,
    marker: str = C.REDACTED,
) -> Column:
    """Nested data given as compact JSON text: sensitive keys lose their values whole, URL-shaped
    string values lose their secrets, and what is nested too deeply becomes a marker.

    One search tells whether a text can change at all; most rows end there.
    """
    values = _secrets_column(secrets)
    rewritten = _rewrite_json(text, fragments, values, max_depth, marker)
    return F.when(_may_change(text, fragments, values, max_depth), rewritten).otherwise(text)


def redact_variant(
    value: Column,
    fragments=C.SENSITIVE_FRAGMENTS,
    secrets=None,
    max_depth: int = C.MAX_DEPTH,
    marker: str = C.REDACTED,
) -> Column:
    """`redact_json` for a VARIANT column; rows that cannot change are not parsed again."""
    values = _secrets_column(secrets)

    def clean(text: Column) -> Column:
        rewritten = F.parse_json(_rewrite_json(text, fragments, values, max_depth, marker))
        return F.when(_may_change(text, fragments, values, max_depth), rewritten).otherwise(value)

    return let(F.to_json(value), clean)
