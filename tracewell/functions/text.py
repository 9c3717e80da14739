"""String rules: caps, path bounds, event names, trims and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions.let import let

EVENT_NAME = r"^[a-z][a-z0-9_]*\z"


def truncate_with_suffix(value: Column, limit: int, suffix: str = C.TRUNCATION_SUFFIX) -> Column:
    """At most `limit` characters, the suffix included."""

    def cut(v: Column) -> Column:
        return F.when(F.length(v) > limit, F.concat(F.substring(v, 1, limit - len(suffix)), F.lit(suffix))).otherwise(v)

    return let(value, cut)


def bound_file_path(path: Column, root: str | None = None, limit: int = C.MAX_FILE_PATH) -> Column:
    """Path below the project root; a path that is still too long keeps its tail."""
    if root:
        below = F.regexp_replace(F.substr(path, F.lit(len(root) + 1)), r"^[/\\]+", "")
        path = F.when(F.startswith(path, F.lit(root)), below).otherwise(path)
    return F.when(F.length(path) > limit, F.right(path, F.lit(limit))).otherwise(path)


def valid_event_name(name: Column) -> Column:
    return F.coalesce(F.length(name).between(3, 50) & name.rlike(EVENT_NAME), F.lit(False))


def standard_event(name: Column, names: tuple[str, ...] = C.STANDARD_EVENTS) -> Column:
    return F.coalesce(name.isin(*names), F.lit(False))


def trim_space(value: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.regexp_replace(value, r"^[\s\p{Z}]++|[\s\p{Z}]++$", "")


def rtrim_space(value: Column) -> Column:
    return F.regexp_replace(value, r"(?<![\s\p{Z}])[\s\p{Z}]++$", "")


def is_blank(value: Column) -> Column:
    """Null, or nothing but white space."""
    return value.isNull() | value.rlike(r"^[\s\p{Z}]*+$")


def iso_timestamp(ts: Column, offset: str = "+00:00") -> Column:
    """ISO-8601 with a numeric offset; `ts` is wall-clock time at that offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))


def is_date(text: Column) -> Column:
    """Whether a string is a date that exists, in one of these spellings: ISO-8601; `2024/1/31` and `2024.1.31`;
    `1/31/2024`; `31 January 2024`; `January 31, 2024` (month names cut to three letters, too).  A weekday may stand
    before it, a time and an offset, `GMT`, `UTC` or `Z` behind it, so RFC 2822 dates are among them.
    """
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:?\d{2}|Z)?)?\z")
    plain = F.regexp_replace(text, r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]{0,6}\.?,?\s+", "")
    tail = r"(?:[T ,]\s*(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?\s*((?i:GMT|UTC|Z)|[+-]\d{2}:?\d{2})?\z"
    named = r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]{0,6}\.?"
    spellings = (
        (r"^(\d{4})([/.])(\d{1,2})\2(\d{1,2})" + tail, 1, 3, 4, 5),
        (r"^(\d{1,2})/(\d{1,2})/(\d{4})" + tail, 3, 1, 2, 4),
        (rf"^(\d{{1,2}})[ -]{named}[ -](\d{{4}}){tail}", 3, 2, 1, 4),
        (rf"^{named} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}}){tail}", 3, 1, 2, 4),
    )
    months = F.array(*map(F.lit, "jan feb mar apr may jun jul aug sep oct nov dec".split()))

    def exists(pattern: str, year: int, month: int, day: int, time: int) -> Column:
        y, m, d, t, z = (F.regexp_extract(plain, pattern, i) for i in (year, month, day, time, time + 1))
        number = F.when(m.rlike(r"^\d"), m).otherwise(F.array_position(months, F.lower(m)).cast("string"))
        offset = F.when(z.rlike(r"(?i)^[a-z]"), "+00:00").otherwise(F.regexp_replace(z, r"^(.\d{2}):?(\d{2})", "$1:$2"))
        whole = F.concat(y, F.lit("-"), number, F.lit("-"), d, F.lit(" "), F.when(t == "", "00:00").otherwise(t), offset)
        return plain.rlike(pattern) & whole.try_cast("timestamp").isNotNull()

    spelled = F.lit(False)
    for spelling in spellings:
        spelled = spelled | F.coalesce(exists(*spelling), F.lit(False))
    return F.when(F.coalesce(iso, F.lit(False)), text.try_cast("timestamp").isNotNull()).otherwise(spelled)


def cut_utf8(value: Column, limit: int) -> Column:
    """The longest prefix of at most `limit` UTF-8 bytes that splits no character."""
    raw = value.cast("binary")

    def continues(position: int) -> Column:
        byte = F.hex(F.substring(raw, position, 1))
        return byte.between("80", "BF")

    keep = (
        F.when(~continues(limit + 1), limit)
        .when(~continues(limit), limit - 1)
        .when(~continues(limit - 1), limit - 2)
        .otherwise(limit - 3)
    )
    prefix = F.substr(raw, F.lit(1), keep).cast("string")
    return F.when(F.octet_length(value) > limit, prefix).otherwise(value)
