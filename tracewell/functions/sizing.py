"""Byte sizes of values as JSON, and the caps built on them.

Sizes are those of an ASCII-only JSON encoding: `/` takes two bytes, a character outside ASCII
six (twelve outside the basic plane), and a float prints the fewest digits that give it back, see `float_bytes`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.functions.let import let

_JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_FLOAT = r"-?\d++(?:\.\d++(?:[eE][+-]?\d++)?|[eE][+-]?\d++)"
# Runs of characters of one byte each, but no digits that a float may begin with.
_ONE_BYTE = r"[\x00-\x2E\x3A-\x7F]+|\d++(?!\.\d|[eE][+-]?\d)"
# Floats of at most 15 digits, which the encoder prints as they are; whole ones, which it prints without the point and the zero.
_SHORT_FLOAT = r"\A-?(?=[\d.]{3,16}\z)(?:[1-9]\d*+|0(?=\.0{0,3}[1-9]))\.\d*[1-9]\z"
_WHOLE_FLOAT = r"\A-?(?:0|[1-9]\d{0,14})\.0\z"
# Where the point may stand before a float is printed with an exponent: after this many digits, or behind this many zeros.
MOST_DIGITS, MOST_ZEROS = 17, 3


def json_text(value: Column, dtype: T.DataType | None = None) -> Column:
    """JSON text with null fields kept; a plain string renders as a quoted JSON string."""
    options = {"ignoreNullFields": "false"}
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value, options)
    wrapped = F.to_json(F.struct(value.alias("v")), options)
    return let(wrapped, lambda w: F.substr(w, F.lit(6), F.length(w) - 6))


def float_bytes(token: Column) -> Column:
    """Length of a decimal number as the encoder prints the float next to it.

    It prints the fewest digits that read back as the same float.  With them, the number is 0.d1d2… times ten to
    some power p: up to `MOST_DIGITS` and down to minus `MOST_ZEROS` that is written out (`0.00012`, `1200`), beyond
    as `1.0e+25`, with at least one digit behind the point and no zeros before the exponent's.
    """

    def measure(v: Column) -> Column:
        shown = _digits(F.abs(v).cast("string"))
        return let(shown, lambda d: _shorter(v, d, lambda e: _shorter(v, e, written)))

    def written(d: Column) -> Column:
        n, p = F.length(d["digits"]), d["p"]
        power = p - 1
        long = F.greatest(n, F.lit(2)) + 3 + F.length(F.abs(power).cast("string"))
        plain = F.when(p <= 0, 2 - p + n).when(n <= p, p).otherwise(n + 1)
        return F.when(n == 0, 1).when((p < -MOST_ZEROS) | (p > MOST_DIGITS), long).otherwise(plain)

    value = token.try_cast("double")
    length = let(value, measure) + F.startswith(token, F.lit("-")).cast("int")
    return F.when(F.isnan(value) | F.abs(value).isin(float("inf")), F.length(token)).otherwise(F.coalesce(length, F.length(token)))


def _digits(shown: Column) -> Column:
    """`digits` without zeros on either side, and `p`, of a number as Java shows it."""

    def split(t: Column) -> Column:
        whole, rest = F.regexp_extract(t, r"^\d+", 0), F.regexp_extract(t, r"\.(\d+)", 1)
        every = F.concat(whole, rest)
        zeros = F.length(F.regexp_extract(every, "^0*", 0))
        power = F.coalesce(F.regexp_extract(t, r"E(-?\d+)", 1).try_cast("int"), F.lit(0))
        return F.struct(F.regexp_replace(every, "^0+|0+$", "").alias("digits"), (F.length(whole) - zeros + power).alias("p"))

    return let(shown, split)


def _shorter(value: Column, d: Column, then) -> Column:
    """`then` of the digits, or of one less where they still read back as `value`: Java may show one too many."""

    def rounded(shown: Column) -> Column:
        up = (shown["digits"].try_cast("bigint") + 5).cast("string")
        fewer = F.substr(up, F.lit(1), F.length(up) - 1)
        carried = F.length(up) - F.length(shown["digits"])
        return F.struct(F.regexp_replace(fewer, "0+$", "").alias("digits"), (shown["p"] + carried).alias("p"))

    def better(shown: Column, fewer: Column) -> Column:
        reads = F.concat(F.lit("0."), fewer["digits"], F.lit("E"), fewer["p"].cast("string")).try_cast("double") == F.abs(value)
        return F.when((F.length(shown["digits"]) > 15) & reads, fewer).otherwise(shown)

    return let(better(d, rounded(d)), then)


def json_text_bytes(text: Column) -> Column:
    """Encoded size of a JSON text, without encoding it.

    A text of one-byte characters without escapes, as most are, is its bytes, its slashes once more and what its floats differ by.
    In others, one replace takes out whole runs of characters that need one byte; what is left of most texts is nothing.  A slash needs
    two bytes, a character outside ASCII six for each of its UTF-16 units.  A digit is left where a float may begin.
    """

    def longer(x: Column) -> Column:
        general = float_bytes(x) - F.length(x)
        return F.when(x.rlike(_SHORT_FLOAT), 0).when(x.rlike(_WHOLE_FLOAT), -2).otherwise(general)

    def printed(outside: Column) -> Column:
        tokens = F.regexp_extract_all(outside, F.lit(_FLOAT), F.lit(0))
        return F.aggregate(tokens, F.lit(0), lambda n, x: n + let(x, longer))

    def measure(t: Column) -> Column:
        def total(left: Column, other: Column) -> Column:
            escaped = F.when(other == "", 0).otherwise(F.octet_length(F.encode(other, "UTF-16BE")) * 3)
            slashes = F.octet_length(left) - F.octet_length(F.replace(left, F.lit("/"), F.lit("")))
            # Floats count only outside strings, and are looked for only where one can be.
            floats = F.when(left.rlike(r"\d"), printed(F.regexp_replace(t, _JSON_STRING, ""))).otherwise(0)
            return (F.octet_length(t) - F.octet_length(other) + escaped + slashes + floats).cast("bigint")

        def simple(numbers: Column) -> Column:
            floats = F.when(F.size(numbers) > 0, printed(F.array_join(numbers, '"'))).otherwise(0)
            return (2 * F.octet_length(t) - F.octet_length(F.replace(t, F.lit("/"), F.lit(""))) + floats).cast("bigint")

        uneven = let(F.regexp_replace(t, _ONE_BYTE, ""), lambda left: let(F.regexp_replace(left, "[0-9/]+", ""), lambda other: total(left, other)))
        # Without a backslash, every other piece between quotes lies outside strings, and only longer ones hold a float.
        numbers = F.filter(F.split(t, '"', -1), lambda x, i: (F.octet_length(x) >= 3) & (i % 2 == 0) & x.rlike(r"\d[.eE]"))
        even = (F.octet_length(t) == F.length(t)) & ~F.contains(t, F.lit("\\"))
        return F.when(even, let(numbers, simple)).otherwise(uneven)

    return let(text, measure)


def json_bytes(value: Column, dtype: T.DataType | None = None) -> Column:
    """Encoded size of a value; a null takes the four bytes of `null`."""
    return F.coalesce(json_text_bytes(json_text(value, dtype)), F.lit(4).cast("bigint"))


def truncation_marker(reason: str) -> Column:
    return F.to_variant_object(F.struct(F.lit(reason).alias("_truncated")))


def cap_bytes(value: Column, limit: int, reason: str) -> Column:
    """A VARIANT over the limit is replaced whole: half a JSON document is none."""

    def capped(v: Column) -> Column:
        return F.when(json_text_bytes(F.to_json(v)) > limit, truncation_marker(reason)).otherwise(v)

    return let(value, capped)


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, as a browser counts a string."""
    return F.when(F.octet_length(text) == F.length(text), F.length(text).cast("bigint")).otherwise(
        (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint")
    )
