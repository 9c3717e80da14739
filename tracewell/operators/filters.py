"""Row filters.  Each is a predicate over columns, so it sits below the projections that follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions import text, url


def gate_flag(feature: str, enabled: Column, key: Column, feature_flag: Column) -> Column:
    """Master switch, a key, and the feature's own switch; unset switches take their defaults."""
    return (
        F.coalesce(enabled, F.lit(True))
        & (F.coalesce(key, F.lit("")) != "")
        & F.coalesce(feature_flag, F.lit(C.FEATURE_DEFAULTS[feature]))
    )


def gate(df: DataFrame, flags: DataFrame, feature: str, on: str = "tenant") -> DataFrame:
    """Rows of tenants that have the feature on, from `flags(tenant, enabled, key, <feature>)`."""
    passing = flags.where(gate_flag(feature, F.col("enabled"), F.col("key"), F.col(feature))).select(on)
    return df.join(passing, on, "left_semi")


def ignored_flag(message: Column, patterns=C.IGNORED_BROWSER_ERRORS, empty_too: bool = False) -> Column:
    """Whether a message contains one of the patterns, in any case."""
    lowered = F.lower(message)
    hit = F.lit(False)
    for pattern in patterns:
        if pattern:
            hit = hit | F.contains(lowered, F.lit(pattern.lower()))
    hit = F.coalesce(hit, F.lit(False))
    return hit | (F.coalesce(message, F.lit("")) == "") if empty_too else hit


def drop_ignored(df: DataFrame, column: str = "message", patterns=C.IGNORED_BROWSER_ERRORS, empty_too=False) -> DataFrame:
    return df.where(~ignored_flag(F.col(column), patterns, empty_too))


def sample(df: DataFrame, rate: float, seed: int | None = None) -> DataFrame:
    """Random sample; a rate of 1 or more keeps everything."""
    return df if rate >= 1.0 else df.where(F.rand(seed) <= rate)


def sampled_flag(key: Column, rate: float) -> Column:
    """Repeatable sample: the first eight hex digits of the key's MD5 as a fraction."""
    if rate >= 1.0:
        return F.lit(True)
    fraction = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    return fraction <= rate


def sample_by_key(df: DataFrame, key: str, rate: float) -> DataFrame:
    return df.where(sampled_flag(F.col(key), rate))


def level_rank(level: Column) -> Column:
    pairs = [x for name, rank in C.LOG_LEVELS.items() for x in (F.lit(name), F.lit(rank))]
    return F.try_element_at(F.create_map(*pairs), F.lower(level))


def min_level(df: DataFrame, level: str = "notice", column: str = "level") -> DataFrame:
    """Levels at or above the threshold; unknown levels are dropped."""
    return df.where(level_rank(F.col(column)) >= C.LOG_LEVELS[level.lower()])


def exclude_channels(df: DataFrame, channels, column: str = "channel") -> DataFrame:
    """A log without a channel is in none of them."""
    return df.where(~F.coalesce(F.col(column).isin(*channels), F.lit(False))) if channels else df


def drop_self_errors(df: DataFrame, prefix: str, column: str = "file") -> DataFrame:
    """Errors thrown from inside the library itself, told by where they were thrown; of those without a file none is known to be."""
    return df.where(~F.coalesce(F.startswith(F.col(column), F.lit(prefix)), F.lit(False)))


def only_fatal(df: DataFrame, column: str = "severity") -> DataFrame:
    return df.where(F.col(column).isin(*C.FATAL_SEVERITIES))


def same_origin(df: DataFrame, allowed=(), column: str = "request") -> DataFrame:
    return df.where(url.origin_allowed(F.col(column), allowed))


def valid_event_names(df: DataFrame, column: str = "name", validate: bool = True) -> DataFrame:
    return df.where(text.valid_event_name(F.col(column))) if validate else df


def known_type(df: DataFrame, column: str = "type", types=C.TYPES) -> DataFrame:
    return df.where(F.col(column).isin(*types))


def standard_events(df: DataFrame, column: str = "name") -> DataFrame:
    return df.where(text.standard_event(F.col(column)))
