"""Evaluate an expression once where several others read it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, their columns computed here and not again in later filters.

    The optimizer moves a filter below the projection it reads, and with it a copy of every
    expression the filter names.  That is right for cheap columns and wasteful for parsed or
    redacted ones; a generator of one row per row is a place it does not move filters across.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
