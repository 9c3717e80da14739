"""The three flows end to end: events to items, browser reports to items, backlog to delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions.let import computed_once
from tracewell.operators import batching, budget, filters, sessions, shape, spool, validate


def event_items(raw: DataFrame, salt: str, keep=("event_id", "seq", "at"), secrets=None) -> DataFrame:
    """Named events to budgeted items: one pass, no shuffle."""
    named = filters.valid_event_names(raw, "name")
    shaped = computed_once(shape.shape_events(named, salt, keep=keep, secrets=secrets))
    checked = validate.validate(shaped, "events").where(F.size("violations") == 0).drop("violations")
    return budget.item_budget(checked, "events", keep=keep)


def event_spool(raw: DataFrame, salt: str) -> DataFrame:
    items = event_items(raw, salt)
    return spool.to_spool(items, F.lit("events"), F.col("event_id"), F.col("seq"), F.col("at"))


def received_reports(raw: DataFrame, allowed=(), rate: float = 1.0) -> DataFrame:
    """Browser reports that pass every rule, in their order: gates, origin, Referer fallback,
    validation, ignore list, sample."""
    classified = validate.classify_reports(raw, allowed, rate=rate)
    return validate.fill_report_url(classified.where("disposition = 'received'"))


def rejected_reports(raw: DataFrame, allowed=()) -> DataFrame:
    """Reports that fail validation, with their problems."""
    return validate.rejected_reports(raw, allowed)


def js_error_items(raw: DataFrame, salt: str, keep=("report_id",), allowed=(), rate: float = 1.0, secrets=None) -> DataFrame:
    """Raw browser reports to budgeted items."""
    received = received_reports(raw, allowed, rate)
    shaped = computed_once(shape.shape_js_errors(received, salt, keep=keep, secrets=secrets))
    return budget.item_budget(shaped, "javascript_errors", keep=keep)


def unique_reports(raw: DataFrame) -> DataFrame:
    """Reports as the browser would send them: not ignored, and not just sent by their session."""
    kept = filters.drop_ignored(raw, "message", empty_too=True)
    return sessions.dedupe_reports(kept, sessions.report_key())


def flush(backlog: DataFrame, max_spool: int = C.MAX_SPOOL_ITEMS, max_items: int = C.MAX_BATCH_ITEMS,
          max_bytes: int = C.MAX_BATCH_BYTES) -> DataFrame:
    """A backlog as packed batches, the newest records per type only.

    Give it a stored spool (`read_spool_table`): numbering the records reads it twice, the first
    time two columns of it.
    """
    return batching.pack_batches(spool.keep_newest(backlog, max_spool), max_items, max_bytes)
