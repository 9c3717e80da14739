"""Streaming forms of the stateful operators.

State is kept per session in typed values and maps of the state store.  A cache or ring is one value, an array: it is
read and written whole for each session of a micro-batch, and a list of the store would carry each member by itself.

Rows of a session come one at a time; a micro-batch of a session that is longer than `HELD` rows is laid down in the
store and taken from there in order, so that a task holds a bounded number of rows and eight bytes for each of the
others.  A row costs its Python worker by the column, so its number and what the rule reads cross as one text (`_packed`).
"""

from __future__ import annotations

import array
from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tracewell import contracts as C
from tracewell.operators.sessions import _run_cache, cache_key
from tracewell.operators.spool import slot_summaries

SESSION_IDLE = "1 day"  # after which the state of a session is forgotten
HELD = 10_000  # rows of a session that are put in order in memory
LATE = np.iinfo(np.int64).max  # where rows without a number go


def _milliseconds(idle: str | None) -> int | None:
    return int(pd.Timedelta(idle).total_seconds() * 1000) if idle else None


class _InOrder(StatefulProcessor):
    """Takes each session's rows of a micro-batch, as `opened` gives them, in the order of their first field, a number."""

    def __init__(self, fields: T.StructType, held: int = HELD):
        self.fields, self.held = fields, held

    @staticmethod
    def opened(row: Row) -> tuple:
        """The fields of a row."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pending = handle.getMapState("pending", "place bigint", self.fields)

    def in_order(self, rows: Iterator[Row]) -> Iterator[tuple]:
        slim = map(self.opened, rows)
        few = list(islice(slim, self.held + 1))
        if len(few) <= self.held:
            yield from sorted(few, key=lambda r: LATE if r[0] is None else r[0])
            return
        numbers = array.array("q")
        for place, row in enumerate(chain(few, slim)):
            if place == 0:
                few = []
            self.pending.updateValue((place,), row)
            numbers.append(LATE if row[0] is None else row[0])
        for place in np.argsort(np.frombuffer(numbers, np.int64), kind="stable").tolist():
            yield self.pending.getValue((place,))
        self.pending.clear()

    def close(self) -> None:
        pass


class _Dedupe(_InOrder):
    """Rows are (number, key, whole row); the state is the cached keys, the oldest first."""

    def __init__(self, fields: T.StructType, cache: int, idle: int | None, held: int):
        super().__init__(fields, held)
        self.cache, self.idle = cache, idle

    @staticmethod
    def opened(row: Row) -> tuple:
        at, key = row[1].split("|", 1)
        return int(at) if at else None, key, row[2]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.keys = handle.getValueState("keys", "keys array<string>", self.idle)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        self.keys.update((list(initialState["keys"]),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = OrderedDict.fromkeys((self.keys.get() or ((),))[0])
        for _, report, row in self.in_order(rows):
            if _run_cache((report,), held, self.cache)[0]:
                yield Row(_row=row)
        if held:  # also where nothing changed: the time to live counts from the last report
            self.keys.update((list(held),))


def dedupe_reports_stream(
    reports: DataFrame,
    key: Column,
    session: str,
    order: str,
    cache: int = C.DEDUPE_CACHE,
    idle: str | None = SESSION_IDLE,
    caches: DataFrame | None = None,
    held: int = HELD,
) -> DataFrame:
    """Reports their session has not just sent; the state of a session is its cached keys.

    Within one micro-batch a session's reports are taken in `order`; across micro-batches, in
    the order the batches arrive.  A session's cache is forgotten after `idle` of processing time without
    reports.  With `idle=None` nothing is ever forgotten; an `availableNow` query needs that, since it
    does not end while time may still change its state.  A stream may go on from `caches`, what
    `sessions.session_caches` made of earlier reports.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in reports.columns))
    keyed = reports.select(_session(session), _packed(order, cache_key(key)), row.alias("_row"))
    out = T.StructType([keyed.schema["_row"]])
    fields = T.StructType().add("_at", T.LongType()).add("_key", T.StringType()).add(keyed.schema["_row"])
    processor = _Dedupe(fields, cache, _milliseconds(idle), held)
    sent = _stateful(keyed, processor, out, idle, caches)
    return sent.select("_row.*")


def _session(session: str) -> Column:
    return F.coalesce(F.col(session).cast("string"), F.lit("")).alias("_session")


def _packed(order: str, *parts: Column) -> Column:
    """The number (empty for none) and the parts of a row as one text, cut by bars; only the last part may hold bars."""
    return F.concat_ws("|", F.coalesce(F.col(order).cast("bigint").cast("string"), F.lit("")), *parts).alias("_packed")


def _stateful(rows: DataFrame, processor: StatefulProcessor, out: T.StructType, idle: str | None, first: DataFrame | None) -> DataFrame:
    start = None if first is None else first.withColumnRenamed("session", "_session").groupBy("_session")
    return rows.groupBy("_session").transformWithState(processor, out, "append", "ProcessingTime" if idle else "None", start)


def dedupe_within_watermark(reports: DataFrame, key: Column, session: str, at: str, delay: str = "10 minutes") -> DataFrame:
    """Time-bounded approximation: one report per session and key within the watermark."""
    keyed = reports.withColumn("_key", key).withWatermark(at, delay)
    return keyed.dropDuplicatesWithinWatermark([session, "_key"]).drop("_key")


class _Trails(_InOrder):
    """Rows are (number, is an error, crumb); the state is the ring of the last crumbs."""

    def __init__(self, fields: T.StructType, n: int, idle: int | None, held: int):
        super().__init__(fields, held)
        self.n, self.idle = n, idle

    @staticmethod
    def opened(row: Row) -> tuple:
        at, error, crumb = row[1].split("|", 2)
        return int(at) if at else None, error == "1", crumb[1:] if crumb else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.ring = handle.getValueState("ring", "crumbs array<string>", self.idle)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        if self.n > 0:
            self.ring.update((list(initialState["crumbs"][-self.n :]),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        ring = list((self.ring.get() or ((),))[0])
        for at, error, crumb in self.in_order(rows):
            if error:
                yield Row(_session=key[0], _at=at, breadcrumbs=list(ring))
            elif self.n > 0:
                ring = (ring + [crumb])[-self.n :]
        if ring:
            self.ring.update((ring,))


def breadcrumb_stream(
    records: DataFrame,
    session: str,
    order: str,
    is_error: str,
    crumb: str,
    n: int = C.MAX_BREADCRUMBS,
    idle: str | None = SESSION_IDLE,
    crumbs: DataFrame | None = None,
    held: int = HELD,
) -> DataFrame:
    """Errors with the last `n` crumbs (a string column) of their session; the state is that ring,
    forgotten like the cache of `dedupe_reports_stream`.  A stream may go on from `crumbs`, what
    `sessions.last_crumbs` made of earlier records."""
    error = F.when(F.col(is_error).cast("boolean"), "1").otherwise("0")
    text = F.coalesce(F.concat(F.lit("+"), F.col(crumb).cast("string")), F.lit(""))
    slim = records.select(_session(session), _packed(order, error, text))
    out = T.StructType().add("_session", T.StringType()).add("_at", T.LongType()).add("breadcrumbs", T.ArrayType(T.StringType()))
    fields = T.StructType().add("_at", T.LongType()).add("_error", T.BooleanType()).add("_crumb", T.StringType())
    processor = _Trails(fields, n, _milliseconds(idle), held)
    trails = _stateful(slim, processor, out, idle, crumbs)
    return trails.select(F.col("_session").alias(session), F.col("_at").alias(order), "breadcrumbs")


def idle_lives_stream(
    writes: DataFrame, at: str = "ts", keys=("type",), ttl: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Lives of a spool as session windows, put out once the watermark has passed their end."""
    return (
        writes.withWatermark(at, delay)
        .groupBy(F.session_window(at, ttl).alias("_w"), *keys)
        .agg(F.min(at).alias("started_at"), F.max(at).alias("last_write_at"), F.count(F.lit(1)).alias("writes"))
        .select(*keys, "started_at", "last_write_at", "writes")
    )


class _Lives(StatefulProcessor):
    """The open life of a type, and a timer for its end.

    Rows are summaries of slots no wider than the time to live: writes of one slot are of one life.
    """

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot bigint", "first bigint, last bigint, writes bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        for r in rows:
            first, last, writes = r["first"], r["last"], r["writes"]
            held = self.slots.getValue((r["slot"],))
            if held is not None:
                first, last, writes = min(first, held[0]), max(last, held[1]), writes + held[2]
            self.slots.updateValue((r["slot"],), (first, last, writes))
            self.handle.registerTimer((last + self.ttl + 1) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        """Put out the lives that are over at the watermark and drop their slots."""
        now = timerValues.getCurrentWatermarkInMs() // 1000
        lives: list[list] = []
        for (slot,), (first, last, writes) in sorted((tuple(s), tuple(v)) for s, v in self.slots.iterator()):
            if lives and first - lives[-1][1] <= self.ttl:
                lives[-1][1:] = [last, lives[-1][2] + writes, [*lives[-1][3], slot]]
            else:
                lives.append([first, last, writes, [slot]])
        for first, last, writes, slots in lives:
            if now - last > self.ttl:
                for slot in slots:
                    self.slots.removeKey((slot,))
                yield Row(type=key[0], started_at=first, last_write_at=last, writes=writes)

    def close(self) -> None:
        pass


def expired_lives_stream(writes: DataFrame, at: str = "timestamp", ttl: int = C.SPOOL_TTL_SECONDS, delay: str = "1 hour") -> DataFrame:
    """`type, started_at, last_write_at, writes` of each life of a spool as its time to live runs out.

    Timers in event time: a life is over when the watermark is more than `ttl` seconds after its last write.  There are few
    types and many writes, so each task first sums its writes up by type and slot of `ttl` seconds, and only those
    sums meet; the state of a type is the slots of its open life.  `spool.expired_records` and
    `stored.discard_lives` take what this gives.
    """
    if ttl < 1:
        raise ValueError("a spool that never expires has no lives to end")
    summed = slot_summaries(writes, at, ttl).withColumn("_ts", F.timestamp_seconds("last")).withWatermark("_ts", delay)
    out = "type string, started_at bigint, last_write_at bigint, writes bigint"
    return summed.groupBy("type").transformWithState(_Lives(ttl), out, "append", "EventTime")


def rate_flags_stream(
    requests: DataFrame, keys=("key",), at: str = "ts", limit: int = C.REQUESTS_PER_MINUTE, delay: str = "1 minute"
) -> DataFrame:
    """Requests per key and minute; rows later than the watermark are not counted."""
    return (
        requests.withWatermark(at, delay)
        .groupBy(F.window(at, "1 minute").alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(F.col("_w.start").alias("minute"), *keys, "requests", (F.col("requests") > limit).alias("over_limit"))
    )
