"""The spool: what waits for delivery, per record type, in arrival order (`seq`)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.operators import ordered


def per_type(table: DataFrame, types=C.TYPES) -> DataFrame:
    """A table of one row per type, to be joined to records without moving them.

    The types are a closed list and `table` holds one row for each (it is made by an aggregation or
    a cut-off by type), so it has at most that many rows whatever the data, and may be broadcast.
    """
    return F.broadcast(table.where(F.col("type").isin(*types)))


def to_spool(df: DataFrame, record_type: Column, id: Column, seq: Column, at: Column) -> DataFrame:
    """Envelopes of budgeted items (`data`, `bytes`)."""
    return df.select(
        record_type.alias("type"),
        id.cast("string").alias("id"),
        seq.cast("bigint").alias("seq"),
        at.cast("bigint").alias("timestamp"),
        "data",
        "bytes",
    )


def placed(spool: DataFrame) -> DataFrame:
    """Records with a type and a number: only these can be taken, kept, left or packed."""
    return spool.where(F.col("type").isNotNull() & F.col("seq").isNotNull())


def unplaced(spool: DataFrame) -> DataFrame:
    """Records that have no place in a spool, for the quarantine: their type or number is missing."""
    return spool.where(F.col("type").isNull() | F.col("seq").isNull())


def spool_stats(spool: DataFrame) -> DataFrame:
    """Count and oldest timestamp per type; oldest by arrival, not by clock."""
    return spool.groupBy("type").agg(
        F.count(F.lit(1)).alias("items"), F.min_by("timestamp", "seq").alias("oldest_at")
    )


def keep_newest(spool: DataFrame, n: int = C.MAX_SPOOL_ITEMS, order: str = "seq", types=C.TYPES, width: int = ordered.WIDTH) -> DataFrame:
    """The newest `n` records per known type; other types have no capacity of their own and keep all.

    One number per type decides, so the records are filtered where they are and never move.  Records
    without a type or number are not kept: `unplaced` gives them.
    """
    rows = spool.where(F.col("type").isNotNull() & F.col(order).isNotNull())
    if n < 1:
        return rows.where(~F.col("type").isin(*types))
    cut = ordered.cut_off(rows.where(F.col("type").isin(*types)), ["type"], n, order, newest=True, width=width)
    older = F.coalesce(F.col(order) < F.col("_cut"), F.lit(False))
    return rows.join(per_type(cut, types), "type", "left").where(~older).drop("_cut")


def overflow_report(spool: DataFrame, n: int = C.MAX_SPOOL_ITEMS) -> DataFrame:
    """How many records of each type `keep_newest` drops."""
    counted = spool.where("seq IS NOT NULL").groupBy("type").agg(F.count(F.lit(1)).alias("items"))
    return counted.select(
        "type", F.least("items", F.lit(n)).alias("kept"), F.greatest(F.col("items") - n, F.lit(0)).alias("dropped")
    )


def take_fifo(
    spool: DataFrame, n: int = C.MAX_BATCH_ITEMS, types=C.TYPES, order: str = "seq", width: int = ordered.WIDTH
) -> DataFrame:
    """The oldest `n` records per known type; one number per type decides, so no record moves.

    What is taken, the `remainder` and what is `unplaced` are all of the spool, each record in one of them.
    """
    known = spool.where(F.col("type").isin(*types) & F.col(order).isNotNull())
    if n < 1:
        return known.where(F.lit(False))
    cut = ordered.cut_off(known, ["type"], n, order, width=width)
    newer = F.coalesce(F.col(order) > F.col("_cut"), F.lit(False))
    return known.join(per_type(cut, types), "type", "left").where(~newer).drop("_cut")


def remainder(spool: DataFrame, taken: DataFrame, types=C.TYPES) -> DataFrame:
    """What `take_fifo` leaves: everything that arrived after the last record taken.

    One row per type decides, so the records themselves are not shuffled.
    """
    last = taken.groupBy("type").agg(F.max("seq").alias("_last"))
    later = ~F.coalesce(F.col("seq") <= F.col("_last"), F.lit(False))
    return placed(spool).join(per_type(last, types), "type", "left").where(later).drop("_last")


def idle_lives(writes: DataFrame, keys=("type",), at: str = "timestamp", ttl: int = C.SPOOL_TTL_SECONDS) -> DataFrame:
    """Lives of a spool: runs of writes never more than `ttl` seconds apart.

    Writes within one `ttl`-wide slot are never that far apart, so slots are aggregated first and
    only slots are put in order: their number grows with time, not with the rows.
    """
    keys = list(keys)
    if ttl < 1:
        return (
            writes.groupBy(*keys)
            .agg(F.min(at).alias("started_at"), F.max(at).alias("last_write_at"), F.count(F.lit(1)).alias("writes"))
            .withColumn("life", F.lit(1).cast("bigint"))
        )
    slots = (
        writes.withColumn("_slot", ordered.bucket_start(F.col(at), ttl))
        .groupBy(*keys, "_slot")
        .agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.count(F.lit(1)).alias("_rows"))
    )
    w = Window.partitionBy(*keys).orderBy("_slot")
    fresh = F.col("_first") - F.lag("_last").over(w) > ttl
    lives = slots.withColumn("_fresh", F.coalesce(fresh, F.lit(True)).cast("int"))
    lives = lives.withColumn("life", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return lives.groupBy(*keys, "life").agg(
        F.min("_first").alias("started_at"), F.max("_last").alias("last_write_at"), F.sum("_rows").alias("writes")
    )


def idle_expiry(
    spool: DataFrame, now: int, at: str = "timestamp", ttl: int = C.SPOOL_TTL_SECONDS, types=C.TYPES
) -> DataFrame:
    """Adds `expired`: content whose spool then lay idle for more than `ttl` seconds.

    Every life of a type but its last has expired, and the last one has when `now` is that late.
    So one row per type decides: where its live content starts, if it has any.
    """
    if ttl < 1:
        return spool.withColumn("expired", F.lit(False))
    lives = idle_lives(spool.where(F.col("type").isin(*types)), ("type",), at, ttl)
    newest = lives.groupBy("type").agg(
        F.max_by("started_at", "life").alias("_start"), F.max("last_write_at").alias("_last")
    )
    live = newest.select("type", F.when(F.lit(now) - F.col("_last") <= ttl, F.col("_start")).alias("_live"))
    expired = F.col("_live").isNull() | (F.col(at) < F.col("_live"))
    return spool.join(per_type(live, types), "type", "left").withColumn("expired", expired).drop("_live")


def slot_summaries(writes: DataFrame, at: str, ttl: int) -> DataFrame:
    """`type, slot, first, last, writes` of each partition: what `idle_lives` needs to know of it.

    Nothing moves and nothing waits for a watermark, so a stream can do it before its state.
    """

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            slots = batch.groupby(["type", batch["at"] // ttl])["at"].agg(["min", "max", "count"]).reset_index()
            yield slots.set_axis(["type", "slot", "first", "last", "writes"], axis=1)

    slim = writes.where(F.col("type").isNotNull() & F.col(at).isNotNull()).select("type", F.col(at).cast("bigint").alias("at"))
    return slim.mapInPandas(summed, "type string, slot bigint, first bigint, last bigint, writes bigint")


def expired_records(
    spool: DataFrame, lives: DataFrame, at: str = "timestamp", ttl: int = C.SPOOL_TTL_SECONDS, others: bool = False
) -> DataFrame:
    """The records of the given lives (`type, started_at, last_write_at`), or all `others`; by equality of type and slot of time."""
    slots = lives.select(
        F.col("type").alias("_type"), "started_at", "last_write_at",
        F.explode(F.sequence(F.floor(F.col("started_at") / ttl), F.floor(F.col("last_write_at") / ttl))).alias("_slot"),
    )
    met = (F.col("type") == F.col("_type")) & (F.floor(F.col(at) / ttl) == F.col("_slot"))
    return spool.join(slots, met & F.col(at).between(F.col("started_at"), F.col("last_write_at")), "left_anti" if others else "left_semi")


def overflow_cycles(
    operations: DataFrame, max_items: int = C.MAX_SPOOL_ITEMS, width: int = ordered.WIDTH
) -> DataFrame:
    """Overflow cycles of `operations(type, seq, op, size_after, dropped)`: one warning each.

    A cycle opens when an add drops records and none is open; a take that leaves fewer than the
    maximum closes it.
    """
    overflows = (F.col("op") == "add") & (F.col("dropped") > 0)
    closes = (F.col("op") == "take") & (F.col("size_after") < max_items)
    state = F.when(overflows, F.lit("open")).when(closes, F.lit("closed"))
    changes = operations.withColumn("_state", state).where(F.col("_state").isNotNull())
    bucket = ordered.bucket_start(F.col("seq"), width)
    seen = ordered.carry_last(changes, ["type"], F.col("seq"), F.col("_state"), bucket, "_previous")
    opening = (F.col("_state") == "open") & (F.coalesce("_previous", F.lit("closed")) == "closed")
    numbered = ordered.running_count(seen, ["type"], F.col("seq"), opening, bucket, "cycle")
    return (
        numbered.where((F.col("_state") == "open") & (F.col("cycle") > 0))
        .groupBy("type", "cycle")
        .agg(
            F.min("seq").alias("opened_at"),
            F.max("seq").alias("last_overflow_at"),
            F.count(F.lit(1)).alias("overflows"),
            F.sum("dropped").alias("dropped"),
        )
    )


def last_given(spool: DataFrame) -> DataFrame:
    """`type, last_seq`: the highest arrival number of each type.  Kept from run to run, it is the highest ever given."""
    return spool.groupBy("type").agg(F.max("seq").alias("last_seq"))


def next_spool(
    left: DataFrame, requeued: DataFrame, now: int, given: DataFrame | None = None, width: int = 1 << 40, types=C.TYPES
) -> DataFrame:
    """The spool after a run: what was left, then the requeued records at the tail.

    `requeued` holds envelopes plus `slot`, a unique integer per type that gives their order.  They
    get a new id, a new timestamp and arrival numbers after every existing one, and after `given`
    (`type, last_seq`), the highest ever given: a type that was taken whole has no number left to
    go by.  Slots are a thousandth as dense as numbers, so buckets of them are wider.
    """
    numbers = last_given(left).unionByName(last_given(requeued))
    if given is not None:
        numbers = numbers.unionByName(given.select("type", "last_seq"))
    tail = numbers.groupBy("type").agg(F.max("last_seq").alias("_max"))
    placed = ordered.add_position(requeued, ["type"], "slot", "_position", width)
    again = (
        placed.join(per_type(tail, types), "type", "left")
        .withColumns(
            {
                "seq": F.coalesce("_max", F.lit(-1)) + 1 + F.col("_position"),
                "timestamp": F.lit(now).cast("bigint"),
            }
        )
        .withColumn("id", F.concat_ws("-", F.lit("r"), F.lit(str(now)), "type", F.col("seq").cast("string")))
    )
    columns = left.columns
    return left.unionByName(again.select(*columns))


def discard_backlog(spool: DataFrame, record_type: str) -> DataFrame:
    return spool.where(F.col("type") != record_type)


def fifo_order(spool: DataFrame, types=C.TYPES) -> DataFrame:
    """Total order for reading: types in contract order, then arrival."""
    rank = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("type"))
    return spool.orderBy(rank, "seq")


def all_errors(errors: DataFrame, js_errors: DataFrame, id: str = "id") -> DataFrame:
    """Both kinds of errors in one table; their numbers overlap, so ids get a prefix."""
    first = errors.withColumns({id: F.concat(F.lit("err_"), F.col(id).cast("string")), "source": F.lit("errors")})
    second = js_errors.withColumns(
        {id: F.concat(F.lit("jserr_"), F.col(id).cast("string")), "source": F.lit("javascript_errors")}
    )
    return first.unionByName(second, allowMissingColumns=True)
