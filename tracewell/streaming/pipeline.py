"""Streaming flows: the stateless steps as they are, delivery through foreachBatch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewell import contracts as C
from tracewell.operators import batching
from tracewell.plans import flows
from tracewell.sources import ledger


def event_stream(raw: DataFrame, salt: str) -> DataFrame:
    """Raw events to budgeted items: the batch flow has no state, so it serves a stream too."""
    return flows.event_items(raw, salt)


def deliver_stream(
    spool: DataFrame,
    path: str,
    checkpoint: str,
    max_items: int = C.MAX_BATCH_ITEMS,
    max_bytes: int = C.MAX_BATCH_BYTES,
    sink: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Packs each micro-batch and hands its bodies on, at least once.

    The default sink writes to a folder named after the micro-batch, so that a repeat after a
    failure replaces what the first attempt wrote.  `sink` gets the bodies and the batch number.
    """

    def default_sink(bodies: DataFrame, number: int) -> None:
        bodies.write.partitionBy("type").mode("overwrite").parquet(f"{path}/run={number}")

    def handle(rows: DataFrame, number: int) -> None:
        (sink or default_sink)(batching.packed_bodies(rows, max_items, max_bytes), number)

    return (
        spool.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def deliver_stream_once(
    spool: DataFrame,
    path: str,
    checkpoint: str,
    max_items: int = C.MAX_BATCH_ITEMS,
    max_bytes: int = C.MAX_BATCH_BYTES,
    trigger: dict | None = None,
    source: type = ledger.LedgerSource,
) -> StreamingQuery:
    """Delivers bodies to the ledger at `path`, each micro-batch once, whatever is killed when.

    Records are packed where they lie, so nothing is shuffled.  Micro-batches are told apart by the checkpoint's path and their
    number: a stream that starts anew needs a new checkpoint path.  `ledger.read_once` reads the bodies.
    """
    spool.sparkSession.dataSource.register(source)
    return (
        batching.partition_bodies(spool, max_items, max_bytes)
        .writeStream.format(source.name())
        .option("path", path)
        .option("stream", checkpoint)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def quarantine_stream(validated: DataFrame, good: str, bad: str, checkpoint: str, violations: str = "violations") -> StreamingQuery:
    """Valid and rejected records to two tables, in one pass over each micro-batch; what was not judged is not valid."""
    valid = F.coalesce(F.size(violations) == 0, F.lit(False))

    def handle(rows: DataFrame, number: int) -> None:
        kept = rows.persist()
        try:
            kept.where(valid).write.mode("overwrite").parquet(f"{good}/run={number}")
            kept.where(~valid).write.mode("overwrite").parquet(f"{bad}/run={number}")
        finally:
            kept.unpersist()

    return (
        validated.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
