"""Backlogs to delivery batches bounded by items and bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.operators import delivery, ordered
from tracewell.operators.spool import placed, unplaced  # noqa: F401
from tracewell.session import new_table_path

# Whole records meet in the buckets that number them: 2^16 records of a kilobyte are 64 MB.
RECORD_WIDTH = 1 << 16


def trim_to_bytes(
    batch: DataFrame, max_bytes: int = C.MAX_BATCH_BYTES, keys=("type",), order: str = "seq", size: str = "bytes"
) -> DataFrame:
    """Adds `kept`: the longest prefix within the byte limit, but at least one item.

    For one batch per key (at most a thousand items, as `take_fifo` gives them).
    """
    w = Window.partitionBy(*keys).orderBy(order)
    running = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return batch.withColumn("kept", (F.row_number().over(w) == 1) | (running <= max_bytes))


def pack_batches(
    spool: DataFrame,
    max_items: int = C.MAX_BATCH_ITEMS,
    max_bytes: int = C.MAX_BATCH_BYTES,
    width: int = RECORD_WIDTH,
    fifo: bool = True,
) -> DataFrame:
    """A whole backlog in numbered batches, in FIFO order; adds `batch_no` and `batch_pos`.

    Records are cut into chunks of `max_items` by position; a chunk is split where the next
    record would push its bytes over the limit, and every batch has at least one record.  Batch
    numbers rise in FIFO order but are not dense: chunk number times `max_items` plus the number
    of the split, so that no pass over all chunks is needed to number them.  Records without a type
    or number have no place: `unplaced` gives them.

    With `fifo=False` the order is that of runs which put what does not fit behind newer records, see
    `rotated_batches`; numbers must then be unique within a type.
    """
    if not fifo:
        return spool.join(rotated_batches(spool, max_items, max_bytes), ["type", "seq"]).select(*spool.columns, "batch_no", "batch_pos")
    chunks = _chunks(spool, max_items, max_bytes, width)
    exploded = chunks.select("type", "_chunk", F.explode("_placed").alias("z"))
    return exploded.select(
        *[F.col("type") if c == "type" else F.col(f"z.item.{c}").alias(c) for c in spool.columns],
        (F.col("_chunk") * max_items + F.col("z.place.split")).alias("batch_no"),
        F.col("z.place.pos").alias("batch_pos"),
    )


def rotated_batches(
    spool: DataFrame,
    max_items: int = C.MAX_BATCH_ITEMS,
    max_bytes: int = C.MAX_BATCH_BYTES,
    width: int = ordered.WIDTH,
) -> DataFrame:
    """`type, seq, batch_no, batch_pos` of a backlog drained run by run, deferred records going to the tail.

    Each run takes the first `max_items` records of its type, sends as many as fit (one at least)
    and puts the others behind everything that waits.  Batch numbers are the runs', without gaps.

    What is taken from a queue of whole chunks does not depend on what the chunks before it defer,
    since that comes behind them all.  So a round cuts the queue into chunks and splits them all at once; the
    next queue is what did not fill a chunk, then the deferred tails in order.  A queue shorter than a chunk
    has nothing behind it and is split where the bytes say.  A round moves one row per chunk, which holds
    numbers and sizes, and is stored; the number of rounds grows with the logarithm of the backlog.
    """
    spark = spool.sparkSession
    path, n = new_table_path(spark, "rotation"), 0
    slim = placed(spool).select("type", "seq", F.col("bytes").cast("bigint").alias("bytes"))
    numbered = ordered.add_position(slim, ["type"], "seq", "_position", width)
    chunk = F.expr(f"_position div {int(max_items)}").alias("chunk")
    queue = (
        numbered.select("type", chunk, F.struct("seq", "bytes").alias("item"))
        .groupBy("type", "chunk")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .withColumn("base", F.lit(0).cast("bigint"))
    )
    none = spark.createDataFrame([], "type string, batch_no bigint, seqs array<bigint>").withColumn("type", F.lit(None).cast(slim.schema["type"].dataType))
    while True:
        # Written over, not added to: a task or a job that runs twice leaves one copy.
        queue.write.mode("overwrite").parquet(f"{path}/queue-{n}")
        now = spark.read.schema(queue.schema).parquet(f"{path}/queue-{n}")
        if now.isEmpty():
            break
        sent, queue = _round(now, max_items, max_bytes, width)
        sent.write.mode("overwrite").parquet(f"{path}/batches/round={n}")
        n += 1
    if not n:
        batches = none
    else:
        batches = spark.read.schema(none.schema).parquet(f"{path}/batches")
    return batches.select("type", "batch_no", F.posexplode("seqs").alias("batch_pos", "seq")).select(
        "type", "seq", "batch_no", F.col("batch_pos").cast("bigint").alias("batch_pos")
    )


def _round(queue: DataFrame, max_items: int, max_bytes: int, width: int) -> tuple[DataFrame, DataFrame]:
    """The batches of one round, and the queue after it; a queue is `type, chunk, items, base` (the runs before it)."""
    whole = F.size("items") == max_items
    runs = queue.groupBy("type").agg(F.count(F.when(whole, 1)).alias("_runs"))
    chunks = queue.join(runs, "type")
    splits = _splits(F.col("items"), max_bytes)

    # A whole chunk sends its first part; a queue that is no whole chunk sends all its parts, one after another.
    first = F.slice(splits, 1, 1)
    sends = F.when(whole, first).when(F.col("_runs") == 0, splits)
    sent = (
        chunks.select("type", "chunk", "base", "items", F.posexplode(sends).alias("_i", "_span"))
        .select(
            "type",
            (F.col("base") + F.col("chunk") + F.col("_i")).alias("batch_no"),
            F.transform(F.slice("items", F.col("_span.start") + 1, F.col("_span.n")), lambda i: i["seq"]).alias("seqs"),
        )
    )
    kept = F.element_at(splits, 1)["n"]
    rest = F.slice("items", kept + 1, F.size("items"))
    left = (
        chunks.where(F.col("_runs") > 0)
        .select(
            "type",
            F.when(whole, F.col("chunk")).otherwise(-1).cast("bigint").alias("_ord"),
            F.when(whole, rest).otherwise(F.col("items")).alias("items"),
            (F.col("base") + F.col("_runs")).alias("base"),
        )
        .where(F.size("items") > 0)
        .withColumn("_n", F.size("items").cast("bigint"))
    )
    placed_ = ordered.add_offset(left, ["type"], "_ord", "_n", "_start", width)
    # A tail is shorter than a chunk, so it lies in two chunks at most.
    last = F.col("_start") + F.col("_n") - 1
    pieces = placed_.select(
        "type", "base", "_start", "items", F.explode(F.sequence(F.expr(f"_start div {max_items}"), F.floor(last / max_items))).alias("chunk")
    ).select(
        "type", "base", "chunk", F.greatest(F.col("_start"), F.col("chunk") * max_items).alias("_at"),
        F.slice(
            "items",
            F.greatest(F.col("chunk") * max_items - F.col("_start"), F.lit(0)).cast("int") + 1,
            F.least(F.col("_start") + F.size("items"), (F.col("chunk") + 1) * max_items).cast("int")
            - F.greatest(F.col("_start"), F.col("chunk") * max_items).cast("int"),
        ).alias("items"),
    )
    gathered = pieces.groupBy("type", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("_at", "items"))).alias("_p"), F.max("base").alias("base")
    )
    return sent, gathered.select("type", "chunk", F.flatten(F.transform("_p", lambda p: p["items"])).alias("items"), "base")


def _splits(items: Column, max_bytes: int) -> Column:
    """Where a list is cut when each part takes what fits, one record at least: `start, n` of every part."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("filled"),
        F.lit(0).alias("n"),
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,n:int>>").alias("done"),
    )

    def step(state, item):
        over = (state["n"] > 0) & (state["filled"] + item["bytes"] > max_bytes)
        part = F.struct(state["at"].alias("start"), state["n"].alias("n"))
        return F.struct(
            (F.when(over, F.lit(0).cast("bigint")).otherwise(state["filled"]) + item["bytes"]).alias("filled"),
            (F.when(over, 0).otherwise(state["n"]) + 1).alias("n"),
            F.when(over, state["at"] + state["n"]).otherwise(state["at"]).alias("at"),
            F.when(over, F.concat(state["done"], F.array(part))).otherwise(state["done"]).alias("done"),
        )

    def finish(state):
        return F.concat(state["done"], F.array(F.struct(state["at"].alias("start"), state["n"].alias("n"))))

    return F.aggregate(items, start, step, finish)


def _chunks(spool: DataFrame, max_items: int, max_bytes: int, width: int) -> DataFrame:
    """`type, _chunk, _placed`: chunks of `max_items` records, each with its batch and place.

    At most `max_items` records meet in a chunk, each within the item budget.
    """
    numbered = ordered.add_position(placed(spool), ["type"], "seq", "_position", width)
    chunked = numbered.withColumn("_chunk", F.expr(f"_position div {int(max_items)}"))
    record = F.struct(F.col("seq").alias("_seq"), *[F.col(c) for c in spool.columns if c != "type"])
    grouped = chunked.groupBy("type", "_chunk").agg(F.array_sort(F.collect_list(record)).alias("_items"))
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        zero.alias("split"),
        zero.alias("filled"),
        zero.alias("pos"),
        F.array().cast("array<struct<split:bigint,pos:bigint>>").alias("places"),
    )

    def place(state, item):
        size = item["bytes"]
        over = (state["pos"] > 0) & (state["filled"] + size > max_bytes)
        split = state["split"] + F.when(over, 1).otherwise(0)
        pos = F.when(over, zero).otherwise(state["pos"])
        return F.struct(
            split.alias("split"),
            (F.when(over, zero).otherwise(state["filled"]) + size).alias("filled"),
            (pos + 1).alias("pos"),
            F.concat(state["places"], F.array(F.struct(split.alias("split"), pos.alias("pos")))).alias("places"),
        )

    places = F.aggregate("_items", start, place, lambda s: s["places"])
    fits = F.aggregate("_items", zero, lambda a, i: a + i["bytes"]) <= max_bytes
    # A chunk within the limit (the usual case) is one batch and needs no fold.
    simple = F.transform("_items", lambda _, i: F.struct(zero.alias("split"), i.cast("bigint").alias("pos")))
    paired = F.arrays_zip(
        F.col("_items").alias("item"), F.when(fits, simple).otherwise(places).alias("place")
    )
    return grouped.select("type", "_chunk", paired.alias("_placed"))


def packed_bodies(
    spool: DataFrame,
    max_items: int = C.MAX_BATCH_ITEMS,
    max_bytes: int = C.MAX_BATCH_BYTES,
    width: int = RECORD_WIDTH,
    endpoints: DataFrame | None = None,
) -> DataFrame:
    """The bodies of `pack_batches`, made where a chunk has met: the records move once less than
    in packing, spreading and gathering them again."""
    slim = spool.select("type", "seq", "data", "bytes")
    chunks = _chunks(slim, max_items, max_bytes, width)
    splits = F.sequence(F.lit(0).cast("bigint"), F.element_at("_placed", -1)["place"]["split"])
    batches = chunks.select(
        "type", "_chunk", "_placed", F.explode(splits).alias("_split")
    ).select(
        "type",
        (F.col("_chunk") * max_items + F.col("_split")).alias("batch_no"),
        F.filter("_placed", lambda z: z["place"]["split"] == F.col("_split")).alias("_own"),
    )
    listed = F.transform("_own", lambda z: z["item"]["data"])
    made = batches.select(
        "type",
        "batch_no",
        F.size("_own").cast("bigint").alias("items"),
        F.aggregate("_own", F.lit(0).cast("bigint"), lambda a, z: a + z["item"]["bytes"]).alias("bytes"),
        listed.alias("_data"),
    )
    return _with_body(made, endpoints)


def partition_bodies(
    spool: DataFrame, max_items: int = C.MAX_BATCH_ITEMS, max_bytes: int = C.MAX_BATCH_BYTES, endpoints: DataFrame | None = None
) -> DataFrame:
    """Bodies of the records as they lie in their partitions, in arrival order; nothing moves, so a stream can do it.

    A batch number is the partition's number times 2^32 plus a count.  A task holds one open batch per type.
    """

    def pack(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[str, list] = {}
        filled: dict[str, int] = {}

        def closed(record_type: str) -> pa.RecordBatch:
            nonlocal number
            data, size = open_.pop(record_type), filled.pop(record_type)
            columns = [pa.array([record_type]), pa.array([number]), pa.array([len(data)]), pa.array([size]), pa.array([data], pa.list_(pa.string()))]
            number += 1
            return pa.record_batch(columns, ["type", "batch_no", "items", "bytes", "_data"])

        for chunk in chunks:
            for record_type, data, size in zip(*(c.to_pylist() for c in chunk.columns), strict=True):
                if record_type in open_ and (len(open_[record_type]) == max_items or filled[record_type] + size > max_bytes):
                    yield closed(record_type)
                open_.setdefault(record_type, []).append(data)
                filled[record_type] = filled.get(record_type, 0) + size
        for record_type in list(open_):
            yield closed(record_type)

    slim = spool.where("type IS NOT NULL AND data IS NOT NULL").select("type", "data", F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"))
    made = slim.mapInArrow(pack, "type string, batch_no bigint, items bigint, bytes bigint, _data array<string>")
    return _with_body(made, endpoints)


def _with_body(batches: DataFrame, endpoints: DataFrame | None) -> DataFrame:
    routed = delivery.route(batches, endpoints)
    body = F.concat(F.lit('{"'), F.col("wrapper"), F.lit('":['), F.array_join("_data", ","), F.lit("]}"))
    return routed.withColumn("body", body).drop("_data")


def batch_bodies(batches: DataFrame, endpoints: DataFrame | None = None) -> DataFrame:
    """One JSON body per batch: a single wrapper key holding the items as a plain list."""
    grouped = batches.groupBy("type", "batch_no").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("bytes").alias("bytes"),
        F.array_sort(F.collect_list(F.struct("batch_pos", "data"))).alias("_items"),
    )
    listed = F.transform("_items", lambda i: i["data"])
    return _with_body(grouped.withColumn("_data", listed).drop("_items"), endpoints)
