"""Files that hold one JSON list, read by many tasks.

Such a file is one line, so no line break tells where to cut.  Spark's text reader can cut a file of any size into blocks at any
separator; here that is `}`, and a record is what lies between two of them.  Whether a `}` ends an entry of the list depends on
everything before it: on the quotes, which say what is inside a string, and on the brackets, which say how deep it is.

So the blocks are read twice.  The first time each is summed up, for both cases of its beginning, in a string or not: whether it
turns that round, how much deeper it ends than it began, and how often an object closes at which depth.  Running sums over
the blocks of a file, a short table, then say how each begins and how many entries were closed before it.  The second time
each block is cut after every object that closes at the list's own depth.  What two blocks share of an entry is put
together afterwards; everything else is whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.operators import ordered
from tracewell.session import new_table_path

ESCAPE = re.compile(rb"\\.", re.DOTALL)
OUT_ROWS, OUT_BYTES = 10_000, 16 << 20
SHARES = 4  # tasks for each core, at least, where blocks are small
SUMMARY = "file string, block bigint, size bigint, odd int, bytes bigint, ends array<struct<deeper:bigint,closed:map<bigint,bigint>>>"
PIECE = "file string, grp bigint, block bigint, begun boolean, closed boolean, text binary"


def _turns(text: bytes) -> list[bytes]:
    """What lies between the quotes that begin or end strings."""
    return ESCAPE.sub(b"", text).split(b'"') if b"\\" in text else text.split(b'"')


def _deeper(turns: list[bytes], inside: int) -> int:
    """How much deeper a fragment gets up to its end, the closing `}` not counted."""
    plain = b"".join(turns[inside::2])
    return plain.count(b"{") + plain.count(b"[") - plain.count(b"]")


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """file, block, size (of the file), n (rises within a block), text (bytes up to the next `}`)."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("n"),
        F.col("value").cast("binary").alias("text"),
    )


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block, of fragments in their order."""
    now, rows = None, []

    def done() -> None:
        ends = [{"deeper": depth[i], "closed": list(closed[i].items())} for i in (0, 1)]
        rows.append((*now, odd, length, ends))

    for batch in batches:
        files, blocks, sizes, texts = (batch.column(c).to_pylist() for c in ("file", "block", "size", "text"))
        for place in zip(files, blocks, sizes, texts, strict=True):
            if place[:3] != now:
                if now is not None:
                    done()
                now, odd, length, depth, closed = place[:3], 0, 0, [0, 0], [Counter(), Counter()]
            turns = _turns(place[3])
            length += len(place[3]) + 1
            for begun in (0, 1):
                inside = begun ^ odd
                depth[begun] += _deeper(turns, inside)
                if not (inside + len(turns) - 1) % 2:
                    depth[begun] -= 1
                    closed[begun][depth[begun]] += 1
            odd = (odd + len(turns) - 1) % 2
    if now is not None:
        done()
    if rows:
        kind = pa.list_(pa.struct([("deeper", pa.int64()), ("closed", pa.map_(pa.int64(), pa.int64()))]))
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), kind)
        names = ["file", "block", "size", "odd", "bytes", "ends"]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _starts(fragments: DataFrame) -> DataFrame:
    """Per block: whether it begins inside a string, how deep, after how many entries; and whether its file ends well."""
    blocks = fragments.select("file", "block", "size", "text").mapInArrow(_summaries, SUMMARY)
    whole = Window.partitionBy("file")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def earlier(column) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0).cast("bigint"))

    turned = blocks.withColumn("inside", (earlier("odd") % 2).cast("int"))
    mine = turned.withColumn("_end", F.element_at("ends", F.col("inside") + 1))
    deep = mine.withColumn("depth", earlier("_end.deeper"))
    cuts = deep.withColumn("_cuts", F.coalesce(F.try_element_at("_end.closed", 1 - F.col("depth")), F.lit(0).cast("bigint")))
    # The last fragment of a file that ends in `]` has no `}`, which was counted all the same.
    well = (
        (F.sum("odd").over(whole) % 2 == 0)
        & (F.sum("_end.deeper").over(whole) == -1)
        & (F.sum("bytes").over(whole) == F.col("size") + 1)
    )
    return cuts.select("file", "block", "inside", "depth", earlier("_cuts").alias("before"), well.alias("well"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of blocks between the ends of entries; the fragments come in their order."""
    rows, held, now = [], 0, None

    def made() -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
        names = ["file", "grp", "block", "begun", "closed", "text"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        columns = ("file", "block", "inside", "depth", "before", "text")
        for file, block, inside_, depth_, before, text in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if (file, block) != now:
                if now is not None and parts:
                    rows.append((*_place(now, grp), begun, False, b"".join(parts)))
                now, inside, depth, grp, parts = (file, block), inside_, depth_, before, []
                begun = block == 0
            turns = _turns(text)
            depth += _deeper(turns, inside)
            inside = (inside + len(turns) - 1) % 2
            parts += (text, b"}")
            if inside:
                continue
            depth -= 1
            if depth == 1:
                rows.append((*_place(now, grp), begun, True, b"".join(parts)))
                held += len(rows[-1][-1])
                grp, parts, begun = grp + 1, [], True
                if len(rows) >= OUT_ROWS or held > OUT_BYTES:
                    yield made()
                    rows, held = [], 0
    if now is not None and parts:
        rows.append((*_place(now, grp), begun, False, b"".join(parts)))
    if rows:
        yield made()


def _place(now: tuple[str, int], grp: int) -> tuple[str, int, int]:
    return now[0], grp, now[1]


def _in_bytes(spark: SparkSession, setting: str) -> int:
    """A size of the session, such as `128MB`."""
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting)))


def _bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of `df`: that of its files, where it is what they hold."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def _same_blocks(spark: SparkSession, block_bytes: int | None, total: int = 0) -> Iterator[None]:
    """Files are cut alike in all jobs inside, though executors come and go: the cut depends on their number otherwise.

    Blocks of a given size are dealt to no more tasks than `total` bytes make by the session's own limit, or a few for each core:
    a task reads many small blocks, one after another.
    """
    tasks = spark.sparkContext.defaultParallelism
    wanted = {"spark.sql.files.minPartitionNum": str(tasks)}
    if block_bytes:
        most = _in_bytes(spark, "spark.sql.files.maxPartitionBytes")
        wanted["spark.sql.files.maxPartitionBytes"] = str(block_bytes)
        wanted["spark.sql.files.maxPartitionNum"] = str(max(SHARES * tasks, -(-total // max(most, block_bytes))))
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_json_list(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """`file, pos, entry` (VARIANT) of each entry of the JSON lists in `path`; a file that holds no JSON list has none.

    The pieces are stored once, so that a file's entries can be judged and numbered before they are given.  A block
    has at most `block_bytes`, or what the session says.
    """
    starts_path, pieces_path = (new_table_path(spark, f"json-list-{x}") for x in ("blocks", "pieces"))
    fragments = _fragments(spark, path)
    with _same_blocks(spark, block_bytes, _bytes(spark.read.text(path))):
        _starts(fragments).write.parquet(starts_path)
        starts = spark.read.parquet(starts_path)
        met = fragments.select("file", "block", "n", "text").join(starts.where("well"), ["file", "block"])
        in_order = met.repartition("file", "block").sortWithinPartitions("file", "block", "n")
        in_order.select("file", "block", "inside", "depth", "before", "text").mapInArrow(_pieces, PIECE).write.parquet(pieces_path)
    pieces = spark.read.schema(PIECE).parquet(pieces_path)

    whole = pieces.where("begun AND closed").select("file", "grp", "closed", F.col("text").cast("string").alias("text"))
    split = (
        pieces.where("NOT (begun AND closed)")
        .groupBy("file", "grp")
        .agg(
            F.max("closed").alias("closed"),
            F.array_sort(F.collect_list(F.struct("block", F.hex("text").alias("h")))).alias("_p"),
        )
        .select("file", "grp", "closed", F.unhex(F.array_join(F.transform("_p", lambda p: p["h"]), "")).cast("string").alias("text"))
    )
    parts = whole.unionByName(split)
    text = F.regexp_replace("text", r"^\s++", "")
    opening = F.when(F.col("grp") == 0, "[").otherwise(",")
    # An unclosed part is a file's end: its `}` is not in the file, and its `]` closes the list.
    bare = F.when(F.col("closed"), text).otherwise(F.regexp_replace(text, r"\s*\}$", ""))
    ended = F.when(F.col("closed"), bare).otherwise(F.substr(bare, F.lit(1), F.length(bare) - 1))
    nothing = ~F.col("closed") & (F.col("grp") > 0) & (bare == "]")
    inner = F.substr(ended, F.lit(2), F.length(ended))
    right = F.startswith(bare, opening) & (F.col("closed") | F.endswith(bare, F.lit("]"))) & ((F.col("grp") == 0) | inner.rlike(r"\S"))
    listed = F.when(nothing, F.array().cast("array<variant>")).when(
        right, F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<variant>")
    )
    entries = parts.select("file", "grp", listed.alias("entries")).withColumn("n", F.size("entries").cast("bigint"))
    slim = entries.select("file", "grp", "n", F.col("entries").isNull().alias("_bad"))
    bad = slim.where("_bad").select("file").distinct()
    # In a list of objects every part is one entry; only files with other entries need a sum to number them.
    uneven = slim.where((F.col("n") > 1)).select("file").distinct()
    good = entries.join(bad, "file", "left_anti").where("n > 0")
    even = good.join(uneven, "file", "left_anti").withColumn("_first", F.col("grp"))
    counted = ordered.add_offset(good.select("file", "grp", "n").join(uneven, "file", "left_semi"), ["file"], "grp", "n", "_first")
    summed = good.join(counted.select("file", "grp", "_first"), ["file", "grp"])
    numbered = even.unionByName(summed.select(*even.columns))
    return numbered.select("file", "_first", F.posexplode("entries").alias("_i", "entry")).select(
        "file", (F.col("_first") + F.col("_i")).cast("int").alias("pos"), "entry"
    )
