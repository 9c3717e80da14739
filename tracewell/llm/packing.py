"""Best-two-fit packing of documents into token sequences.

A sequence is filled greedily, always with the longest unpacked piece that fits.  Then, as long as that leaves it
fuller, its smallest piece gives way to the two unpacked pieces that fill the widened gap most tightly.

Pieces of one length are interchangeable, so the choices depend on how many pieces of each length are left and on
nothing else.  The plan is therefore made from the count of pieces per length (at most `capacity` numbers, whatever the
input's size), and a filling that can be repeated is taken as often as its lengths allow, in one step.  Each round uses
up a length, so the plan has a few thousand entries at most.  The pieces then find their places by equality of length
and by rank within the length; ranks are counted in salted buckets, so that one very common length is no single task.

Defined cases: a null text is the empty one, which has the closing id alone.  A repeated row is a document of its own,
and so is a row with a null doc_id.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tracewell.llm import common
from tracewell.llm.registry import query
from tracewell.llm.tokens import PartCache, id_bytes

CAPACITY = 1024
CLOSING_ID = 2
BUCKET_ROWS = 50_000  # pieces of one length that are ranked in one task
SLICE = 12 << 20  # of text that is cut at once
REMEMBERED = 800_000  # parts whose ids a worker keeps


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    closing: int = CLOSING_ID,
    path: str | None = None,
    added: bool = False,
) -> DataFrame:
    """Per piece of a document: doc_id, piece, start, length, ids_crc32, row_no.

    Only documents over `capacity` tokens are cut; the first piece takes what is over whole sequences.  `row_no` tells
    rows apart, also repeated ones.  With `added`, the file's added tokens in a text become their ids, as the library does
    by default; without, their strings are ordinary text.
    """
    path = path or vocabulary_path()
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.one_thread()
        cache, end = _cache(path, added), id_bytes([closing])
        for whole in batches:
            for batch in common.pieces_of(whole, "t", SLICE):
                rows: list[tuple] = []
                texts = [t or "" for t in batch.column("t").to_pylist()]
                cache.prepare(texts)
                for at, (no, words) in enumerate(zip(batch.column("n").to_pylist(), texts, strict=True)):
                    ids = b"".join(cache.of(words)) + end
                    total, start, piece = len(ids) // 4, 0, 0
                    while start < total:
                        stop = start + ((total - start) % capacity or capacity)
                        rows.append((at, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop]), no))
                        start, piece = stop, piece + 1
                at, *rest = zip(*rows, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch(
                    [batch.column("k").take(pa.array(at)), *(pa.array(x, kind) for x, kind in zip(rest, kinds, strict=True))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "row_no"],
                )
            common.release_memory()

    slim = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.monotonically_increasing_id().alias("n"))
    return slim.mapInArrow(run, f"doc_id {key_type}, piece int, start long, length long, ids_crc32 long, row_no long")


def _cache(path: str, added: bool) -> PartCache:
    """One per worker process.

    The ids are those that the tokenizers library makes with the file.  They are made with tiktoken from the file's
    vocabulary, which takes less than half the time; the library cuts a text at added tokens first, and so does this.
    """

    def make() -> PartCache:
        import public_tokenizers
        import tiktoken

        made = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(path), special_tokens={}).encode_ordinary
        ids = added_tokens(path) if added else {}
        if not ids:
            return PartCache(lambda parts: [id_bytes(made(p)) for p in parts], most=REMEMBERED)
        token = re.compile("|".join(map(re.escape, sorted(ids, key=len, reverse=True))))

        def encode(part: str) -> bytes:
            if not any(map(part.__contains__, ids)):
                return id_bytes(made(part))
            out, at = [], 0
            for m in token.finditer(part):
                out += [*made(part[at : m.start()]), ids[m[0]]]
                at = m.end()
            return id_bytes(out + made(part[at:]))

        return PartCache(lambda parts: [encode(p) for p in parts], most=REMEMBERED)

    return common.kept(("packing", path, added), make)


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the file's added tokens.  Those that take white space with them, or stand as whole words only, are not known here."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]):
            raise ValueError(f"an added token of another kind: {t}")
    return {t["content"]: t["id"] for t in tokens if t["content"]}


def vocabulary(path: str) -> dict[bytes, int]:
    """Ids by bytes, of a byte-level BPE file whose ids rise in the order of its merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # A byte that prints as itself stands for itself, the others for the characters from 256 on, in their order.
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    byte = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(byte[c] for c in word): n for word, n in model["vocab"].items() if all(c in byte for c in word) and not word.startswith("<|")}


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many sequences, the lengths of each), from the number of pieces of each length."""
    left = {length: n for length, n in counts.items() if n}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError(f"a piece is empty or over {capacity}")
    out = []
    while left:
        bin_, free = [], capacity
        have = dict(left)
        while (best := max((x for x in have if x <= free), default=0)):
            bin_.append(best)
            free -= best
            _take(have, best)
        while free and bin_ and (pair := _best_pair(have, free + bin_[-1], above=bin_[-1])):
            smallest = bin_.pop()
            free += smallest - sum(pair)
            for x in pair:
                _take(have, x)
            have[smallest] = have.get(smallest, 0) + 1
            bin_ = sorted([*bin_, *pair], reverse=True)
        need = {x: bin_.count(x) for x in bin_}
        times = min(left[x] // n for x, n in need.items())
        # The smallest piece that gave way must stay available, or the next sequence is chosen differently; that only
        # makes the choice better or equal, so repeating the filling is kept.
        for x, n in need.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
        out.append((times, bin_))
    return out


def _take(have: dict[int, int], length: int) -> None:
    have[length] -= 1
    if not have[length]:
        del have[length]


def _best_pair(have: dict[int, int], gap: int, above: int) -> tuple[int, int] | None:
    """The two pieces with the largest sum that is over `above` and at most `gap`."""
    lengths = sorted(have)
    best, found = above, None
    low, high = 0, len(lengths) - 1
    while low <= high:
        total = lengths[low] + lengths[high]
        if total > gap:
            high -= 1
            continue
        if total > best and (low < high or have[lengths[low]] > 1):
            best, found = total, (lengths[high], lengths[low])
        low += 1
    return found


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The pieces with sequence_id and offset.  `pieces` needs length and a unique row_no, and should be stored."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    slots: dict[int, list] = {x: [] for x in counts}
    given = dict.fromkeys(counts, 0)
    sequences = 0
    for times, lengths in plan(counts, capacity):
        offset = 0
        for x in lengths:
            slots[x].append((given[x], given[x] + times, sequences, offset))
            given[x] += times
            offset += x
        sequences += times
    table = spark.createDataFrame(
        [(x, max(1, -(-counts[x] // bucket_rows)), places) for x, places in slots.items()],
        "length long, buckets long, places array<struct<a:long,b:long,sequence:long,offset:long>>",
    )
    rows = pieces.join(F.broadcast(table.select("length", "buckets")), "length")  # at most `capacity` rows
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row_no"), "buckets"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("length", "bucket")
        .agg(F.count("*").alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "bucket").orderBy("row_no", "piece")
    ranked = (
        rows.withColumn("_r", F.row_number().over(within) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("_r", F.col("_r") + F.col("before"))
        .join(F.broadcast(table.select("length", "places")), "length")
    )
    place = F.filter("places", lambda p: (F.col("_r") >= p["a"]) & (F.col("_r") < p["b"]))[0]
    placed = ranked.withColumn("_p", place)
    sequence = (F.col("_p.sequence") + F.col("_r") - F.col("_p.a")).alias("sequence_id")
    return placed.select(*pieces.columns, sequence, F.col("_p.offset").alias("offset"))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = common.stored(token_pieces(docs, key, text, path=path, added=added), "token-pieces")
    return pack(pieces).drop("row_no")


def ids_of(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, added: bool = False) -> DataFrame:
    """The ids themselves, with the closing one: doc_id, ids."""
    path = path or vocabulary_path()
    kind = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        cache, end = _cache(path, added), id_bytes([CLOSING_ID])
        for whole in batches:
            for batch in common.pieces_of(whole, "t", SLICE):
                texts = [t or "" for t in batch.column("t").to_pylist()]
                cache.prepare(texts)
                ids = [np.frombuffer(b"".join(cache.of(t)) + end, "<u4").astype("i8") for t in texts]
                yield pa.record_batch([batch.column("k"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, kind)


@query("op9_packing")
def op9_packing(spark, folder):
    return pack_documents(common.read(spark, folder, "documents"), added=True)
