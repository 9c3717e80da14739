"""Near-duplicate documents by exact Jaccard similarity of word shingles, skipping by relations between sets.

Equal sets are one class with a representative.  For the others the rule of prefixes holds: with all shingles in one
order, rarest first, two sets that link share a shingle among the first few of each.  So each set posts its prefix to
the lists of those shingles, with its size and the shingle's place, and only sets that meet in a list can link.

Lists are skipped by size and by place: a member whose size is too different, or whose shingle stands too late to leave
enough others, is no candidate.  And what is known of one set is used for sets that resemble it.  Of each list one
member, the pivot, is compared with all others.  Members that link with it are connected, whatever their similarity to
each other; and for any two members the overlaps with the pivot bound their own overlap, because x cannot share more
with y than the pivot does, plus what x shares with others beyond the pivot.  Only pairs that are neither connected nor excluded so are
compared.  A member is compared with one pivot first, and with the pivots of its other lists only while it is not in their
groups; so a large group of near copies costs about one comparison per member, not one per pair.  Links between the same
two groups are one edge, so the edges that are united grow with members and groups, not with pairs.

Frequencies count a shingle up to 255 times in a slice of documents, which is enough to put rare ones first: any one order
gives the same links.  A task sends each of its distinct shingles once, in six bytes and a count,
to the bucket of its hash; what occurs once overall ends there, and of the rest the bucket tells the task which ones they
are and how frequent.  So a text is read and cut once, a shingle of every document costs a bucket a few bytes per task,
and a document whose shingles are too often unique is known to have no partner before anything is compared.

Shingles are 64-bit hashes, of which 48 bits and the bucket's are kept.  Defined cases: a null text is the empty one; a
text without words has no shingles and is a group of its own, whatever other such texts there are.  Rows are documents,
repeated ones too; ids may repeat or be null, and a null id is no component_id while another is there.  Other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import common
from tracewell.llm.components import components
from tracewell.llm.registry import query
from tracewell.llm.shingles import shingle_sets

WORDS, PERCENT = 4, 85
SLICE = 4 << 20  # of text that is cut at once; a task holds some twenty times as much
BUCKET_BYTES = 4 << 20  # of input per bucket of shingles
MESSAGE = "target long, batch long, bucket long, body binary"
MOST_BITS = 24  # 16 million buckets, for 100 TB
HOME = -1
MORE_PIVOTS = 3  # that are drawn in lists of several groups before their members are paired
PLACE = "_place_in_input"


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT, place: Column | None = None
) -> DataFrame:
    """key, n_shingles and component_id of every row, `first`: whether the row stands for its group, and its place `row`,
    which is that of the scan unless a column has it.

    The row with the smallest id stands for it; of several with that id, the first in the input.
    """
    table = common.stored(_measured(docs, key, text, k, percent, place), "shingle-sets")
    lead = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))  # the smallest id comes first, no id last
    classes = table.filter("code IS NOT NULL").groupBy("code").agg(F.min("row").alias("row"), F.min(lead).alias("lead"))
    sets = table.filter("prefix IS NOT NULL").select("row", "size", "shared", "prefix", "body")  # bodies stay in the one table
    posted = sets.join(classes.select("row"), "row", "left_semi").select("row", "size", "shared", F.posexplode("prefix").alias("place", "h"))
    near = common.stored(_with_pivots(posted, percent), "lists")
    met = common.stored(near.filter("near").select(F.col("pivot").alias("a"), F.col("row").alias("b")).distinct(), "pivots")
    # A member is compared with one pivot, then with others only while they are in different groups.
    compared = common.stored(_overlaps(met.groupBy("b").agg(F.min("a").alias("a")), sets), "overlaps")
    links = compared.filter(_similar(percent)).select("a", "b")
    groups = _united(components(links), links.limit(0))
    apart = common.stored(_overlaps(_apart(met.join(compared.select("a", "b"), ["a", "b"], "left_anti"), groups), sets), "overlaps")
    groups = _united(groups, apart.filter(_similar(percent)).select("a", "b"))
    compared = compared.unionByName(apart)
    # A list's pivot may be unlike most of it: others, drawn from what is not in its group, find what those have in common.
    for n in range(MORE_PIVOTS):
        found = common.stored(_overlaps(_drawn(near, groups, percent, n), sets).filter(_similar(percent)).select("a", "b"), "links")
        groups = _united(groups, found)
    # Where groups of a list are still apart, all its members need their overlap with the pivot: it excludes most pairs of them.
    lists = _mixed(_grouped(near, groups))
    asked = near.filter("near").join(lists, "h", "left_semi").select(F.col("pivot").alias("a"), F.col("row").alias("b")).distinct()
    known = common.stored(_overlaps(asked.join(compared.select("a", "b"), ["a", "b"], "left_anti"), sets), "overlaps")
    asked = _unexplained(near, compared.unionByName(known), groups, percent)
    groups = _united(groups, _overlaps(asked, sets).filter(_similar(percent)).select("a", "b"))
    grouped = groups.withColumnRenamed("node", "row")
    facts = classes.join(grouped, "row", "left").withColumn("component", F.coalesce("component", "row"))
    leads = facts.groupBy("component").agg(F.min("lead").alias("lead")).select("component", "lead.id", "lead.row")
    facts = facts.select("code", "component").join(leads, "component").select("code", F.col("id").alias("component_id"), F.col("row").alias("lead"))
    found = table.select("id", "row", "n_shingles", "code").join(facts, "code", "left")
    component = F.when(F.col("code").isNull(), F.col("id")).otherwise(F.col("component_id"))
    first = F.col("code").isNull() | (F.col("row") == F.col("lead"))
    return found.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), first.alias("first"), "row")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group, with all columns of `docs`.

    The rows are stored with their places first: a second scan may be split otherwise, by the cores that are there then.
    """

    @F.pandas_udf("long")
    def as_it_is(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.kept(("shingles",), lambda: True)  # workers let go of what another step kept before rows are written
        yield from batches

    placed = common.stored(docs.withColumn(PLACE, as_it_is(F.monotonically_increasing_id())), "placed", "zstd")
    first = near_duplicates(placed, key, text, k, percent, F.col(PLACE)).filter("first").select(F.col("row").alias(PLACE))
    return placed.join(first, PLACE, "left_semi").drop(PLACE)


# -- sets and frequencies ------------------------------------------------------------------------------------------


def _measured(docs: DataFrame, key: str, text: str, k: int, percent: int, place: Column | None) -> DataFrame:
    """id, row, n_shingles, code of the set, and for sets that may have a partner: size, shared, prefix, body.

    `shared` is the number of shingles that other documents have as well, `body` those shingles in order of hash, and
    `prefix` as many of the rarest of them as the rule of prefixes asks for.
    """
    bits = min(MOST_BITS, max(4, (_bytes(docs.select(text)) // BUCKET_BYTES).bit_length()))
    row = F.monotonically_increasing_id() if place is None else place
    slim = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), row.alias("row"))
    # As many partitions as asked for, none put together: a task sorts a few buckets of a few megabytes each.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // 8)
    sent = slim.mapInArrow(_sender(k, bits), MESSAGE).repartition(parts, "target")
    counted = sent.groupBy("target").applyInArrow(_count, MESSAGE).repartition(parts, "batch")
    schema = "id long, row long, n_shingles long, code binary, size long, shared long, prefix array<long>, body binary"
    return counted.groupBy("batch").applyInArrow(_receiver(bits, percent), schema)


def _bytes(df: DataFrame) -> int:
    """Spark's own estimate of the input's size, or nothing where it has none; decides the number of buckets alone."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def _low(h: np.ndarray, bits: int) -> np.ndarray:
    """The 48 bits below the bucket's."""
    return (h << np.uint64(bits)) >> np.uint64(16)


def _joined(arrays: list[np.ndarray]) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], "<i8")
    return b"".join([np.array([len(arrays)], "<i8").tobytes(), sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def _split(body: bytes) -> list[bytes]:
    n = int(np.frombuffer(body, "<i8", 1)[0])
    sizes, at, out = np.frombuffer(body, "<i8", n, 8), 8 + 8 * n, []
    for size in sizes:
        out.append(body[at : at + int(size)])
        at += int(size)
    return out


def _six(x: np.ndarray) -> np.ndarray:
    return x.astype("<u8").view("u1").reshape(-1, 8)[:, :6]


def _from_six(b: bytes) -> np.ndarray:
    wide = np.zeros((len(b) // 6, 8), "u1")
    wide[:, :6] = np.frombuffer(b, "u1").reshape(-1, 6)
    return wide.view("<u8").ravel()


def _sender(k: int, bits: int):
    """Per slice of documents: a message with its distinct shingles to each bucket, and a row that waits for the answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.one_thread()
        common.kept(("shingles",), lambda: True)  # lets go of what another step kept
        number = TaskContext.get().partitionId() << 24
        for whole in batches:
            for cut in common.pieces_of(whole, "t", SLICE):
                for at in range(0, cut.num_rows, 60_000):
                    yield _messages(cut.slice(at, 60_000), number, k, bits)
                    number += 1
                common.release_memory()

    return run


def _messages(batch: pa.RecordBatch, number: int, k: int, bits: int) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("t").to_pylist(), k)
    sizes = np.array([len(s) for s in sets], "<i4")
    codes = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
    every = np.concatenate(sets) if sets else np.zeros(0, "u8")
    owner = np.repeat(np.arange(len(sets), dtype="<u2"), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    head = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, "i8")
    distinct, times = every[head], np.diff(np.append(head, len(every)))
    bucket = (distinct >> np.uint64(64 - bits)).astype("i8")
    low = _six(_low(distinct, bits))
    counts = np.minimum(times, 255).astype("u1")
    cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    targets, bodies = [], []
    for b in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[b], cuts[b + 1])
        targets.append(int(b))
        bodies.append(_joined([low[part], counts[part]]))
    ids = batch.column("id")
    known = np.asarray(ids.is_valid())
    home = [ids.fill_null(0).to_numpy(), known.astype("u1"), batch.column("row").to_numpy(), sizes, np.frombuffer(codes, "u1"), cuts, times.astype("<u2"), owner]
    home = [a.astype("<i8") if a.dtype == "i8" else a for a in home]
    n = len(targets)
    return pa.record_batch(
        [
            pa.array([*targets, number % (1 << bits)], pa.int64()),
            pa.array([number] * (n + 1), pa.int64()),
            pa.array([*targets, HOME], pa.int64()),
            pa.array([*bodies, _joined(home)], pa.binary()),
        ],
        ["target", "batch", "bucket", "body"],
    )


def _count(table: pa.Table) -> pa.Table:
    """One bucket: tell each slice which of its shingles other documents have as well, and how frequent they are."""
    bucket = table["bucket"].to_numpy()
    homes = table.filter(pa.array(bucket == HOME))
    asked = table.filter(pa.array(bucket != HOME))
    batches, answers = [], []
    if asked.num_rows:
        parts = [_split(b) for b in asked["body"].to_pylist()]
        sizes = np.array([len(p[1]) for p in parts])
        low = np.concatenate([_from_six(p[0]) for p in parts])
        times = np.concatenate([np.frombuffer(p[1], "u1") for p in parts]).astype("i8")
        del parts
        order = np.argsort(low, kind="stable")
        ordered = low[order]
        head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        run = np.cumsum(head) - 1
        total = np.bincount(run, weights=times[order]).astype("i8")[run]
        kept = order[total > 1]
        frequency = np.zeros(len(low), "i8")
        frequency[kept] = total[total > 1]
        ends = np.cumsum(sizes)
        for number, start, end in zip(asked["batch"].to_pylist(), ends - sizes, ends, strict=True):
            place = np.flatnonzero(frequency[start:end])
            if len(place):
                batches.append(number)
                answers.append(
                    _joined([place.astype("<u4"), _six(low[start:end][place]), np.minimum(frequency[start:end][place], 0xFFFFFFFF).astype("<u4")])
                )
    answer = pa.table(
        {
            "target": pa.array([0] * len(batches), pa.int64()),
            "batch": pa.array(batches, pa.int64()),
            "bucket": pa.array([int(bucket.max())] * len(batches), pa.int64()),
            "body": pa.array(answers, pa.binary()),
        }
    )
    return pa.concat_tables([homes.cast(answer.schema), answer])


def _receiver(bits: int, percent: int):
    """Per slice of documents: from the answers of all buckets, the rows of its documents."""

    def run(table: pa.Table) -> pa.Table:
        buckets, bodies = table["bucket"].to_pylist(), table["body"].to_pylist()
        home = _split(bodies[buckets.index(HOME)])
        kinds = ("<i8", "u1", "<i8", "<i4", "u1", "<i8", "<u2", "<u2")
        ids, known, rows, sizes, codes, cuts, times, owner = (np.frombuffer(b, t) for b, t in zip(home, kinds, strict=True))
        starts = np.cumsum(times, dtype="i8") - times
        found = [(np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "u4"))]
        for bucket, body in zip(buckets, bodies, strict=True):
            if bucket == HOME:
                continue
            place, low, frequency = _split(body)
            name = (_from_six(low) | (np.uint64(bucket) << np.uint64(48))).view("i8") if bits <= 16 else _wide(_from_six(low), bucket, bits)
            found.append((np.frombuffer(place, "<u4").astype("i8") + cuts[bucket], name, np.frombuffer(frequency, "<u4")))
        place, name, frequency = (np.concatenate(x) for x in zip(*found, strict=True))
        n = times[place].astype("i8")
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        doc = owner[np.repeat(starts[place], n) + within]
        name, frequency = np.repeat(name, n), np.repeat(frequency, n)
        order = np.lexsort((name, frequency, doc))
        doc, name = doc[order], name[order]
        ends = np.searchsorted(doc, np.arange(len(ids) + 1))
        out: dict[str, list] = {c: [] for c in ("code", "size", "shared", "prefix", "body")}
        seen = set()
        for i, size in enumerate(sizes.tolist()):
            code = codes[16 * i : 16 * i + 16].tobytes()
            shared = int(ends[i + 1] - ends[i])
            needed = -(-percent * size // 100)
            # With fewer shared shingles than a partner must have there is none; copies in a slice are one set.
            may = size * (100 - percent) >= percent and shared >= needed and code not in seen
            seen.add(code)
            mine = name[ends[i] : ends[i + 1]] if may else None
            out["code"].append(code if size else None)
            out["size"].append(size)
            out["shared"].append(shared)
            out["prefix"].append(mine[: shared - needed + 1] if may else None)
            out["body"].append(np.sort(mine).tobytes() if may else None)
        return pa.table(
            {
                "id": pa.array(ids, pa.int64(), mask=known == 0),
                "row": pa.array(rows, pa.int64()),
                "n_shingles": pa.array(sizes.astype("i8"), pa.int64()),
                "code": pa.array(out["code"], pa.binary()),
                "size": pa.array(out["size"], pa.int64()),
                "shared": pa.array(out["shared"], pa.int64()),
                "prefix": pa.array(out["prefix"], pa.list_(pa.int64())),
                "body": pa.array(out["body"], pa.binary()),
            }
        )

    return run


def _wide(low: np.ndarray, bucket: int, bits: int) -> np.ndarray:
    """The hash as a number, where bucket and low bits overlap."""
    return ((low >> np.uint64(bits - 16)) | (np.uint64(bucket) << np.uint64(64 - bits))).view("i8")


# -- lists ----------------------------------------------------------------------------------------------------------


def _needed(size_a: Column, size_b: Column, percent: int) -> Column:
    """The overlap from which sets of these sizes link."""
    return F.ceil(percent * (size_a + size_b) / (100 + percent) - F.lit(1e-9)).cast("long")


def _similar(percent: int) -> Column:
    return 100 * F.col("overlap") >= percent * (F.col("size_a") + F.col("size_b") - F.col("overlap"))


def _candidate(a: str, b: str, percent: int) -> Column:
    """Whether sizes, and what stands after the common shingle, leave room for a link (if it is their first)."""
    c = {x: (F.col(f"{x}size"), F.col(f"{x}shared") - F.col(f"{x}place")) for x in (a, b)}
    (size_a, left_a), (size_b, left_b) = c[a], c[b]
    sizes = 100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)
    return sizes & (F.least(left_a, left_b) >= _needed(size_a, size_b, percent))


def _with_pivots(posted: DataFrame, percent: int) -> DataFrame:
    """Postings of lists of two or more with their list's pivot, and whether the pivot and they are candidates."""
    pivots = posted.groupBy("h").agg(F.min(F.struct("row", "size", "shared", "place")).alias("p"), F.count("*").alias("n")).filter("n > 1")
    met = posted.join(pivots, "h").select(
        "h", "row", "size", "shared", "place", F.col("p.row").alias("pivot"), F.col("p.size").alias("p_size"), F.col("p.shared").alias("p_shared"),
        F.col("p.place").alias("p_place"),
    )
    return met.withColumn("near", (F.col("row") != F.col("pivot")) & _candidate("", "p_", percent))


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, size_a, size_b and the exact overlap of pairs of rows."""
    slim = {s: sets.select(F.col("row").alias(s), F.col("size").alias(f"size_{s}"), F.col("body").alias(f"body_{s}")) for s in ("a", "b")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(f"body_{s}").to_pylist() for s in ("a", "b"))
            found = [len(np.intersect1d(np.frombuffer(x, "<i8"), np.frombuffer(y, "<i8"), assume_unique=True)) for x, y in zip(a, b, strict=True)]
            names = ["a", "b", "size_a", "size_b"]
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(found, pa.int64())], [*names, "overlap"])

    joined = pairs.join(slim["a"], "a").join(slim["b"], "b").select("a", "b", "size_a", "size_b", "body_a", "body_b")
    return joined.mapInArrow(run, "a long, b long, size_a long, size_b long, overlap long")


def _united(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """node and component, after edges between nodes were added: of the edges between two groups one is enough."""
    of = {s: groups.select(F.col("node").alias(s), F.col("component").alias(f"of_{s}")) for s in ("a", "b")}
    named = edges.join(of["a"], "a", "left").join(of["b"], "b", "left")
    between = named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).filter("a <> b").distinct()
    joined = common.stored(components(between), "united")
    now = groups.join(joined.select(F.col("node").alias("component"), F.col("component").alias("_now")), "component", "left")
    alone = joined.join(groups.select("node"), "node", "left_anti")
    return common.stored(now.select("node", F.coalesce("_now", "component").alias("component")).unionByName(alone), "groups")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of rows that are in different groups."""
    of = {s: groups.select(F.col("node").alias(s), F.col("component").alias(f"of_{s}")) for s in ("a", "b")}
    named = pairs.join(of["a"], "a", "left").join(of["b"], "b", "left")
    return named.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _grouped(near: DataFrame, groups: DataFrame) -> DataFrame:
    return near.join(groups.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))


def _mixed(grouped: DataFrame) -> DataFrame:
    """The lists whose members are in several groups."""
    spread = grouped.groupBy("h").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return spread.filter("least <> most").select("h")


def _drawn(near: DataFrame, groups: DataFrame, percent: int, n: int) -> DataFrame:
    """In each list of several groups one member that is not in the pivot's, with the candidates in other groups than its own.

    It is drawn by hash, so that it probably comes from the largest group, and is the same one in lists of the same members.
    """
    grouped = _grouped(near, groups)
    members = grouped.join(_mixed(grouped), "h")
    at_pivot = members.filter("row = pivot").select("h", F.col("component").alias("_of_pivot"))
    others = members.join(at_pivot, "h").filter("component <> _of_pivot").select("h", "row", "size", "shared", "place", "component")
    draw = F.min_by(F.struct("row", "size", "shared", "place", "component"), F.xxhash64("row", F.lit(n))).alias("q")
    names = ("row", "size", "shared", "place", "component")
    drawn = others.groupBy("h").agg(draw).select("h", *(F.col(f"q.{c}").alias(f"q_{c}") for c in names))
    met = others.join(drawn, "h").filter((F.col("component") != F.col("q_component")) & _candidate("", "q_", percent))
    return met.select(F.least("row", "q_row").alias("a"), F.greatest("row", "q_row").alias("b")).distinct()


def _unexplained(near: DataFrame, compared: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a list that are in different groups, and whose overlaps with the pivot do not exclude a link."""
    known = compared.select(F.col("a").alias("pivot"), F.col("b").alias("row"), "overlap")
    grouped = _grouped(near, groups)
    members = grouped.join(_mixed(grouped), "h").filter("row <> pivot").join(known, ["pivot", "row"], "left")
    # Sets of one list meet within a band of sizes, or the band below.
    band = F.floor(F.log("size") / F.log(F.lit(100 / percent))).cast("long")
    slim = members.select("h", "row", "size", "shared", "place", "component", "overlap", band.alias("band"))
    x = slim.select("h", "band", *(F.col(c).alias(f"x_{c}") for c in ("row", "size", "shared", "place", "component", "overlap")))
    y = slim.select("h", F.explode(F.array(F.col("band"), F.col("band") - 1, F.col("band") - 2)).alias("band"),
                    *(F.col(c).alias(f"y_{c}") for c in ("row", "size", "shared", "place", "component", "overlap")))
    ordered = (F.col("x_size") < F.col("y_size")) | ((F.col("x_size") == F.col("y_size")) & (F.col("x_row") < F.col("y_row")))
    needed = _needed(F.col("x_size"), F.col("y_size"), percent)
    beyond = lambda a, b: F.coalesce(F.col(f"{b}_overlap") + F.col(f"{a}_shared") - F.col(f"{a}_overlap") >= needed, F.lit(True))
    open_ = ordered & (F.col("x_component") != F.col("y_component")) & _candidate("x_", "y_", percent) & beyond("x", "y") & beyond("y", "x")
    return x.join(y, ["h", "band"]).filter(open_).select(F.col("x_row").alias("a"), F.col("y_row").alias("b")).distinct()


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
  n AS (SELECT doc_id, len(s) AS n FROM s),
  e AS (SELECT doc_id, unnest(s) AS h FROM s),
  i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM e x JOIN e y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
  o AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
  l AS (SELECT a, b FROM o UNION ALL SELECT b, a FROM o),
  r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
  c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM n LEFT JOIN c ON c.a = doc_id"""


@query("op5_jaccard_join", SQL)
def op5_jaccard_join(spark, folder):
    return near_duplicates(common.read(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
