"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with cosine >= c are at most eps = sqrt(2 - 2c) apart.  Vectors are projected to their leading principal
directions and sorted by the cells of a grid of width eps there (then by the coordinates), and the order is cut into
blocks.  The join then works on intervals of the order: an interval has the box that its vectors' coordinates span, and
where two boxes are more than eps apart no pair of theirs can link, so the pair of intervals is skipped; otherwise both
are halved.  On tables this goes down from one interval to pairs of blocks (each level is a join with the boxes of the
next), and within a pair of blocks it goes on in numpy, down to tiles that are multiplied out.

Equal vectors are one class, with a size.  A pair of blocks gives each class the number of vectors it links with and one
edge to the smallest class it is connected with there, so no list of pairs is ever made, however many near copies meet.
Nothing is approximate: boxes only skip what is provably distant, cosines are double precision, and those within 1e-9 of
the threshold are computed again from the vectors themselves.

The principal directions come from a sample of at most `sample_rows` vectors; they decide what can be skipped, not what
links.

Defined cases: vectors that are null, empty or zero, or hold null, NaN or infinite components, link with nothing, not
even with their like.  Of vectors of different length the shorter counts as filled up with zeros.  A repeated row is a
vector of its own and links with its copy; ids may repeat or be null, and a null id is no component_id while another is
there.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.llm import common
from tracewell.llm.components import components
from tracewell.llm.registry import query

AXES = 4  # grid dimensions
BOX_AXES = 16  # dimensions that boxes have
BLOCK = 4096
FAN = 8  # blocks, and nodes above them, per node
TILE = 256
SAMPLE_ROWS = 4096


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """key, n_links, component_id and kept of every row."""
    spark = vectors.sparkSession
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    slim = vectors.select(
        F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(embedding).cast("array<double>").alias("e")
    )
    rows = common.stored(slim.mapInArrow(_coded, "id long, row long, code binary, v binary, n int"), "vectors")
    valid = rows.filter(F.col("code").isNotNull())
    width = valid.agg(F.max("n")).first()[0]
    if width is None:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    axes = _axes(valid, width)
    # One row per class of equal vectors; `low` is its smallest id.
    classes = valid.groupBy("code").agg(F.first("v").alias("v"), F.count("*").alias("size"), F.min("id").alias("low"))
    n = valid.select(F.approx_count_distinct("code")).first()[0]
    sorted_ = _sorted(classes, axes, width, eps, max(1, n // BLOCK))
    blocks = _blocks(sorted_, axes, width)
    pairs = _block_pairs(blocks.select("block", "lo", "hi"), eps)
    # Pairs are dealt out evenly first: a block that meets all others is no task of its own.
    dealt = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    bodies = [blocks.select(F.col("block").alias(side), F.col("body").alias(f"body_{side}")) for side in ("a", "b")]
    met = common.stored(
        dealt.join(bodies[0], "a").join(bodies[1], "b").mapInArrow(_joiner(axes, width, cosine, eps), "pos long, links long, root long"), "links"
    )
    links = met.groupBy("pos").agg(F.sum("links").alias("links"))
    grouped = components(met.select(F.col("pos").alias("a"), F.col("root").alias("b")))
    facts = sorted_.select("pos", "code", "size", "low").join(links, "pos", "left").join(grouped.withColumnRenamed("node", "pos"), "pos", "left")
    facts = facts.withColumn("component", F.coalesce("component", "pos"))
    lowest = facts.groupBy("component").agg(F.min("low").alias("component_id"))
    facts = facts.join(lowest, "component").select("code", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    # A common vector has many rows and one fact: its rows stay spread, the join is left to skew handling.
    out = rows.select("id", "code").join(facts, "code", "left")
    component = F.when(F.col("code").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A vector as bytes of doubles without closing zeros, and a code of them; neither if it cannot link."""
    for batch in batches:
        codes, bodies, sizes = [], [], []
        for e in batch.column("e").to_pylist():
            v = np.array(e if e and None not in e else (), "<f8")
            if not len(v) or not np.isfinite(v).all() or not v.any():
                codes.append(None)
                bodies.append(None)
                sizes.append(None)
                continue
            v = np.trim_zeros(v, "b") + 0.0  # -0.0 is 0.0
            codes.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest())
            bodies.append(v.tobytes())
            sizes.append(len(v))
        columns = [pa.array(codes, pa.binary()), pa.array(bodies, pa.binary()), pa.array(sizes, pa.int32())]
        yield pa.record_batch([batch.column("id"), batch.column("row"), *columns], ["id", "row", "code", "v", "n"])


def _matrix(bodies: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(bodies), width))
    for i, b in enumerate(bodies):
        v = np.frombuffer(b, "<f8")
        out[i, : len(v)] = v
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _axes(valid: DataFrame, width: int) -> np.ndarray:
    """Leading principal directions of a sample, as orthonormal columns, most spread first."""
    rows = valid.count()
    drawn = valid.filter(F.pmod(F.xxhash64("code"), F.lit(1 << 20)) <= F.lit(int(min(1.0, SAMPLE_ROWS / max(1, rows)) * (1 << 20))))
    sample = [bytes(r["v"]) for r in drawn.select("code", "v").dropDuplicates(["code"]).limit(2 * SAMPLE_ROWS).select("v").collect()]
    x = _unit(_matrix(sample, width)) if sample else np.zeros((1, width))
    _, _, directions = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    return directions[:BOX_AXES].T.copy()


def _sorted(classes: DataFrame, axes: np.ndarray, width: int, eps: float, parts: int) -> DataFrame:
    """The classes with their place `pos` in the grid order, stored."""
    many = min(AXES, axes.shape[1])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.one_thread()
        for batch in batches:
            if not batch.num_rows:
                continue
            spots = _unit(_matrix(batch.column("v").to_pylist(), width)) @ axes[:, :many]
            cells = np.floor(spots / eps).astype("i4")
            columns = [pa.array(list(cells), pa.list_(pa.int32())), pa.array(list(spots), pa.list_(pa.float64()))]
            yield pa.record_batch([*batch.columns, *columns], [*batch.schema.names, "cells", "spots"])

    placed = classes.mapInArrow(project, "code binary, v binary, size long, low long, cells array<int>, spots array<double>")
    order = ["cells", "spots", "code"]
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kept = common.stored(
        ranged.select("code", "v", "size", "low", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i")), "grid-order"
    )
    # `i` rises along the order: partitions are ranges.  Ranks within a part, plus the sizes of the parts before.
    sizes = kept.groupBy("part").agg(F.count("*").alias("n"), F.min("i").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row per block or so
    return kept.join(starts, "part").select((F.col("start") + F.col("i") - F.col("first")).alias("pos"), "code", "v", "size", "low")


def _blocks(sorted_: DataFrame, axes: np.ndarray, width: int) -> DataFrame:
    """A row per block: the box of its vectors' coordinates, and its places, sizes and vectors; stored."""

    def pack(table: pa.Table) -> pa.Table:
        common.one_thread()
        t = table.sort_by("pos")
        pos, size, x = t["pos"].to_numpy(), t["size"].to_numpy(), _matrix(t["v"].to_pylist(), width)
        spots = _unit(x) @ axes
        body = pos.astype("<i8").tobytes() + size.astype("<i8").tobytes() + x.astype("<f8").tobytes()
        return pa.table(
            {
                "block": pa.array([int(pos[0]) // BLOCK], pa.int64()),
                "lo": pa.array([spots.min(axis=0).tolist()], pa.list_(pa.float64())),
                "hi": pa.array([spots.max(axis=0).tolist()], pa.list_(pa.float64())),
                "body": pa.array([body], pa.binary()),
            }
        )

    packed = sorted_.select("pos", "size", "v", F.floor(F.col("pos") / BLOCK).alias("block")).groupBy("block")
    return common.stored(packed.applyInArrow(pack, "block long, lo array<double>, hi array<double>, body binary"), "vector-blocks")


def _unpacked(body: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(body) // (16 + 8 * width)
    numbers = np.frombuffer(body, "<i8", 2 * n)
    return numbers[:n], numbers[n:], np.frombuffer(body, "<f8", offset=16 * n).reshape(n, width)


def _block_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """Pairs a <= b of blocks whose boxes come within eps of each other, found from the top of a tree of boxes down."""
    spark = boxes.sparkSession
    axes = boxes.select(F.max(F.size("lo"))).first()[0]
    levels = [boxes.withColumnRenamed("block", "node")]
    top = boxes.agg(F.max("block")).first()[0]
    while top > 0:
        top //= FAN
        up = levels[-1].groupBy(F.floor(F.col("node") / FAN).alias("node"))
        lo, hi = ([f(F.get(c, F.lit(i))) for i in range(axes)] for f, c in ((F.min, "lo"), (F.max, "hi")))
        levels.append(up.agg(F.array(*lo).alias("lo"), F.array(*hi).alias("hi")))
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(levels[:-1]):
        children = [F.explode(F.sequence(F.col(side) * FAN, F.col(side) * FAN + (FAN - 1))).alias(side) for side in ("a", "b")]
        pairs = pairs.select(children[0], "b").select("a", children[1]).filter("a <= b")
        for side in ("a", "b"):
            pairs = pairs.join(level.select(F.col("node").alias(side), F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}")), side)
        pairs = pairs.filter(_gap() <= eps * eps).select("a", "b")
    return pairs


def _gap() -> Column:
    """Squared distance of two boxes."""
    apart = F.zip_with(
        F.zip_with("lo_a", "hi_b", lambda x, y: x - y), F.zip_with("lo_b", "hi_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))
    )
    return F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x)


def _joiner(axes: np.ndarray, width: int, cosine: float, eps: float):
    """A function over rows of two blocks: places with links, how many, and the smallest place each is connected to."""

    def boxes(spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.arange(0, len(spots), TILE)
        return np.minimum.reduceat(spots, starts), np.maximum.reduceat(spots, starts)

    def join(body_a: bytes, body_b: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pos_a, size_a, x_a = _unpacked(body_a, width)
        unit_a = _unit(x_a)
        pos_b, size_b, x_b, unit_b = (pos_a, size_a, x_a, unit_a) if body_b is None else (*(u := _unpacked(body_b, width)), _unit(u[2]))
        spots_a, spots_b = unit_a @ axes, unit_b @ axes
        (lo_a, hi_a), (lo_b, hi_b) = boxes(spots_a), boxes(spots_b)
        offset = 0 if body_b is None else len(pos_a)
        links = np.zeros(offset + len(pos_b), "i8")
        parent = np.arange(offset + len(pos_b))
        for i in range(len(lo_a)):
            gap = np.maximum(0, np.maximum(lo_a[i] - hi_b, lo_b - hi_a[i]))
            near = np.flatnonzero((gap * gap).sum(axis=1) <= eps * eps)
            if not len(near):
                continue
            rows = np.arange(i * TILE, min((i + 1) * TILE, len(pos_a)))
            others = np.concatenate([np.arange(j * TILE, min((j + 1) * TILE, len(pos_b))) for j in near])
            cosines = unit_a[rows] @ unit_b[others].T
            r, o = np.nonzero(cosines >= cosine - 1e-9)
            if not len(r):
                continue
            value, r, o = cosines[r, o], rows[r], others[o]
            sure = np.abs(value - cosine) > 1e-9
            for k in np.flatnonzero(~sure):
                sure[k] = _cosine(x_a[r[k]], x_b[o[k]]) >= cosine
            if body_b is None:
                sure &= r != o
            r, o = r[sure], o[sure]
            np.add.at(links, r, size_b[o])
            if body_b is not None:
                np.add.at(links, o + offset, size_a[r])
            _unite(parent, r, o + offset)
        pos = pos_a if body_b is None else np.concatenate([pos_a, pos_b])
        met = np.flatnonzero(links)
        return pos[met], links[met], pos[parent[met]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.one_thread()
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = batch.column("a")[i].as_py(), batch.column("b")[i].as_py()
                out = join(batch.column("body_a")[i].as_py(), None if a == b else batch.column("body_b")[i].as_py())
                yield pa.record_batch([pa.array(x, pa.int64()) for x in out], ["pos", "links", "root"])

    return run


def _cosine(x: np.ndarray, y: np.ndarray) -> float:
    x, y = (np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) for v in (x, y))  # exact, and no square overflows
    return float(np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)))


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make connected places share the smallest as their parent; `parent` holds roots before and after."""
    while len(a):
        x, y = parent[a], parent[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        low = np.minimum(x, y)
        np.minimum.at(parent, x, low)
        np.minimum.at(parent, y, low)
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


@query(
    "op4_embedding_join",
    """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
      n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS s FROM v
            WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
      l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.vec_id <> y.vec_id AND list_dot_product(x.e, y.e) / (x.s * y.s) >= 0.9),
      r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
      c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a),
      d AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
    SELECT v.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, v.vec_id) AS component_id,
      v.vec_id = coalesce(component_id, v.vec_id) AS kept
    FROM v LEFT JOIN c ON c.a = v.vec_id LEFT JOIN d ON d.a = v.vec_id""",
)
def op4_embedding_join(spark, folder):
    return near_duplicates(common.read(spark, folder, "embeddings"))
