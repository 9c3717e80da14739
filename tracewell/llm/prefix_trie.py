"""Conversation prefixes as a trie, from whole sequences.

A node is a sequence of first turns.  Identical conversations are collapsed into one weighted sequence first; a sequence
that is a proper prefix of another one is found by an anti-join, what is left are the trie's leaves; then the
sequences' prefixes are summed up, each with its sequence's weight.

* A prefix is named by its depth and the exclusive-or of its turns' hashes, each hash with its place (two lanes, 128 bits).
  That can be summed up in any order, so a long conversation is cut into blocks of turns and no window spans it.
* What a node saves over its subtree is a sum over the sequences through it: the words from there on, times the weight,
  less the words of nodes that the sequence owns.  A node is owned by its smallest member, so each counts once, and no node
  is paired with its ancestors.
* A node's owner comes back to its rows by a join.  Nodes with over a ten-thousandth of all rows (at most ten thousand,
  then) are broadcast, all others are shuffled, so no common first turn is one task's work.
* The ids that end in a node are joined in chunks of 4,096 neighbouring ids and hashed chunk by chunk, in order.

Defined cases: a null role or text is empty.  Rows without a conv_id belong to no conversation and are left out.  Null turns come
first; rows with equal turns are ordered by role and text, repeated rows are turns of their own.  An empty table has no
conversations and so no nodes, not even a root.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.llm import common
from tracewell.llm.registry import query

FAMILY = 20  # conversations whose beginnings are exchanged
LONGEST_HEAD = 3
BLOCK_BITS = 12  # turns of a conversation, and ids of a list of ends, that are taken together
HOT = 10_000  # a node with more than this part of all rows is broadcast
NODE = ["depth", "k1", "k2"]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), mark (digest of role and text) and words of every turn.

    Turns are numbered within blocks of neighbouring turn numbers; a count per block says where each block begins.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.shiftright("turn", BLOCK_BITS).alias("_block")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("_block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "_block").agg(F.count("*").alias("n"))
    blocks = blocks.select(F.col("conv_id").alias("_c"), F.col("_block").alias("_b"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_before"))
    within = Window.partitionBy("conv_id", "_block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.join(blocks, (F.col("conv_id") == F.col("_c")) & F.col("_block").eqNullSafe(F.col("_b")))
    return placed.select(
        "conv_id",
        (F.col("_before") + F.row_number().over(within)).alias("pos"),
        F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("mark"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """The turns of every conversation after its first few were replaced by those of its family's first one."""
    heads = own.filter(F.col("pos") <= LONGEST_HEAD).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "mark", "words"))).alias("head")
    )
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_HEAD + 1)
    convs = (
        own.groupBy("conv_id")
        .agg(F.count("*").alias("n"))
        .select("conv_id", "n", taken.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("_first"))
        .join(heads.withColumnRenamed("conv_id", "_first"), "_first", "left")
        .select("conv_id", "n", "h", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")).alias("head"))
    )
    new = convs.select("conv_id", F.inline("head"))
    moved = convs.select("conv_id", (F.size("head") - F.col("h")).alias("by"), "h", _blocks_up_to(F.col("n")).alias("_block"))
    kept = (
        own.withColumn("_block", _block(F.col("pos")))
        .join(moved, ["conv_id", "_block"])
        .filter(F.col("pos") > F.col("h"))
        .select("conv_id", (F.col("pos") + F.col("by")).alias("pos"), "mark", "words")
    )
    root = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("mark"), F.lit(0).cast("long").alias("words"))
    return root.unionByName(new).unionByName(kept)


def _block(pos: Column) -> Column:
    return F.shiftright(pos, BLOCK_BITS)


def _blocks_up_to(n: Column) -> Column:
    """One row per block of a conversation, so that a long one meets what belongs to it in many tasks."""
    return F.explode(F.sequence(F.lit(0).cast("long"), _block(n)))


def prefixes(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, block, depth, k1, k2, words) per turn of (conv_id, pos, mark, words), and (conv_id, depth, k1, k2) of the wholes.

    Every conversation has a row with pos 0.
    """
    lane = [F.when(F.col("pos") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "pos", "mark")) for seed in ("a", "b")]
    rows = sequences.select("conv_id", _block(F.col("pos")).alias("block"), F.col("pos").alias("depth"), lane[0].alias("x1"), lane[1].alias("x2"), "words")
    rows = common.stored(rows, "trie-turns")
    blocks = rows.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.max("depth").alias("last"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = blocks.select("conv_id", "block", *(F.coalesce(F.bit_xor(f"b{i}").over(before), zero).alias(f"c{i}") for i in (1, 2)))
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    keyed = rows.join(carried, ["conv_id", "block"]).select(
        "conv_id", "block", "depth", *(F.col(f"c{i}").bitwiseXOR(F.bit_xor(f"x{i}").over(within)).alias(f"k{i}") for i in (1, 2)), "words"
    )
    wholes = blocks.groupBy("conv_id").agg(F.max("last").alias("depth"), F.bit_xor("b1").alias("k1"), F.bit_xor("b2").alias("k2"))
    return keyed, wholes


def collapsed(wholes: DataFrame) -> DataFrame:
    """depth, k1, k2, conv_id (smallest), weight, ends_sha256 of each distinct sequence."""
    weights = wholes.groupBy(NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))
    return weights.join(_ends(wholes), NODE)


def _ends(wholes: DataFrame) -> DataFrame:
    """depth, k1, k2, and the digest of the ids that end there, ascending and joined by commas.

    Ids come in chunks that are put in order by Spark; a task holds one digest and one batch of chunks.
    """
    chunks = wholes.groupBy(*NODE, F.shiftright("conv_id", BLOCK_BITS).alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield made(done)
        if now is not None:
            yield made([(*now, digest.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [*NODE, "ends_sha256"])

    ordered = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")
    return ordered.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, pos, mark, words), pos from 0 (no turn) without gaps."""
    keyed, wholes = prefixes(sequences)
    seqs = common.stored(collapsed(wholes), "trie-sequences")
    spread = seqs.select("conv_id", F.col("depth").alias("n"), "weight", _blocks_up_to(F.col("depth")).alias("block"))
    paths = common.stored(keyed.join(spread, ["conv_id", "block"]), "trie-paths")

    known = common.stored(
        paths.groupBy(NODE).agg(F.min("conv_id").alias("owner"), F.count("*").alias("rows"), F.max(F.col("depth") < F.col("n")).alias("inner")), "trie-nodes"
    )
    leaves = seqs.join(known.filter("inner").select(NODE), NODE, "left_anti").select("conv_id")
    owned = _with_owner(paths, known)

    # Per block: what the blocks behind it hold, and who owns the turn before it and the one after it.
    mine = F.col("owner") == F.col("conv_id")
    blocks = owned.groupBy("conv_id", "block").agg(
        F.sum("words").alias("w"),
        F.sum(F.when(mine, F.col("words")).otherwise(0)).alias("o"),
        F.max_by("owner", "depth").alias("last"),
        F.min_by(mine, "depth").alias("first_mine"),
    )
    along = Window.partitionBy("conv_id").orderBy("block")
    behind = along.rowsBetween(1, Window.unboundedFollowing)
    carried = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("w").over(behind), F.lit(0)).alias("w_behind"),
        F.coalesce(F.sum("o").over(behind), F.lit(0)).alias("o_behind"),
        F.lag("last").over(along).alias("owner_before"),
        F.lead("first_mine").over(along).alias("mine_next"),
    ).join(leaves.withColumn("leaf", F.lit(1)), "conv_id", "left")

    order = Window.partitionBy("conv_id", "block").orderBy("depth")
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    rows = (
        owned.join(carried, ["conv_id", "block"])
        .withColumn("_mine", mine)
        .select(
            *NODE,
            "conv_id",
            "weight",
            F.coalesce("leaf", F.lit(0)).alias("leaf"),
            F.coalesce(F.lag("owner").over(order), F.col("owner_before")).alias("parent"),
            F.coalesce(F.lead("_mine").over(order), F.col("mine_next"), F.lit(False)).cast("int").alias("child"),
            ((F.sum("words").over(from_here) + F.col("w_behind")) * F.col("weight")).alias("used"),
            (F.sum(F.when(F.col("_mine"), F.col("words")).otherwise(0)).over(from_here) + F.col("o_behind")).alias("needed"),
        )
    )
    nodes = rows.groupBy(NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("parent").alias("parent_conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum("child").cast("long").alias("n_children"),
        F.sum("leaf").cast("long").alias("n_leaves"),
        F.sum(F.col("used") - F.col("needed")).alias("saved_tokens"),
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(seqs.select(*NODE, "ends_sha256"), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )


def _with_owner(paths: DataFrame, known: DataFrame) -> DataFrame:
    """The rows with the owner of their node; rows of common nodes stay where they are."""
    rows = known.agg(F.sum("rows")).first()[0] or 0
    common_node = F.col("rows") * HOT > rows
    hot = known.filter(common_node).select(*NODE, "owner")  # fewer than HOT nodes
    others = known.filter(~common_node).select(*NODE, F.col("owner").alias("_owner"))
    seen = paths.join(F.broadcast(hot), NODE, "left")
    met = seen.filter("owner IS NULL").join(others, NODE).select(*paths.columns, F.col("_owner").alias("owner"))
    return seen.filter("owner IS NOT NULL").unionByName(met)


def ends(sequences: DataFrame) -> DataFrame:
    """conv_id and whole_of, the smallest conversation with the same turns."""
    wholes = prefixes(sequences)[1]
    least = wholes.groupBy(NODE).agg(F.min("conv_id").alias("whole_of"))
    return wholes.join(least, NODE).select("conv_id", "whole_of")


# Nodes as lists of turns, compared whole.
SQL = r"""
WITH named AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
           {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(said ORDER BY pos) AS turns,
           xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
               lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 4 AS h
    FROM named GROUP BY conv_id
), made AS (
    SELECT c.conv_id, list_concat(coalesce(f.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
    FROM own c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 20
), paths AS (
    SELECT conv_id, len(turns) AS n, depth, turns[1:depth] AS prefix, turns[1:depth - 1] AS above,
           CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(turns[depth].text, '[^\x20\x09-\x0D]+')) END AS words
    FROM made, unnest(range(len(turns) + 1)) AS u(depth)
), nodes AS (
    SELECT prefix, any_value(above) AS above, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM paths GROUP BY prefix
), children AS (
    SELECT above, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above
), counted AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.above = n.prefix
), subtrees AS (
    SELECT prefix[1:d] AS top, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children = 0) AS leaves
    FROM counted, unnest(range(depth + 1)) AS u(d) GROUP BY prefix[1:d]
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs, n.n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees s ON s.top = n.prefix LEFT JOIN nodes p ON p.prefix = n.above
"""


@query("op11_prefix_trie", SQL)
def op11_prefix_trie(spark, folder):
    return trie(rebuilt(common.stored(turns(common.read(spark, folder, "conversations")), "own-turns")))
