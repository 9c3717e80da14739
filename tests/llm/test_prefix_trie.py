import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tracewell.llm import prefix_trie


def odd_tables():
    rng = random.Random(4)
    texts = [None, "", "a", "a b", " \t\x0b ", "é — ü", "x" * 30_000, "b", " "]
    roles = ["user", "assistant", None, "", "system"]
    shared = [(rng.choice(roles), rng.choice(texts)) for _ in range(9)]
    for conv in [*range(0, 130), *range(1000, 1012), 4096 * 5 + 3, -7, None]:
        if conv is not None and 40 <= conv < 45:
            continue
        said = shared[: rng.randint(1, 9)]
        if rng.random() < 0.4:
            said = [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(1, 7))]
        for turn, (role, text) in enumerate(said):
            row = (conv, rng.choice([turn, turn, turn, turn, 2, None]), role, text)
            yield row
            if rng.random() < 0.1:
                yield row


@pytest.mark.parametrize(("bits", "hot"), [(12, 10_000), (1, 4), (0, 1)])
def test_odd_rows_equal_the_sql(spark, tmp_path, monkeypatch, bits, hot):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits)
    monkeypatch.setattr(prefix_trie, "HOT", hot)
    path = str(tmp_path / "conversations.parquet")
    frame = spark.createDataFrame(list(odd_tables()), "conv_id long, turn long, role string, text string")
    frame.withColumns({"depth": F.lit("x"), "owner": F.lit(1)}).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    names = [d[0] for d in con.execute(prefix_trie.SQL).description]
    want = con.execute(prefix_trie.SQL).fetchall()
    got = [tuple(r) for r in prefix_trie.op11_prefix_trie(spark, str(tmp_path)).select(names).collect()]
    assert len(got) > 200 and sorted(got, key=repr) == sorted(want, key=repr)
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(frame.limit(0)))).count() == 0


def by_hand(convs):
    """Nodes of {conv_id: turns}, by running over all prefixes and, for each node, all nodes below it."""
    members, full = {}, {}
    for c in sorted(convs):
        said = tuple(convs[c])
        full.setdefault(said, []).append(c)
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append(c)
    value = {n: (len(m) - 1) * (len(n[-1][1].split()) if n else 0) for n, m in members.items()}
    parents = {n[:-1] for n in members if n}
    out = {}
    for node, m in members.items():
        below = [x for x in members if x[: len(node)] == node]
        digest = hashlib.sha256(",".join(map(str, full.get(node, []))).encode()).hexdigest()
        parent = members[node[:-1]][0] if node else None
        children = sum(1 for x in below if len(x) == len(node) + 1)
        out[m[0], len(node)] = (parent, len(m), children, sum(x not in parents for x in below), sum(value[x] for x in below), digest)
    return out


def test_family_beginnings_copies_and_many_ends(spark):
    rng = random.Random(6)
    own = {c: [("user", f"w{rng.randint(0, 2)} x") for _ in range(rng.randint(1, 5))] for c in range(60)}
    own |= {c: [("user", "hello there"), ("assistant", "same again")] for c in range(8000, 9300)}
    convs = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = own.get(c - c % 20, [])[:h] + said[h:]
    rows = [(c, t, r, x) for c, said in own.items() for t, (r, x) in enumerate(said)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    sequences = prefix_trie.rebuilt(prefix_trie.turns(frame))
    got = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in prefix_trie.trie(sequences).collect()}
    assert got == by_hand(convs)
    wholes = {r["conv_id"]: r["whole_of"] for r in prefix_trie.ends(sequences).collect()}
    assert wholes == {c: min(o for o in convs if convs[o] == convs[c]) for c in convs}


def test_one_very_long_conversation(spark):
    long = spark.range(30_000).select(F.lit(20).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("two words").alias("text"))
    short = spark.createDataFrame([(21, 0, "user", "two words"), (21, 1, "user", "two words")], long.schema)
    nodes = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(long.unionByName(short))))
    rows = {r["depth"]: r for r in nodes.collect()}
    assert len(rows) == 30_001
    shared = 2 + 0  # both turns of 21 are the first two of 20
    assert [rows[d]["n_convs"] for d in (0, 1, 2, 3, 30_000)] == [2, 2, 2, 1, 1]
    assert [rows[d]["saved_tokens"] for d in (0, 1, 2, 3)] == [2 * shared, 2 * shared, 2, 0]
    assert [rows[d]["n_leaves"] for d in (0, 2, 30_000)] == [1, 1, 1] and rows[30_000]["n_children"] == 0
    assert rows[2]["ends_sha256"] == hashlib.sha256(b"21").hexdigest()
