import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import jaccard_join, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low.setdefault(root(i), []).append(key)
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in low.items()}
    return sorted(((key, len(sets[i]), least[root(i)]) for i, (key, _) in enumerate(rows)), key=repr)


def got(spark, rows, parts=3):
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("x")).repartition(parts, F.col("text"))
    found = jaccard_join.near_duplicates(table).collect()
    assert sum(r["first"] for r in found) == len({(r["component_id"]) for r in found if r["n_shingles"]}) + sum(not r["n_shingles"] for r in found)
    return sorted((tuple(r)[:3] for r in found), key=repr)


def changed(rng, words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.6:
            words[i] = rng.choice(vocabulary)
        elif kind < 0.8:
            words.insert(i, rng.choice(vocabulary))
        elif len(words) > 5:
            del words[i]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(3)]
    texts = []
    for size in (5, 8, 9, 12, 30, 80, 200):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(size)]
            texts += [changed(rng, base, rng.randint(0, max(1, size // 20)), vocabulary) for _ in range(rng.randint(1, 9))]
    base = [rng.choice(vocabulary) for _ in range(150)]
    texts += [changed(rng, base, rng.randint(0, 4), vocabulary) for _ in range(90)]  # chains of near copies round one text
    texts += [rng.choice(passages) + [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))] for _ in range(60)]
    texts = [" ".join(t).replace(" ", rng.choice([" ", "\n", "  "])) for t in texts]
    texts += [t.upper() for t in texts[::17]]
    keys = rng.sample(range(10_000), len(texts))
    rows = list(zip(keys, texts, strict=True))
    want = brute(rows)
    assert len({r[2] for r in want}) < 0.8 * len(want)
    assert got(spark, rows) == want


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "b a"), (8, "a b c d"), (None, "a b c d"), (None, "q r s t"), (9, long),
        (10, long + " y"), (11, "É b c d e f g"), (12, "é b c d e f g"), (8, "a b c d"), (13, "z" * 70_000), (14, "Z" * 70_000), (15, "\x85a b"),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:3]) == brute(rows[:3])
    assert got(spark, []) == []


def test_one_row_of_each_group_stays(spark, tmp_path):
    rows = [(3, "a b c d e", "x"), (1, "A b c d e", "y"), (1, "a b c d e", "z"), (None, "a b c d e", "u"), (7, None, "v"), (7, None, "w"), (9, "q", "t")]
    spark.createDataFrame(rows, "doc_id long, text string, row string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    kept = jaccard_join.representatives(spark.read.parquet(str(tmp_path / "docs")))
    assert sorted(r["row"] for r in kept.collect()) == ["t", "v", "w", "y"] and kept.columns == ["doc_id", "text", "row"]


def test_one_very_large_group(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(i, " ".join(base[:60] + [f"n{i}"] + base[61:])) for i in range(400)] + [(400 + i, " ".join(base)) for i in range(400)]
    assert {r[2] for r in got(spark, rows)} == {0}


def test_shingles_are_those_of_the_words():
    texts = ["a b c d e", "A  b\tc\nd e", "a b c d", "a b c", "c b a", "", None, "é" * 9, "x " * 5000, "a b c d e f"]
    sets = [set(s.tolist()) for s in shingles.shingle_sets(texts, 4)]
    want = [shingle_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(sets[i] & sets[j]) == len(want[i] & want[j])


def test_words_do_not_depend_on_chunks(monkeypatch):
    raw = b"ab  c " * 3000 + b"x" * 500 + b" end"
    whole = shingles.words(raw)
    monkeypatch.setattr(shingles, "CHUNK", 97)
    assert all(np.array_equal(a, b) for a, b in zip(whole, shingles.words(raw), strict=True))


def test_representatives_do_not_depend_on_splits(spark, tmp_path):
    """Scans are split otherwise when executors come or go; here, when the result is read later."""
    rng = random.Random(11)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(500)], k=60)) for _ in range(300)]
    rows = [(i, texts[i % 300]) for i in range(1500)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 16384).option(
        "parquet.page.size.row.check.min", 20
    ).option("parquet.block.size.row.check.min", 20).parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        docs = spark.read.parquet(str(tmp_path / "docs"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
        kept = jaccard_join.representatives(docs)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        assert docs.select(F.spark_partition_id()).distinct().count() > 1
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
