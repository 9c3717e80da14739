import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tracewell.llm import packing


def checked(spark, docs):
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(packing.vocabulary_path())
    tokens.encode_special_tokens = True
    got = packing.pack_documents(docs).collect()
    want = []
    for row in docs.collect():
        ids = [*tokens.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        cut = len(ids) % 1024
        parts = ([ids[:cut]] if cut else []) + [ids[i : i + 1024] for i in range(cut, len(ids), 1024)]
        start = 0
        for n, part in enumerate(parts):
            want.append((row["doc_id"], n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
            start += len(part)
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 1024 for n in filled.values())
    return filled


def test_pieces_and_sequences(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    filled = checked(spark, docs)
    assert len(filled) <= 1.02 * sum(filled.values()) / 1024 + 1


def test_odd_rows(spark):
    texts = [None, "", " ", "a  b", "a \n b", " a", "a ", "x  y z", "é" * 5000, "<|endoftext|> a", "a b c", "a b c", "'s 's  's\t's"]
    rows = [(i if i % 5 else None, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").withColumn("piece", F.lit("x"))
    checked(spark, docs)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_one_very_common_length(spark):
    pieces = spark.range(3000).select((F.lit(600) + F.col("id") % 2 * 10).alias("length"), F.lit(0).alias("piece"), F.col("id").alias("row_no"))
    placed = packing.pack(pieces, bucket_rows=100)
    assert placed.count() == 3000 == placed.select("sequence_id").distinct().count()


def test_plan_is_tight_and_whole():
    rng = random.Random(5)
    for _ in range(40):
        top = rng.choice([10, 64, 1024])
        counts = {rng.randint(1, top): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
        made = packing.plan(counts, top)
        used = {}
        for times, lengths in made:
            assert times > 0 and sum(lengths) <= top
            for x in lengths:
                used[x] = used.get(x, 0) + times
        assert used == counts
    # Greedy leaves 6+3 of 10; the 3 gives way to two pieces of 2.
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10) == [(1, [6, 2, 2]), (1, [3])]


def test_added_tokens_are_those_of_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(packing.vocabulary_path())
    end = "<|endoftext|>"
    around = ["", " ", "  ", "\n", " \n ", "a", "a ", " b", "<|", "|>", "'s", "é", end, f" {end}", "\u3000"]
    texts = [x + end + y for x in around for y in around] + ["<|endoftext", "<|end oftext|>", f"{end[:-1]}{end}", "x" * 3000 + end, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = {i: [*tokens.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["ids"] for r in packing.ids_of(docs, added=True).collect()} == want
    lengths = {r["doc_id"]: r["n"] for r in packing.op9_packing(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert lengths == {i: len(ids) for i, ids in want.items()}
