import collections
import re

import pytest
from pyspark.sql import functions as F

from tracewell.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, inside = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            inside |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    base_failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), base_failed


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_equal_a_loop(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in BASE) for r in quality_rules.judge_quality(docs).collect()}
    assert got == {r["doc_id"]: counts(r["text"]) for r in docs.collect()}


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "a", "a b c d e", "a b c d e a b c d e", "x " * 3000, "l\nl\n\n \nl\r", "é\x85ü a b", "😀 & <b> | #"]
    rows = [(i if i % 4 else None, t, 1.0) for i, t in enumerate(texts + texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality double").withColumn("_w", F.lit(1))
    got = quality_rules.judge_quality(docs).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r["doc_id"], *(r[c] for c in BASE)) for r in got), key=key) == sorted(((r[0], *counts(r[1])) for r in rows), key=key)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality_rules.judge_quality(docs.limit(0)).count() == 0


def test_labels_are_met(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.judge_quality(spark.read.parquet(f"{folder}/documents.parquet")).withColumnRenamed("quality", "p")
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("NOT base_failed").collect()
    assert sum(r["kept"] for r in rows if r["quality"] == 1) >= 0.98 * sum(r["quality"] == 1 for r in rows)
    assert sum(r["kept"] for r in rows if r["quality"] == 0) <= 0.1 * sum(r["quality"] == 0 for r in rows)


def test_estimate_finds_which_rule_to_trust():
    good, bad = quality_rules.GOOD, quality_rules.BAD
    share, votes = quality_rules.estimate({(good, good): 900, (bad, bad): 80, (good, bad): 20}, 2)
    assert share == pytest.approx(0.9, abs=0.06)
    assert votes[0][0][bad] > 8 * votes[0][1][bad]
    assert quality_rules.estimate({}, 1)[0] == 0.5
