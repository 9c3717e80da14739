import re

from pyspark.sql import functions as F

from tracewell.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = []
    for p in licenses.BASE_PHRASES:
        parts = p.words.split()
        found += [(i, p.label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_base_equals_a_loop(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = licenses.op8_license_scan(spark, "/root/testdata/sf0.01").collect()
    want = {r["doc_id"]: base(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got} == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)


def labels(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, hits string"))
    return {r["doc_id"]: (r["labels"], r["score"]) for r in got.collect()}


def test_labels_of_the_method(spark):
    filler = [f"word{i} and other prose {i}" for i in range(30)]
    got = labels(
        spark,
        [
            "Licensed under CC BY-NC 4.0.",
            "This work is licensed under the GNU General Public License, version 3.",
            "Licensed under the Apache License, Version 2.0.",
            "Released under the MIT License.",
            "The license of nature: general public opinion, version 3 of it.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            *filler,
        ],
    )
    assert got[0][0] == ["cc-by", "cc-by-nc"]
    assert got[1][0] == ["gpl", "gpl-3.0"]
    assert got[2][0] == ["apache", "apache-2.0"]
    assert got[3][0] == ["mit"]
    assert got[4][0] == []
    assert got[5][0] == ["mit"]
    assert got[0][1] == got[3][1] == 1.0 and got[20][1] == 0.0


def test_odd_rows(spark):
    texts = [None, "", "\x00\x7f", "cc by cc by", "mit license " * 2000, "é MIT\x00LICENSE", "mit licenses", "CC BY"]
    rows = [(None if i % 3 == 0 else 7, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_no", F.lit("x"))
    got = licenses.scan_licenses(docs).collect()
    want = sorted((r[0] or 0, *base(r[1])[:2]) for r in rows)
    assert sorted((r["doc_id"] or 0, r["n_words"], len(r["base"])) for r in got) == want
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
