import math
import random

import pytest
from pyspark.sql import functions as F

from tracewell.llm import language_id


def phrases(reference, text):
    """Longest matches one after another, an unknown letter being a phrase."""
    n = i = 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i : i + k] in reference:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n


def test_phrases_equal_a_loop(spark, folder):
    docs = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").limit(80).collect()]
    reference = language_id.normalised(" ".join(docs[:2]))[:2500]
    parser = language_id._Parser((("x", reference),))
    texts = ["", "123", "日本", "a", *docs]
    cut = [language_id.normalised(t).strip() for t in texts]
    bits, size = parser.phrases(cut)
    for t, b, n in zip(cut, bits[:, 0], size, strict=True):
        if not n:
            assert not t and b == math.inf
            continue
        want = sum(phrases(reference, t[i : i + language_id.BLOCK]) for i in range(0, len(t), language_id.BLOCK))
        assert b * n / math.log2(len(reference)) == pytest.approx(want)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = language_id.op1_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 150 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)
    assert sum(r["plausible"] for r in rows) >= 0.98 * len(rows)


def test_odd_rows(spark):
    labelled = spark.createDataFrame(
        [("the cat sat on the mat " * 5, "en"), ("der Hund lag auf der Matte " * 5, "de"), (None, "fr"), ("le", None)], "text string, lang string"
    )
    model = language_id.learn(labelled)
    assert [x for x, _ in model.references] == ["de", "en"]
    texts = [None, "", "123 !?", "THE CAT", "der hund", "日本語", "the mat\x00\n\n" * 20000, "the cat", "the cat"]
    docs = spark.createDataFrame([(None if i % 2 else 1, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    got = language_id.identify(docs.withColumn("i", F.monotonically_increasing_id()), model).orderBy("i").collect()
    assert [r["lang_pred"] for r in got][:5] == ["und", "und", "und", "en", "de"]
    assert got[6]["lang_pred"] == "en" and got[7]["score"] == got[8]["score"] > 0.5
    assert [r["score"] for r in got][:3] == [0.0] * 3
    assert language_id.identify(docs.limit(0), model).count() == 0
    nothing = language_id.learn(labelled.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_every_labelled_language_is_learned(spark):
    rng = random.Random(4)
    words = {f"l{i:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(30)] for i in range(80)}
    text = lambda language, n: " ".join(rng.choices(words[language], k=n))
    labelled = spark.createDataFrame([(text(x, 60), x) for x in words for _ in range(3 + (x < "l050"))], "text string, lang string")
    model = language_id.learn(labelled)
    assert [x for x, _ in model.references] == sorted(words)
    found = language_id.judged(model, [text(x, 40) for x in words])
    assert [x[0] for x in found] == sorted(words)


def test_noise_and_foreign_scripts_are_not_plausible_though_labels_are_noisy(spark):
    rng = random.Random(8)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 300").select("doc_id", "text", "lang")
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=n))
    foreign = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(n))
    wrong = [(-1, make(1500), lang) for lang in ("de", "en", "es", "fr") for make in (noise, foreign) for _ in range(4)]
    # A language whose only text is short.
    few = [(-1, "ett litet barn satt i skogen och sjöng en visa för alla djuren som bodde där", "sv")]
    model = language_id.learned(docs.union(spark.createDataFrame(wrong + few, docs.schema)))
    assert all(math.isfinite(x) for x in model.usual_bits)
    planted = [make(n) for make in (noise, foreign) for n in (60, 120, 199, 500, 3000) for _ in range(5)]
    assert not any(x[3] for x in language_id.judged(model, planted))
    clean = [r["text"] for r in docs.filter("lang IS NOT NULL").filter(language_id.held_out(F.col("doc_id"), 4, 2)).collect()]
    for size in (10**6, 150, 40):
        found = [x[3] for x in language_id.judged(model, [t[:size] for t in clean])]
        assert sum(found) >= 0.97 * len(found)
