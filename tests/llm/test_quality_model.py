import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import quality_model


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = quality_model.op3_quality_model(spark, folder)
    assert scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert len(good) > 40 and len(bad) > 5
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([g >= 0.3 for g in good]) >= 0.97


def test_odd_rows(spark):
    clean, junk = "It was a quiet day and all was well. " * 4, "BUY!! NOW!! $$$ %%% " * 6
    texts = [clean + str(i) if i % 2 else junk + str(i) for i in range(60)]
    odd = [None, "", " \n", "word", clean * 2000, "日本語 ١٢ ½", clean, clean]
    docs = spark.createDataFrame([(i if i != 65 else None, t, "x") for i, t in enumerate(texts + odd)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, None), (None, 1), (3, 7), (1, 1)], "doc_id long, quality int")
    model = quality_model.learn(docs, labels)
    scored = quality_model.score_quality(docs.withColumn("i", F.monotonically_increasing_id()), model).orderBy("i").collect()
    score = [r["score"] for r in scored]
    assert min(score[1:60:2]) > max(score[0:60:2])
    assert score[60:63] == [0.0] * 3 and score[64] > 0.5 and score[66] == score[67]
    assert quality_model.score_quality(docs.limit(0), model).count() == 0
    alone = quality_model.learn(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in quality_model.score_quality(docs, alone).collect()} == {1.0}
    assert quality_model.learn(docs.limit(0), labels).layers == ()


def test_words_side_by_side_get_alike_vectors():
    texts = ["red apple tree", "green apple tree", "red pear tree", "green pear tree"] * 10 + ["one two three four"] * 10
    words, v = quality_model.word_vectors(texts, often=2)
    like = lambda a, b: v[words[a]] @ v[words[b]] / np.linalg.norm(v[words[a]]) / np.linalg.norm(v[words[b]])
    assert like("apple", "pear") > like("apple", "three") + 0.2


def test_temperature_softens_sure_mistakes():
    odds = np.array([8.0, 8, 8, 8, -8, -8, -8, -8])
    assert quality_model.temperature_of(odds, np.array([1, 1, 1, 0, 0, 0, 0, 1])) > 3
    assert quality_model.temperature_of(odds, np.array([1, 1, 1, 1, 0, 0, 0, 0])) == pytest.approx(0.5)
