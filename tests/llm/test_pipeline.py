import random

import __spark_entry__
import corpus_pipeline
import test_jaccard_join
from pyspark.sql import functions as F
from test_jaccard_join import brute, shingle_set

from tracewell.llm import language_id, quality_model


def test_stages_take_effect(spark, folder, tmp_path):
    """Each stage against plain Python over its own input."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = docs.collect()
    by_stage = [given]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < 3:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        model = (quality_model.learned(docs, spark.read.parquet(f"{folder}/labels.parquet")) if i == 0 else language_id.learned(docs)) if i < 2 else None
        docs = spark.read.parquet(str(tmp_path / str(i)))
        by_stage.append(docs.collect())
        before = by_stage[-2]
        if i == 0:
            scores = quality_model._Scorer(model).scores([r["text"] or "" for r in before])
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r, s in zip(before, scores, strict=True) if s >= 0.3}
        if i == 1:
            kept = [x[3] for x in language_id.judged(model, [r["text"] or "" for r in before])]
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r, k in zip(before, kept, strict=True) if k}
        if i == 2:
            assert {r["doc_id"] for r in docs.collect()} == {g for _, _, g in brute([(r["doc_id"], r["text"]) for r in before])}
        if i == 3:
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before}
    assert len(by_stage[0]) > len(by_stage[1]) >= len(by_stage[2]) > len(by_stage[3])
    ran = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, ran.select("doc_id", "piece", "ids_crc32").collect())) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in by_stage[4])


def test_clean_documents_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = corpus_pipeline.language(spark, corpus_pipeline.quality(spark, docs, folder), folder).select("doc_id")
    clean = docs.join(labels.filter("quality = 1"), "doc_id").select("doc_id")
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.03 * clean.count()


def test_odd_input(spark, tmp_path):
    rows = [(None, "a b c", None, "x"), (1, None, "en", "y"), (1, "", None, "z"), (2, "the cat sat on the mat", "en", "v"), (2, "the cat sat on the mat", "en", "w")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, plausible string").withColumn("score", F.lit(1))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) in ([2], [2, None])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0 and docs.columns == table.columns


def test_the_entry_point_knows_all_operators():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_near_copies_by_five_words_go(spark, monkeypatch):
    """Against a brute force over five words and four fifths; four words and 85 percent would keep these copies."""
    rng = random.Random(5)
    rows = []
    for i in range(0, 60, 3):
        words = [f"w{rng.randrange(10**6)}" for _ in range(49)]
        near, far = list(words), list(words)
        near[24] = "other"
        far[10] = far[24] = "other"
        rows += [(i, " ".join(words)), (i + 1, " ".join(near)), (i + 2, " ".join(far))]
    got = corpus_pipeline.distinct(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    kept = {r["doc_id"] for r in got.collect()}
    monkeypatch.setattr(test_jaccard_join, "shingle_set", lambda t, known=shingle_set: known(t, 5))
    assert kept == {g for _, _, g in brute(rows, 80)} != {i for i, _ in rows}
    monkeypatch.undo()
    assert len({g for _, _, g in brute(rows)}) == len(rows)
