import random

import pytest
from pyspark.sql import functions as F

from tracewell.llm import token_counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.vocabulary_path())


def n_tokens(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_equals_the_library(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts.op13_token_counts(spark, folder).collect()}
    want = {}
    for r in docs.collect():
        n = n_tokens(library, r["text"])
        want[r["doc_id"]] = (len((r["text"] or "").encode()), n, n > 2048)
    assert got == want


def odd_texts():
    rng = random.Random(8)
    start, end = "<|startoftext|>", "<|endoftext|>"
    alphabet = "abAB é \u0085 ​\x1c\x1f\x0b\t\n\r 'sßΣσİ中文字😀１２½.,!#́﻿᠎가Å\x00\x7f"
    yield from (None, "", " ", "\n", "a", " a", "a ", "A  b", "don't we'LL I'M you've 'S 'D ''s", "a1b22", "ΣΑΣ Σ", "İstanbul", "e\ń", "́")
    yield from (f"a{end}b", f" {end} ", f"{end}{start}", f"<{start}>", start.upper(), "<|endoftext", "a<|b|>", f"x{end[:-1]}{end}y", "<|endof\ntext|>")
    yield from ("a" * 5000, "ab1" * 2000, "é" * 700, "!" * 900, "".join(rng.choice("abc") for _ in range(60_000)))
    yield from ("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400))
    yield "".join(chr(c) for c in range(1, 0x3100))


def test_odd_texts(spark, library):
    rows = [(i if i % 7 else None, t, -1) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows + rows[:9], "doc_id long, text string, n_tokens int").withColumn("n", F.lit("x"))
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs).collect())
    assert got == sorted((i or 0, len((t or "").encode()), n_tokens(library, t)) for i, t, _ in rows + rows[:9])
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_proved_strings_are_one_token_and_the_rest_is_not(library):
    counter = token_counts.Counter(token_counts.vocabulary_path())
    proved = sorted(w for w in counter.whole if w.isascii() and w.isalpha())
    assert len(proved) > 20_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(proved, add_special_tokens=False))
    unproved = [t[:-4] for t in library.get_vocab() if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t[:-4] not in counter.whole]
    assert all(len(e.ids) > 1 or t != t.lower() for t, e in zip(unproved, library.encode_batch(unproved, add_special_tokens=False), strict=True))


def test_memory_that_forgets_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    counter = token_counts.Counter(token_counts.vocabulary_path())
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé'") for _ in range(rng.randint(1, 90))) for _ in range(60)]
    for _ in range(30):
        texts = [" ".join(rng.choices(words, k=9)) for _ in range(5)]
        assert counter.counts(texts) == [n_tokens(library, t) for t in texts]
