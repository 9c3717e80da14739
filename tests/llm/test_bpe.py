import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tracewell.llm import bpe, tokens


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.vocabulary_path()), special_tokens={}
    )


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    joined = " ".join(map(str, ids))
    return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_equals_the_library(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op2_byte_bpe(spark, folder).collect()}
    assert got == {r["doc_id"]: expected(library, r["text"]) for r in docs.collect()}


def odd_texts():
    rng = random.Random(3)
    alphabet = "abAB é \u0085 ​\x1c\x1f\t\n\r 'sß中文字😀１२½.,!#́﻿᠎"
    yield from (None, "", " ", "\n", "a", " a", "a ", "  a  b  ", "a\n b", "a \nb", "a  b", "a\x1c b", "don't we'll I'M", "<|endoftext|>")
    yield from ("a" * 3000, "ab" * 900, "é" * 700, "x" * 63 + " " + "y" * 65, "".join(rng.choice("abc") for _ in range(2000)))
    yield from ("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300))
    yield "".join(chr(c) for c in range(1, 0x3100))


def test_odd_texts(spark, library):
    rows = [(i if i % 7 else None, t, -1) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows + rows[:9], "doc_id long, text string, ids int").withColumn("k", F.lit(0))
    got = sorted(((r["doc_id"] or 0, r["ids"], r["n_tokens"], bytes(r["decoded"])) for r in bpe.encode(docs).collect()))
    want = []
    for i, t, _ in rows + rows[:9]:
        ids = library.encode_ordinary(t or "")
        want.append((i or 0, " ".join(map(str, ids)), len(ids), (t or "").encode()))
    assert got == sorted(want)
    assert bpe.encode(docs.limit(0)).count() == 0


def test_long_words_and_slices_without_spaces(library, monkeypatch):
    """Far more steps and rows than one recursion may keep."""
    import public_tokenizers

    rng = random.Random(7)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    unspaced = ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(40)) + "。" for _ in range(20_000)]
    few = "".join(rng.choice("aab") for _ in range(20_000))
    encoder = bpe.WordEncoder(bpe.ranks_of(bpe.vocabulary_path()), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "ROWS_AT_ONCE", 100_000, raising=False)
    for texts in ([letters], ["".join(unspaced)], unspaced, [few], ["a" * 300_000]):
        for t, (ids, decoded) in zip(texts, encoder(texts), strict=True):
            assert ids == " ".join(map(str, library.encode_ordinary(t))) and decoded == t.encode()


def test_a_vocabulary_where_a_later_token_is_needed_first():
    """`xab` ranks below `ab`, so contracting all places of `ab` at once would be wrong."""
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)} | {b"xa": 256, b"xab": 257, b"ab": 258, b"abab": 259, b"bx": 255 + 5}
    library = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    words = ["".join(rng.choice("xab") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    encoder = bpe.WordEncoder(ranks, r"\S+|\s+")
    for word, (ids, decoded) in zip(words, encoder(words), strict=True):
        assert ids == " ".join(map(str, library.encode_ordinary(word))) and decoded == word.encode()


def test_parts_are_forgotten_in_generations():
    calls = []

    def double(parts):
        calls.append(list(parts))
        return [p * 2 for p in parts]

    cache = tokens.PartCache(double, most=10)
    for text in ["a b c", "a b c", *(f"a x{i}" for i in range(30)), "a b  c", "a " + "z" * 99]:
        cache.prepare([text])
        made = cache.of(text)
        assert "".join(made) == ("".join(p * 2 for p in [text.split(" ")[0], *(" " + p for p in text.split(" ")[1:])]) if "  " not in text else text * 2)
        assert len(cache.later) <= 12
    assert sum("a" in c for c in calls) < 8
