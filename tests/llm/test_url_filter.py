import pytest
from pyspark.sql import functions as F

from tracewell.llm import url_filter
from tracewell.llm.url_filter import Rule, Vocabulary

CASES = [
    ("https://www.Example.org/es/1?x", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/17#top", "example.org", "/en/17", "example.org/en/1", "block"),
    ("https://a.b.org/casino", "a.b.org", "/casino", "org/", "allow"),
    ("https://a.com/de/1", "a.com", "/de/1", "com/de/", "block"),
    ("https://notorg/casino", "notorg", "/casino", None, "block"),
    ("https://a.org", "a.org", "", None, "allow"),
    ("https://a.net/free/bets", "a.net", "/free/bets", None, "block"),
    ("https://a.net/free-free", "a.net", "/free-free", None, "allow"),
    ("https://a.net/freebets/casinoo", "a.net", "/freebets/casinoo", None, "allow"),
    ("casino", "", "", None, "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://h://i/p", "h:", "//i/p", None, "allow"),
]


def test_cases(spark):
    rows = [(i if i else None, u, "clash") for i, (u, *_) in enumerate(CASES)]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, host string").withColumn("verdict", F.lit(1))
    got = url_filter.judge_urls(pages).collect()
    want = [(i if i else None, *case[1:]) for i, case in enumerate(CASES)]
    shown = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=repr)
    assert shown == sorted(want + want[:1], key=repr)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_own_rules_and_words(spark):
    pages = spark.createDataFrame([(1, "http://a.x/p/" + "z" * 100_000 + "/bad"), (2, "http://a.x/q")], "page_id long, url string")
    got = url_filter.judge_urls(pages, [Rule("x/q", "block")], Vocabulary(("bad",), ())).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block", "block"] and got[0]["strict_hits"] == 1
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, [Rule("x/q", "block"), Rule("x/q", "allow")])
