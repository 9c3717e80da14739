"""The queries of this package, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def load_all() -> None:
    import importlib

    for module in MODULES:
        importlib.import_module(f"tracewell.llm.{module}")


MODULES = ("conversation_repair", "html_text", "language_id", "bpe", "embedding_join", "jaccard_join", "licenses", "packing", "prefix_trie", "quality_model", "quality_rules", "token_counts", "url_filter")
