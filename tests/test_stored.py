"""Deletion in stored tables: what is left, what is gone from disk, and that a repeat changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from tracewell.operators import spool
from tracewell.session import new_table_path
from tracewell.sources import items, sinks, stored

ROWS = "type string, id string, seq bigint, timestamp bigint, data string, bytes bigint"


def store(spark, ats):
    path = new_table_path(spark, "stored")
    rows = [(t, f"{t}{i}", i, at, "{}", 2) for t, times in ats.items() for i, at in enumerate(times)]
    sinks.write_spool(spark.createDataFrame(rows, ROWS), path)
    return path


def left(spark, path):
    return sorted(r.id for r in items.read_spool_table(spark, path).collect())


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith((".parquet", ".txt")))


def test_a_discarded_type_is_gone_from_disk(spark):
    path = store(spark, {"logs": [1, 2], "events": [3]})
    assert stored.discard_stored_backlog(spark, path, "logs") and not os.path.exists(f"{path}/type=logs")
    before = files(path)
    assert not stored.discard_stored_backlog(spark, path, "logs") and not stored.discard_stored_backlog(spark, path, "page_visits")
    assert files(path) == before and left(spark, path) == ["events0"]
    assert not stored.discard_stored_backlog(spark, new_table_path(spark, "nothing"), "logs")


def test_expiry_writes_only_what_it_touches(spark):
    path = store(spark, {"logs": [0, 10, 500, 520], "events": [0, 5], "errors": [530, 535], "unknown": [0]})
    untouched = files(f"{path}/type=errors")
    judged = spool.idle_expiry(items.read_spool_table(spark, path), 540, ttl=100)
    want = sorted(r.id for r in judged.where("NOT expired OR type = 'unknown'").collect())
    assert stored.expire_stored_spool(spark, path, 540, ttl=100) == ["events", "logs"]
    assert left(spark, path) == want == ["errors0", "errors1", "logs2", "logs3", "unknown0"]
    assert files(f"{path}/type=errors") == untouched and not os.path.exists(f"{path}/type=events")
    after = files(path)
    assert stored.expire_stored_spool(spark, path, 540, ttl=100) == [] and files(path) == after
    assert stored.expire_stored_spool(spark, path, 10**6, ttl=0) == []
    assert stored.expire_stored_spool(spark, path, 10**6, ttl=100) == ["errors", "logs"] and left(spark, path) == ["unknown0"]


def test_lives_that_a_stream_ended_are_removed(spark):
    path = store(spark, {"logs": [0, 10, 500], "events": [0, 5]})
    lives = spark.createDataFrame([("logs", 0, 10, 2), ("events", 0, 5, 2)], "type string, started_at bigint, last_write_at bigint, writes bigint")
    assert stored.discard_lives(spark, path, lives, ttl=100) == ["events", "logs"]
    assert left(spark, path) == ["logs2"] and not os.path.exists(f"{path}/type=events")
    assert stored.discard_lives(spark, path, lives, ttl=100) == []


def test_a_job_that_dies_leaves_the_table_as_it_was(spark):
    path = store(spark, {"logs": [1, 2, 3]})
    table = items.read_spool_table(spark, path)
    dying = table.withColumn("data", F.when(F.col("seq") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("data")))
    with pytest.raises(Exception, match="broken"):
        stored.rewrite_partitions(spark, path, dying, ["logs"])
    assert left(spark, path) == ["logs0", "logs1", "logs2"]


def test_days_over_retention_are_gone_from_disk(spark):
    path = new_table_path(spark, "days")
    lines = spark.createDataFrame([("2024-01-01", "a"), ("2024-01-16", "b"), ("2024-01-17", "c"), ("not a day", "d")], "day string, value string")
    lines.write.partitionBy("day").text(path)
    assert stored.prune_stored_diagnostics(spark, path, "2024-01-30", 0) == []
    assert stored.prune_stored_diagnostics(spark, path, "2024-01-30") == ["2024-01-01"]
    kept = files(path)
    assert stored.prune_stored_diagnostics(spark, path, "2024-01-30") == [] and files(path) == kept
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["b", "c", "d"]
