"""The ledger sink: what is written once, whatever dies when."""

import os

import pytest
from pyspark.sql import functions as F

from tracewell.operators import batching
from tracewell.session import new_table_path
from tracewell.sources import ledger
from tracewell.streaming import pipeline

ROWS = "type string, id string, seq bigint, timestamp bigint, data string, bytes bigint"


def dying(after):
    """A source whose writer is killed in the second micro-batch, before or after its files are in the ledger.

    Made here, so that it is sent to the workers by value.
    """

    class Dies(ledger.LedgerStreamWriter):
        def commit(self, messages, batchId):  # noqa: N803
            if after or batchId != 1:
                ledger.LedgerStreamWriter.commit(self, messages, batchId)
            if batchId == 1:
                raise RuntimeError("killed")

        def abort(self, messages, batchId):  # noqa: N803
            """What is killed removes nothing."""

    class Source(ledger.LedgerSource):
        @classmethod
        def name(cls):
            return f"dies_{'after' if after else 'before'}"

        def streamWriter(self, schema, overwrite):  # noqa: N802
            return Dies(self._option("path"), self._option("stream"))

    return Source


def stored_parts(spark, n=3):
    path = new_table_path(spark, "ledger-input")
    for part in range(n):
        rows = [(t, f"i{part}-{i}", part * 100 + i, 1, '{"n":%d}' % (part * 100 + i), 9) for i in range(40) for t in ("logs", "events")]
        spark.createDataFrame(rows, ROWS).coalesce(2).write.mode("append").parquet(path)
    return path


def numbers(bodies):
    items = bodies.select("type", F.explode(F.from_json(F.regexp_extract("body", r":(\[.*\])", 1), "array<struct<n:bigint>>")).alias("i"))
    return sorted((r.type, r.n) for r in items.select("type", "i.n").collect())


@pytest.mark.parametrize("after", [False, True])
def test_a_killed_stream_delivers_each_record_once(spark, after):
    path, checkpoint = new_table_path(spark, "ledger"), new_table_path(spark, "ledger-checkpoint")
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 2).parquet(stored_parts(spark))
    with pytest.raises(Exception, match="killed"):
        pipeline.deliver_stream_once(stream, path, checkpoint, max_items=7, source=dying(after)).awaitTermination()
    entered = ledger.read_entries(spark, path).select("run").distinct().count()
    assert entered == (2 if after else 1)
    pipeline.deliver_stream_once(stream, path, checkpoint, max_items=7).awaitTermination()
    bodies = ledger.read_once(spark, path, batching.partition_bodies(stream).schema)
    assert numbers(bodies) == sorted((t, p * 100 + i) for p in range(3) for i in range(40) for t in ("logs", "events"))
    assert bodies.agg(F.max("items")).first()[0] <= 7
    runs = [r.run for r in ledger.read_entries(spark, path).select("run").distinct().collect()]
    assert sorted(runs) == [f"{checkpoint}/{i}" for i in range(3)]
    # What the killed attempt left behind is cleared, what counts stays.
    assert ledger.remove_unfinished(spark, path, older_seconds=3600) == 0
    lost = ledger.remove_unfinished(spark, path, older_seconds=-60)
    assert (lost > 0) != after
    assert bodies.count() == ledger.read_once(spark, path, bodies.schema).count()
    files = [f for f in os.listdir(f"{path}/data") if f.endswith(".parquet")]
    assert len(files) == ledger.read_entries(spark, path).count()


def test_a_repeated_run_stays_as_it_is(spark):
    path = new_table_path(spark, "ledger")
    rows = spark.range(10).repartition(3)
    ledger.write_once(rows, path, "a/b c")
    ledger.write_once(rows.union(rows), path, "a/b c")
    assert sorted(r.id for r in ledger.read_once(spark, path, rows.schema).collect()) == list(range(10))
    ledger.write_once(rows.limit(0), path, "none")
    ledger.write_once(spark.range(10, 12), path, "b")
    assert ledger.read_once(spark, path, rows.schema).count() == 12
    assert ledger.read_entries(spark, path).select("run").distinct().count() == 2
    with pytest.raises(Exception, match="run is missing"):
        rows.write.format(ledger.FORMAT).mode("append").option("path", path).save()


def test_a_failed_task_leaves_no_run(spark):
    path = new_table_path(spark, "ledger")
    bad = spark.range(10).repartition(2).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        ledger.write_once(bad, path, "r")
    assert not os.path.exists(f"{path}/ledger")
    ledger.write_once(spark.range(3), path, "r")
    assert ledger.read_once(spark, path, "id long").count() == 3


def test_bodies_of_partitions_keep_the_limits(spark):
    rows = [("logs" if i % 3 else "events", f"i{i}", i, 1, '"%d"' % i, 10 + i % 50) for i in range(400)]
    spool = spark.createDataFrame(rows, ROWS).repartition(3, "seq")
    spool = spool.unionByName(spark.createDataFrame([(None, "x", 1, 1, "1", 1), ("logs", "y", None, 1, "2", None), ("logs", "big", 9, 1, "3", 10**6)], ROWS))
    made = batching.partition_bodies(spool, 20, 300).collect()
    assert sum(r["items"] for r in made) == 402 and all(r["items"] <= 20 and (r["bytes"] <= 300 or r["items"] == 1) for r in made)
    assert len({(r["type"], r["batch_no"]) for r in made}) == len(made)
    assert all(r["body"].startswith('{"%s":[' % r["wrapper"]) for r in made)
    assert batching.partition_bodies(spool.limit(0)).count() == 0
