"""The catalogue and the entry points, streams in several micro-batches, and readers of broken input."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tracewell.operators import sessions, spool
from tracewell.session import new_table_path
from tracewell.sources import items as sources
from tracewell.streaming import stateful

QUICK = ("event_items", "packed_batches", "paused_runs", "error_trails", "session_dedupe_small_cache", "raw_record_violations")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", QUICK)
def test_queries_match_their_sql(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    con = duckdb.connect()
    for table in ("events", "documents", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(entry.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cursor.description], cursor.fetchall())


def test_entry_gives_batches(spark):
    batches = entry.entry(spark).collect()
    assert batches and all(r.items <= 1000 and r.bytes <= 4_500_000 for r in batches)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def micro_batches(spark, parts, schema):
    """A stream that gives each part as a micro-batch of its own, in order."""
    path = new_table_path(spark, "stream-input")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def collect(spark, stream):
    path = new_table_path(spark, "stream-output")
    query = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", new_table_path(spark, "stream-state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).collect()


def test_stream_state_lasts_across_micro_batches(spark):
    parts = [[("s", 0, "a"), ("s", 1, "b"), ("s", 2, "a")], [("s", 3, "a"), ("s", 4, "c"), ("s", 5, "d")], [("s", 6, "a"), ("t", 7, "a")]]
    stream = micro_batches(spark, parts, "session_id string, seq bigint, message string")
    sent = collect(spark, stateful.dedupe_reports_stream(stream, F.col("message"), "session_id", "seq", cache=3, idle=None))
    assert sorted(r.seq for r in sent) == [0, 1, 4, 5, 6, 7]


def test_stream_trails_last_across_micro_batches(spark):
    parts = [[("s", 0, False, "a"), ("s", 1, True, "")], [("s", 2, False, "b"), ("s", 3, False, "c"), ("s", 4, True, "")]]
    stream = micro_batches(spark, parts, "session_id string, seq bigint, error boolean, crumb string")
    got = collect(spark, stateful.breadcrumb_stream(stream, "session_id", "seq", "error", "crumb", n=2, idle=None))
    assert {r.seq: r.breadcrumbs for r in got} == {1: ["a"], 4: ["b", "c"]}


def test_stream_rows_cross_whole(spark):
    crumbs = [("s", 0, False, "a|b"), ("s", 1, False, ""), ("s", 2, None, None), ("s", 3, False, "+|"), (None, None, True, "x"), ("s", 4, True, "|")]
    schema = "session_id string, seq bigint, error boolean, crumb string"
    got = collect(spark, stateful.breadcrumb_stream(micro_batches(spark, [crumbs], schema), "session_id", "seq", "error", "crumb", idle=None))
    assert {r.seq: r.breadcrumbs for r in got} == {None: [], 4: ["a|b", "", None, "+|"]}
    reports = [("s", -1, "a|b"), ("s", 0, "a"), ("s", 1, None), ("s", 2, None), ("s", None, "a"), ("s", None, "|")]
    stream = micro_batches(spark, [reports], "session_id string, seq bigint, message string")
    sent = collect(spark, stateful.dedupe_reports_stream(stream, F.col("message"), "session_id", "seq", idle=None))
    assert sorted(((r.seq, r.message) for r in sent), key=repr) == [(-1, "a|b"), (0, "a"), (1, None), (None, "|")]


class OneValue:
    """A state variable that counts what is read and written."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.value, self.calls = value, self.calls + 1


def test_stream_state_of_a_session_is_one_value():
    class Handle:
        def getMapState(self, *_):  # noqa: N802
            return None

        def getValueState(self, *_):  # noqa: N802
            return OneValue()

    trails, dedupe = stateful._Trails(None, 20, None, 100), stateful._Dedupe(None, 20, None, 100)
    for each in (trails, dedupe):
        each.init(Handle())
    for start in (0, 30):
        list(trails.handleInputRows(("s",), iter([("s", f"{i}|0|+c{i}") for i in range(start, start + 30)]), None))
        list(dedupe.handleInputRows(("s",), iter([("s", f"{i}|k{i}", None) for i in range(start, start + 30)]), None))
    assert trails.ring.value == ([f"c{i}" for i in range(40, 60)],) and dedupe.keys.value == ([f"k{i}" for i in range(40, 60)],)
    assert trails.ring.calls == dedupe.keys.calls == 4


REPORT = "session_id string, seq bigint, message string, big bigint"


def fifo(keys, cache, held=()):
    held, sent = list(held), []
    for place, key in enumerate(keys):
        if key not in held:
            held = (held + [key])[-cache:]
            sent.append(place)
    return sent


def test_long_micro_batches_are_put_in_order_in_the_state(spark):
    """Over the rows held in memory, in several chunks, out of order, with large numbers beside nulls."""
    import random

    rng = random.Random(1)
    keys = [rng.choice("abcdefgh") for _ in range(600)]
    rows = [("s", i, k, None if i % 3 else 2**60 + i) for i, k in enumerate(keys)] + [("t", 5, "a", 1), (None, 6, None, None), ("", 7, None, 3)]
    parts = [rows[:300], rows[300:]]
    for part in parts:
        rng.shuffle(part)
    stream = micro_batches(spark, parts, REPORT)
    sent = collect(spark, stateful.dedupe_reports_stream(stream, F.col("message"), "session_id", "seq", cache=4, idle=None, held=50))
    got = {(r.session_id, r.seq): (r.message, r.big) for r in sent}
    assert sorted(q for s, q in got if s == "s") == fifo(keys, 4)
    assert all(got["s", q] == (keys[q], None if q % 3 else 2**60 + q) for s, q in got if s == "s")
    assert [k for k in got if k[0] != "s"] and {k for k in got if k[0] != "s"} in ({("t", 5), (None, 6)}, {("t", 5), ("", 7)})


def test_a_session_is_forgotten_when_its_time_to_live_is_over(spark):
    """State that has a time to live keeps a stream running without end, so this one is watched and stopped."""
    import time

    source, out = new_table_path(spark, "ttl-source"), new_table_path(spark, "ttl-out")
    part = spark.createDataFrame([("s", 1, "a", 1)], REPORT).coalesce(1)
    part.write.parquet(source)
    stream = spark.readStream.schema(REPORT).parquet(source)
    sent = stateful.dedupe_reports_stream(stream, F.col("message"), "session_id", "seq", idle="3 seconds")
    query = sent.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_table_path(spark, "ttl")).start()

    def arrived(rows):
        until = time.time() + 30
        while time.time() < until:
            if query.lastProgress and spark.read.schema(sent.schema).parquet(out).count() >= rows:
                return True
            time.sleep(0.5)
        return False

    try:
        assert arrived(1)
        time.sleep(4)
        part.write.mode("append").parquet(source)
        assert arrived(2)
    finally:
        query.stop()


@pytest.mark.parametrize("cache,segment", [(3, 1 << 17), (2, 4), (50, 1 << 17)])
def test_a_stream_that_starts_from_caches_equals_one_batch(spark, cache, segment):
    import random

    rng = random.Random(cache)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), i, f"k{rng.randrange(7)}", i) for i in range(240)]
    df = spark.createDataFrame(rows, REPORT)
    earlier = df.where("seq < 130")
    caches = sessions.session_caches(earlier, F.col("message"), cache=cache, segment=segment)
    assert caches.agg(F.max(F.size("keys"))).first()[0] <= cache
    stream = micro_batches(spark, [rows[130:170], rows[170:]], REPORT)
    sent = collect(spark, stateful.dedupe_reports_stream(stream, F.col("message"), "session_id", "seq", cache=cache, idle=None, caches=caches))
    before = sessions.dedupe_reports(earlier, F.col("message"), cache=cache, segment=segment).collect()
    whole = sessions.dedupe_reports(df, F.col("message"), cache=cache, segment=segment).collect()
    assert sorted(r.seq for r in [*before, *sent]) == sorted(r.seq for r in whole)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_a_stream_that_starts_from_crumbs_equals_one_batch(spark, n):
    import random

    rng = random.Random(n)
    schema = "session_id string, seq bigint, error boolean, crumb string"
    rows = [(rng.choice(["s", "t", None]), i, rng.random() < 0.3, f"c{i}") for i in range(120)]
    df = spark.createDataFrame(rows, schema)
    earlier = df.where("seq < 70")
    crumbs = sessions.last_crumbs(earlier, F.col("error"), F.col("crumb"), n=n, width=16) if n else None
    stream = micro_batches(spark, [rows[70:90], rows[90:]], schema)
    got = collect(spark, stateful.breadcrumb_stream(stream, "session_id", "seq", "error", "crumb", n=n, idle=None, crumbs=crumbs, held=5))
    whole = sessions.breadcrumb_trail(df, F.col("error"), F.col("crumb"), n=n).where("seq >= 70").collect()
    assert {r.seq: r.breadcrumbs for r in got} == {r.seq: r.breadcrumbs for r in whole}


def test_timers_end_lives_as_the_batch_does(spark):
    import random

    rng = random.Random(7)
    rows = [(rng.choice(["logs", "events", None]), f"i{i}", at, at if rng.random() < 0.95 else None) for i, at in enumerate(sorted(rng.randrange(0, 9000) for _ in range(90)))]
    schema = "type string, id string, seq bigint, timestamp bigint"
    end = ("errors", "end", 20_000, 20_000)  # moves the watermark on
    parts = [rows[:30], rows[30:60], rows[60:], [end], [("errors", "last", 20_001, 20_001)]]
    lives = collect(spark, stateful.expired_lives_stream(micro_batches(spark, parts, schema), ttl=100, delay="10 seconds"))
    whole = spark.createDataFrame([r for part in parts for r in part], schema)
    known = whole.where("type IS NOT NULL AND timestamp IS NOT NULL AND type <> 'errors'")
    want = spool.idle_lives(known, ttl=100).collect()
    assert sorted((r.type, r.started_at, r.last_write_at, r.writes) for r in lives) == sorted((r.type, r.started_at, r.last_write_at, r.writes) for r in want)
    assert len(want) > 10
    expired = spool.expired_records(whole, spark.createDataFrame(lives, "type string, started_at bigint, last_write_at bigint, writes bigint"), ttl=100)
    judged = spool.idle_expiry(whole, 20_001 - 10, ttl=100)
    assert sorted(r.id for r in expired.collect()) == sorted(r.id for r in judged.where("expired AND timestamp IS NOT NULL AND type IS NOT NULL").collect())


def test_broken_spool_files_count_as_empty(spark):
    path = new_table_path(spark, "spool")
    texts = ['[{"id":"a","data":{"n":1},"timestamp":5},{"id":1,"data":{},"timestamp":5},7]', '[{"id":"b"', "", '{"id":"c","data":{},"timestamp":1}']
    spark.createDataFrame([(t,) for t in texts], "value string").repartition(4).write.option("maxRecordsPerFile", 1).text(path)
    got = sources.read_spool(spark, path, "logs").collect()
    assert [(r.id, r.data, r.bytes, r.timestamp) for r in got] == [("a", '{"n":1}', 7, 5)]
    with pytest.raises(ValueError):
        sources.read_spool(spark, path, "page_visits")


def test_responses_without_counters(spark):
    bodies = ["", "[]", "null", '{"items":{"received":"3","failed":2.9},"unprocessed_indexes":[1,"2",3.5,4]}', '{"error":{"message":""}}', '{"error":{"message":"no"}}']
    raw = spark.createDataFrame([("logs", i, 200, None, b, 0) for i, b in enumerate(bodies)], "type string, batch_no bigint, status int, retry_after string, body string, at bigint")
    got = sources.normalize_responses(raw).orderBy("batch_no").collect()
    assert [(r.received, r.failed, r.unprocessed_indexes) for r in got[:4]] == [(0, 0, [])] * 3 + [(3, 2, [1, 4])]
    assert [r.success for r in got] == [False, True, False, True, True, True]
    assert [r.error_message for r in got[4:]] == ["", "no"]
    assert {r.retry_after for r in got} == {""}


def test_diagnostic_lines(spark):
    lines = ["[2024-01-01T00:00:00+00:00] internal.ERROR: it: broke {\"a\":1}", "[x] my.app.INFO: plain", "no line", "[x] c.WARNING: ends {odd"]
    got = sources.parse_diagnostics(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert [(r.channel, r.level, r.message, r.context is not None) for r in got] == [
        ("internal", "error", "it: broke", True), ("my.app", "info", "plain", False), ("c", "warning", "ends {odd", False)]


def test_a_spool_file_larger_than_a_variant(spark, tmp_path):
    """Every entry is parsed by itself, so a file may be larger than the limit on one value."""
    from tracewell.sources import items as sources

    entry = '{"id":"i%d","data":{"n":%d,"pad":"' + "x" * 69_000 + '"},"timestamp":%d}'
    with open(tmp_path / "large.json", "w") as file:
        file.write("[" + ",".join(entry % (i, i, i) for i in range(2_100)) + "]")
    (tmp_path / "cut.json").write_text('[{"id":"a","data":{},"timestamp":1}')
    (tmp_path / "other.json").write_text('{"id":"a","data":{},"timestamp":1}')
    assert (tmp_path / "large.json").stat().st_size > 140_000_000
    read = sources.read_spool(spark, str(tmp_path), "events").agg(F.count("*"), F.sum("timestamp"), F.min("bytes")).first()
    assert read[0] == 2_100 and read[1] == sum(range(2_100)) and read[2] > 69_000


def test_a_sink_of_the_callers_own(spark, tmp_path):
    from tracewell.streaming import pipeline

    rows = [("logs", f"i{i}", i, i, '{"n":%d}' % i, 8) for i in range(25)]
    spool = spark.createDataFrame(rows, "type string, id string, seq bigint, timestamp bigint, data string, bytes bigint")
    for part in (spool.where("seq < 10"), spool.where("seq >= 10")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "spool"))
    got = []
    stream = spark.readStream.schema(spool.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "spool"))
    query = pipeline.deliver_stream(
        stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), max_items=10,
        sink=lambda bodies, number: got.extend((number, r["batch_no"], r["items"]) for r in bodies.collect()),
    )
    query.awaitTermination(60)
    assert sum(n for _, _, n in got) == 25 and {number for number, _, _ in got} == {0, 1}


def test_tables_of_a_run_are_removed(spark):
    import os

    from tracewell import session

    with session.tables_of_a_run(spark):
        path = new_table_path(spark, "passing")
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))
