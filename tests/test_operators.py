"""Operators against brute force and the rules' own cases."""

import random
from collections import OrderedDict

import pytest
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.operators import batching, budget, commerce, delivery, ordered, sessions, shape, spool, validate
from tracewell.plans import flows


def spool_rows(spark, n=300, types=("errors", "events"), size=lambda i: 10 + i % 7):
    rows = [(types[i % len(types)], f"i{i}", i, 1000 + i, '{"n":%d}' % i, size(i)) for i in range(n)]
    return spark.createDataFrame(rows, "type string, id string, seq bigint, timestamp bigint, data string, bytes bigint")


# --- order over keys of any size ---------------------------------------------------------------


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 20])
def test_positions_do_not_depend_on_the_bucket_width(spark, width):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(9)}", seq) for seq in rng.sample(range(-500, 5000), 400)]
    df = spark.createDataFrame(rows, "k string, seq bigint")
    got = {(r.k, r.seq): r.position for r in ordered.add_position(df, ["k"], "seq", width=width).collect()}
    for key in {k for k, _ in rows}:
        for place, seq in enumerate(sorted(s for k, s in rows if k == key)):
            assert got[(key, seq)] == place


@pytest.mark.parametrize("width", [1, 5, 1 << 20])
def test_carry_last_and_running_count(spark, width):
    rng = random.Random(2)
    rows = [("a" if rng.random() < 0.7 else "b", i, rng.choice([None, None, f"v{i}"])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i bigint, v string")
    bucket = ordered.bucket_start(F.col("i"), width)
    carried = ordered.carry_last(df, ["k"], F.col("i"), F.col("v"), bucket, "last")
    counted = ordered.running_count(df, ["k"], F.col("i"), F.col("v").isNotNull(), bucket, "n")
    last = {(r.k, r.i): r.last for r in carried.collect()}
    count = {(r.k, r.i): r.n for r in counted.collect()}
    seen, totals = {}, {}
    for k, i, v in rows:
        assert last[(k, i)] == seen.get(k)
        if v is not None:
            seen[k] = v
            totals[k] = totals.get(k, 0) + 1
        assert count[(k, i)] == totals.get(k, 0)


@pytest.mark.parametrize("n,width", [(1, 4), (20, 8), (20, 1 << 20), (249, 16), (250, 16), (251, 16)])
def test_cut_offs(spark, n, width):
    df = spool_rows(spark, 500).repartition(11)
    per_type = {t: sorted(r.seq for r in df.where(F.col("type") == t).collect()) for t in ("errors", "events")}
    newest = spool.keep_newest(df, n, width=width)
    oldest = spool.take_fifo(df, n, width=width)
    for t, numbers in per_type.items():
        assert sorted(r.seq for r in newest.where(F.col("type") == t).collect()) == numbers[-n:]
        assert sorted(r.seq for r in oldest.where(F.col("type") == t).collect()) == numbers[:n]


def test_a_cut_moves_no_records(spark, folder, tmp_path):
    spool_rows(spark, 500).write.parquet(str(tmp_path / "spool"))
    plan = spool.keep_newest(spark.read.parquet(str(tmp_path / "spool")), 5000)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and "data#" not in " ".join(moved) and plan.count("BroadcastHashJoin") >= 1


def test_records_without_a_place_go_elsewhere(spark):
    rows = spool_rows(spark, 4, ("logs",))
    odd = rows.withColumns({"type": F.when(F.col("seq") != 1, F.col("type")), "seq": F.when(F.col("seq") != 2, F.col("seq"))})
    assert batching.pack_batches(odd).count() == 2 and batching.unplaced(odd).count() == 2
    assert [r.seq for r in spool.keep_newest(odd, 1).collect()] == [3]
    assert spool.keep_newest(odd, 0).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 8, 100])
def test_a_spool_is_what_is_taken_left_and_unplaced(spark, n):
    rows = spool_rows(spark, 20, ("logs",)).unionByName(spool_rows(spark, 20, ("events",))).unionByName(spool_rows(spark, 20, ("unknown",)))
    odd = rows.withColumns({"seq": F.when(F.col("seq") % 4 != 1, F.col("seq")), "type": F.when(~F.coalesce(F.col("seq") == 7, F.lit(False)), F.col("type"))})
    taken = spool.take_fifo(odd, n, width=4)
    left, lost = spool.remainder(odd, taken), spool.unplaced(odd)
    numbered = 15 - 1  # of each type: every fourth has no number, one no type
    assert taken.count() == 2 * min(n, numbered) and taken.where("seq IS NULL").count() == 0
    assert lost.count() == 60 - 3 * numbered
    parts = taken.unionByName(left).unionByName(lost)
    assert parts.exceptAll(odd).count() == 0 == odd.exceptAll(parts).count()
    kept = spool.keep_newest(odd, n, width=4)
    assert kept.groupBy("type").count().where("type <> 'unknown'").agg(F.coalesce(F.max("count"), F.lit(0))).first()[0] == min(n, numbered)
    assert kept.where("seq IS NULL OR type IS NULL").count() == 0


# --- spool and batches -------------------------------------------------------------------------


def greedy(sizes, max_items, max_bytes):
    out = []
    for chunk in range(0, len(sizes), max_items):
        split = pos = filled = 0
        for size in sizes[chunk : chunk + max_items]:
            if pos and filled + size > max_bytes:
                split, pos, filled = split + 1, 0, 0
            out.append((chunk // max_items * max_items + split, pos))
            filled, pos = filled + size, pos + 1
    return out


@pytest.mark.parametrize("max_items,max_bytes,width", [(10, 50, 16), (1000, 10**9, 1 << 20), (7, 1, 5), (25, 200, 64)])
def test_pack_batches_equals_a_loop(spark, max_items, max_bytes, width):
    rng = random.Random(3)
    sizes = [rng.choice([1, 5, 30, 90]) for _ in range(120)]
    df = spool_rows(spark, 120, ("logs",), lambda i: sizes[i]).repartition(5)
    got = batching.pack_batches(df, max_items, max_bytes, width).orderBy("seq").collect()
    assert [(r.batch_no, r.batch_pos) for r in got] == greedy(sizes, max_items, max_bytes)
    assert [r.seq for r in got] == list(range(120))
    bodies = {r.batch_no: r for r in batching.packed_bodies(df, max_items, max_bytes, width).collect()}
    for r in batching.batch_bodies(batching.pack_batches(df, max_items, max_bytes, width)).collect():
        assert bodies.pop(r.batch_no).asDict() == r.asDict()
    assert not bodies


def drained(sizes, max_items, max_bytes):
    """Runs over a queue: the head goes, what does not fit goes behind the rest."""
    queue, runs = list(range(len(sizes))), []
    while queue:
        head, queue = queue[:max_items], queue[max_items:]
        fit = 1
        while fit < len(head) and sum(sizes[i] for i in head[: fit + 1]) <= max_bytes:
            fit += 1
        runs.append(head[:fit])
        queue += head[fit:]
    return {seq: (run, pos) for run, batch in enumerate(runs) for pos, seq in enumerate(batch)}


@pytest.mark.parametrize(
    "n,max_items,max_bytes,width", [(60, 10, 50, 16), (14, 7, 1, 2), (20, 100, 60, 4), (45, 25, 300, 1 << 20), (0, 5, 5, 5)]
)
def test_rotated_batches_equal_a_loop(spark, n, max_items, max_bytes, width):
    rng = random.Random(n)
    sizes = [rng.choice([1, 5, 30, 90]) for _ in range(n)]
    df = spool_rows(spark, n, ("logs",), lambda i: sizes[i]).unionByName(spool_rows(spark, n // 2, ("events",), lambda i: sizes[-i]))
    df = df.unionByName(df.limit(1).withColumn("seq", F.lit(None).cast("bigint"))) if n else df
    got = {}
    for r in batching.rotated_batches(df, max_items, max_bytes, width).collect():
        got.setdefault(r.type, {})[r.seq] = (r.batch_no, r.batch_pos)
    assert got.get("logs", {}) == drained(sizes, max_items, max_bytes)
    assert got.get("events", {}) == drained([sizes[-i] for i in range(n // 2)], max_items, max_bytes)
    if n == 20:
        packed = batching.pack_batches(df, max_items, max_bytes, fifo=False)
        assert packed.columns == [*df.columns, "batch_no", "batch_pos"] and packed.count() == 30


def test_trim_cases(spark):
    three = spool_rows(spark, 3, ("events",), lambda i: 2_000_000)
    assert [r.kept for r in batching.trim_to_bytes(three).orderBy("seq").collect()] == [True, True, False]
    one = spool_rows(spark, 1, ("events",), lambda i: 5_000_000)
    assert [r.kept for r in batching.trim_to_bytes(one).collect()] == [True]


def test_take_and_remainder(spark):
    df = spool_rows(spark, 30).unionByName(spool_rows(spark, 3, ("unknown",)))
    taken = spool.take_fifo(df, 10)
    left = spool.remainder(df, taken)
    assert taken.count() == 20 and left.count() == 13
    assert spool.take_fifo(df, 0).count() == 0


def test_bodies_hold_only_items(spark):
    bodies = batching.batch_bodies(batching.pack_batches(spool_rows(spark, 4, ("javascript_errors",)), 3))
    got = [r.body for r in bodies.orderBy("batch_no").collect()]
    assert got == ['{"javascript_errors":[{"n":0},{"n":1},{"n":2}]}', '{"javascript_errors":[{"n":3}]}']
    assert {r.path for r in bodies.collect()} == {"/javascript-errors/store"}


@pytest.mark.parametrize("ttl", [0, 1, 10, 3600])
def test_idle_lives_and_expiry(spark, ttl):
    rng = random.Random(ttl)
    times, t = [], 1000
    for _ in range(60):
        t += rng.choice([0, 1, ttl, ttl + 1, 3 * ttl + 2, 7])
        times.append(t)
    df = spark.createDataFrame([("events", x) for x in times], "type string, timestamp bigint")
    lives = [[times[0]]]
    for x in times[1:]:
        if ttl >= 1 and x - lives[-1][-1] > ttl:
            lives.append([])
        lives[-1].append(x)
    got = spool.idle_lives(df, ttl=ttl).orderBy("life").collect()
    assert [(r.started_at, r.last_write_at, r.writes) for r in got] == [(v[0], v[-1], len(v)) for v in lives]
    for now, last_gone in ((times[-1] + ttl, False), (times[-1] + ttl + 1, ttl >= 1)):
        expired = spool.idle_expiry(df, now, ttl=ttl).where("expired").count()
        assert expired == sum(len(v) for v in lives[:-1]) + (len(lives[-1]) if last_gone else 0)


@pytest.mark.parametrize("width", [2, 1 << 20])
def test_overflow_cycles(spark, width):
    ops = [("add", 5, 0), ("add", 10, 2), ("add", 10, 1), ("take", 10, 0), ("add", 10, 3), ("take", 4, 0), ("add", 9, 0), ("add", 10, 4)]
    df = spark.createDataFrame([("logs", i, o, s, d) for i, (o, s, d) in enumerate(ops)], "type string, seq bigint, op string, size_after bigint, dropped bigint")
    got = [tuple(r) for r in spool.overflow_cycles(df, 10, width).orderBy("cycle").collect()]
    assert got == [("logs", 1, 1, 4, 3, 6), ("logs", 2, 7, 7, 1, 4)]


# --- delivery ----------------------------------------------------------------------------------


def responses(spark, *rows):
    names = "type string, batch_no bigint, status int, retry_after string, unprocessed int, unprocessed_indexes array<int>, failed int, error_message string, at bigint"
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize(
    "status,requeue,drop,scope,seconds,transient",
    [(0, True, False, "feature", 900, True), (200, False, False, "none", None, False), (201, True, False, "feature", 900, True),
     (401, True, False, "global", 900, False), (403, True, False, "feature", 900, False), (413, False, True, "feature", 900, False),
     (422, False, True, "feature", 900, False), (500, True, False, "feature", 900, True)],
)
def test_response_matrix(spark, status, requeue, drop, scope, seconds, transient):
    row = delivery.decide(responses(spark, ("logs", 0, status, "", 0, [], 0, None, 0))).first()
    assert (row.requeue, row["drop"], row.pause_scope, row.pause_seconds, row.transient) == (requeue, drop, scope, seconds, transient)


@pytest.mark.parametrize("header,seconds", [("5", 5), ("120", 120), ("0", 60), ("", 60), (None, 60), ("-3", 60), ("soon", 60), (" 90 s", 90), ("1.9", 1)])
def test_retry_after(apply, header, seconds):
    assert apply(delivery.retry_after_seconds, [header]) == [seconds]


def test_unprocessed_items_come_back_in_server_order(spark):
    batches = batching.pack_batches(spool_rows(spark, 4, ("logs",)))
    answers = delivery.decide(responses(spark, ("logs", 0, 200, "", 2, [3, 1, 99, -1, 1], 0, None, 0)))
    back = delivery.requeue_unprocessed(answers, batches).orderBy("ordinal").collect()
    assert [r.id for r in back] == ["i3", "i1", "i1"]
    none = delivery.decide(responses(spark, ("logs", 0, 200, "", 0, [1], 0, None, 0)))
    assert delivery.requeue_unprocessed(none, batches).count() == 0


def test_requeued_items_go_to_the_tail(spark):
    all_rows = spool_rows(spark, 6, ("logs",))
    batches = batching.pack_batches(all_rows, 2)
    answers = delivery.decide(responses(spark, *[("logs", b, 500, "", 0, [], 0, None, 0) for b in (0, 2)]))
    left = all_rows.where("seq >= 4")
    after = spool.next_spool(left, delivery.with_slot(delivery.requeue_batches(answers, batches)), 9999, width=4)
    got = [(r.seq, r.data, r.timestamp) for r in after.orderBy("seq").collect()]
    assert got[:2] == [(4, '{"n":4}', 1004), (5, '{"n":5}', 1005)]
    assert got[2:] == [(6 + i, '{"n":%d}' % i, 9999) for i in range(4)]
    assert after.select("id").distinct().count() == 6
    none_left = all_rows.where("seq < 0")
    back = delivery.with_slot(delivery.requeue_batches(answers, batches))
    again = spool.next_spool(none_left, back, 9999, spool.last_given(all_rows))
    assert sorted(r.seq for r in again.collect()) == [6, 7, 8, 9]


def test_pauses(spark):
    pauses = spark.createDataFrame(
        [("logs", 100, 1000, "500"), ("logs", 200, 210, "429"), ("global", 500, 600, "401"), ("events", 50, None, "cleared")],
        "scope string, started_at bigint, paused_until bigint, reason string",
    )
    asked = [(0, "logs", 99), (1, "logs", 100), (2, "logs", 209), (3, "logs", 210), (4, "events", 550), (5, "events", 60), (6, "logs", 600)]
    runs = spark.createDataFrame(asked, "run_id bigint, type string, at bigint")
    for bucket in (10, 3600):
        got = {r.run_id: (r.paused, r.pause_scope, r.reason) for r in delivery.paused_at(runs, pauses, bucket_seconds=bucket).collect()}
        none = (False, None, None)
        assert got == {0: none, 1: (True, "logs", "500"), 2: (True, "logs", "429"), 3: none, 4: (True, "global", "401"), 5: none, 6: none}


# --- sessions ----------------------------------------------------------------------------------


def fifo(keys, cache):
    held, out = OrderedDict(), []
    for place, key in enumerate(keys):
        if key not in held:
            held[key] = 1
            out.append(place)
            if len(held) > cache:
                held.popitem(last=False)
    return out


@pytest.mark.parametrize("cache,segment", [(50, 1 << 17), (3, 1 << 17), (3, 4), (2, 3), (1, 5)])
def test_dedupe_equals_a_loop(spark, cache, segment):
    rng = random.Random(cache * 100 + segment)
    sent, rows, seq = [], [], 0
    for session, length in (("hot", 150), ("a", 20), ("b", 5), (None, 12)):
        keys = [f"k{rng.randrange(8)}" for _ in range(length)]
        sent += [seq + p for p in fifo(keys, cache)]
        rows += [(session, seq + i, k) for i, k in enumerate(keys)]
        seq += length
    df = spark.createDataFrame(rows, "session_id string, seq bigint, message string").repartition(7)
    kept = sessions.dedupe_reports(df, F.col("message"), cache=cache, segment=segment)
    assert sorted(r.seq for r in kept.collect()) == sorted(sent)


def test_a_full_cache_forgets_its_oldest_key(spark):
    keys = [f"k{i}" for i in range(51)] + ["k0", "k50", "k2"]
    df = spark.createDataFrame([("s", i, k) for i, k in enumerate(keys)], "session_id string, seq bigint, message string")
    kept = [r.message for r in sessions.dedupe_reports(df, F.col("message")).orderBy("seq").collect()]
    assert kept == [f"k{i}" for i in range(51)] + ["k0"]


@pytest.mark.parametrize("n,width", [(3, 4), (20, 1 << 20)])
def test_trails_equal_a_loop(spark, n, width):
    rng = random.Random(n)
    rows = [("hot" if rng.random() < 0.6 else "cold", i, rng.random() < 0.4) for i in range(150)]
    wanted, seen = {}, {}
    for session, i, error in rows:
        if error:
            wanted[i] = seen.get(session, [])[-n:]
        else:
            seen.setdefault(session, []).append(f"c{i}")
    df = spark.createDataFrame(rows, "session_id string, seq bigint, error boolean")
    crumb = F.concat(F.lit("c"), F.col("seq").cast("string"))
    got = sessions.breadcrumb_trail(df, F.col("error"), crumb, n=n, width=width).collect()
    assert {r.seq: r.breadcrumbs for r in got} == wanted


# --- shaping -----------------------------------------------------------------------------------


def preview(source, line):
    """The window as a plain loop over lines that keep their newline."""
    lines = source.splitlines(keepends=True) if source else []
    start = max(0, line - 6)
    window = []
    for text in lines[start : start + 11]:
        body, end = (text[:-1], "\n") if text.endswith("\n") else (text, "")
        window.append((body[:2000] + "... (truncated)" if len(body) > 2000 else body) + end)
    parts = [p.rstrip() for p in "".join(window).split("\n")]
    indents = [len(p) - len(p.lstrip()) for p in parts if p]
    shift = min(indents) if indents else 0
    return "\n".join(p[shift:] if p else p for p in parts), line - start


def test_source_previews(spark):
    sources = {
        "a.php": "".join(f"    line {i}  \n" for i in range(1, 21)),
        "b.php": "\t\tif (x) {\n\n\t\t\treturn;\n\t\t}",
        "c.php": "x" * 2500 + "\n  y\n",
        "empty.php": "",
        "huge.php": "z" * C.MAX_SOURCE_FILE_BYTES,
    }
    spots = [("a.php", n) for n in (1, 3, 6, 10, 19, 20, 40)] + [("b.php", 2), ("c.php", 1), ("empty.php", 1), ("huge.php", 1), ("none.php", 1)]
    files = spark.createDataFrame(list(sources.items()), "path string, text string")
    errors = spark.createDataFrame([(i, f, n) for i, (f, n) in enumerate(spots)], "i int, file string, line bigint")
    got = {r.i: (r.context, r.highlight_line) for r in shape.source_preview(errors, files).collect()}
    for i, (file, line) in enumerate(spots):
        wanted = (None, None) if file in ("huge.php", "none.php") else preview(sources[file], line)
        assert got[i] == wanted, (file, line)


def test_log_vocabulary_wins_over_user_keys(spark):
    rows = spark.sql("""SELECT 'NOTICE' AS level, 'm' AS message, parse_json('{}') AS context, 'c' AS channel, timestamp'2024-01-01 00:00:00' AS ts,
        parse_json('{"environment":"mine","php_version":"1","keep":true}') AS extra""")
    full = shape.shape_logs(rows, environment="prod", runtime_version="8", framework="f").select(F.to_json("extra")).first()[0]
    assert full == '{"environment":"prod","framework":"f","keep":true,"php_version":"8"}'
    big = rows.withColumn("extra", F.parse_json(F.concat(F.lit('{"x":"'), F.repeat(F.lit("y"), F.lit(11000)), F.lit('"}'))))
    got = shape.shape_logs(big, environment="prod").select(F.to_json("extra")).first()[0]
    assert got == '{"_truncated":"Extra data exceeded 10KB limit and was removed","environment":"prod","php_version":""}'


def test_property_merges(spark):
    rows = spark.sql("""SELECT 1 AS product_id, 2 AS quantity, parse_json('{"price":9,"category":"x","note":null}') AS extra""")
    products = spark.sql("SELECT 1 AS product_id, 'n' AS product_name, 1.5D AS price, 'shoes' AS category, '' AS nothing")
    got = commerce.cart_add_events(rows, products, F.col("extra"), F.col("category")).select(F.to_json("properties")).first()[0]
    assert got == '{"category":"shoes","note":null,"price":9,"product_id":"1","product_name":"n","quantity":2,"total_value":3.0}'
    got = commerce.cart_add_events(rows, products, None, F.col("nothing")).select(F.to_json("properties")).first()[0]
    assert "category" not in got


def test_a_sale_over_the_budget_is_what_the_budget_makes_of_it(spark):
    orders = spark.createDataFrame([(1, 5.0), (2, 6.0)], "order_id bigint, total_amount double")
    lines = spark.createDataFrame([(1 + (i >= 3), i, i, 1, 2.0) for i in range(10)], "order_id bigint, line_no int, product_id bigint, quantity bigint, price double")
    product = len('{"product_id":"1","quantity":1,"price":2}')  # a whole float counts without its fraction

    def sold(max_item):
        sales = commerce.sale_events(orders, lines, max_item=max_item)
        items = budget.item_budget(
            sales.select("order_id", F.col("name").alias("event_name"), "properties"), "events", keep=("order_id",), max_item=max_item, max_field=200
        )
        return {r.order_id: r.p for r in sales.select("order_id", F.to_json("properties").alias("p")).collect()}, {r.order_id: r.data for r in items.collect()}

    whole, items = sold(10_000)
    assert whole[1].count("product_id") == 3 and '"product_count":7' in whole[2]
    cut, cut_items = sold(7 * (product + 1))
    assert cut[2] == '{"_truncated":"Field exceeded the per-item budget and was removed"}'
    assert cut[1] == whole[1]
    budgeted = budget.item_budget(
        commerce.sale_events(orders, lines).select("order_id", F.col("name").alias("event_name"), "properties"),
        "events", keep=("order_id",), max_item=7 * (product + 1), max_field=200,
    )
    assert {r.order_id: r.data for r in budgeted.collect()}[2] == cut_items[2]


def test_item_budget_steps(spark):
    big = "é" * 50_000
    rows = spark.createDataFrame(
        [(0, "small", '{"a":1}'), (1, big, '{"a":1}'), (2, big, '{"a":"%s"}' % ("x" * 9000))], "k int, message string, j string"
    ).select("k", F.lit("notice").alias("level"), "message", F.parse_json("j").alias("context"))
    got = {r.k: r for r in budget.item_budget(rows, "logs", keep=("k",)).collect()}
    assert [got[i].budget_status for i in range(3)] == ["ok", "shrunk", "shrunk"]
    assert got[2].data.endswith('"context":{"_truncated":"Field exceeded the per-item budget and was removed"}}')
    assert "é" * 4096 + "... (truncated)" in got[1].data and "é" * 4097 not in got[1].data
    columns = [F.lit("é" * 8000).alias(f) for f in ("message", "level", "channel", "timestamp")]
    tiny = spark.range(1).select(F.col("id").alias("k"), *columns)
    assert budget.item_budget(tiny, "logs", keep=("k",), max_item=1000, max_field=4000).count() == 0
    assert budget.item_budget(tiny, "logs", keep=("k",), max_item=1000, max_field=4000, dropped_too=True).first().budget_status == "dropped"


# --- validation --------------------------------------------------------------------------------


def report(**changed):
    base = {"message": "Boom", "url": "https://a.test", "line": 1, "breadcrumbs": [{"timestamp": "t", "category": "c", "message": "m"}]}
    return {k: v for k, v in {**base, **changed}.items() if v != "absent"}


REPORTS = [
    ({}, {}),
    ({"message": "absent"}, {"message": "required"}),
    ({"message": "   "}, {"message": "required"}),
    ({"message": 5}, {"message": "string"}),
    ({"message": "x" * 2001}, {"message": "2000"}),
    ({"stack": ["a"]}, {"stack": "string"}),
    ({"type": "x" * 101}, {"type": "100"}),
    ({"line": "12"}, {}),
    ({"line": "1.5"}, {"line": "integer"}),
    ({"line": True}, {"line": "integer"}),
    ({"column": 2.5}, {"column": "integer"}),
    ({"column": "007"}, {"column": "integer"}),
    ({"url": ""}, {"url": "required"}),
    ({"url": []}, {"url": "required"}),
    ({"timestamp": "x" * 65}, {"timestamp": "64"}),
    ({"breadcrumbs": "no"}, {"breadcrumbs": "array"}),
    ({"breadcrumbs": [5, {"timestamp": "t", "category": "c" * 101, "message": "m", "data": 1}]},
     {"breadcrumbs.0.timestamp": "required", "breadcrumbs.0.category": "required", "breadcrumbs.0.message": "required",
      "breadcrumbs.1.category": "100", "breadcrumbs.1.data": "array"}),
    ({"context": "x"}, {"context": "array"}),
    ({"browser_info": {"screen_width": "1e3", "device_memory": 0.5, "connection_type": "4g"}}, {}),
    ({"browser_info": {"screen_width": "wide", "viewport_width": True, "connection_type": "x" * 51}},
     {"browser_info.screen_width": "number", "browser_info.viewport_width": "number", "browser_info.connection_type": "50"}),
]


def test_browser_report_rules(spark):
    import json

    rows = spark.createDataFrame([(i, json.dumps(report(**changed))) for i, (changed, _) in enumerate(REPORTS)], "i int, j string")
    checked = rows.select("i", validate.report_problems(F.parse_json("j")).alias("p")).collect()
    for row in checked:
        wanted = REPORTS[row.i][1]
        assert {p.field for p in row.p} == set(wanted), REPORTS[row.i]
        assert all(wanted[p.field] in p.message for p in row.p)


ODD_REPORTS = [
    {"message": "\u2003\u0085"}, {"message": "\u0085"}, {"message": "\n"}, {"message": " \n x"}, {"message": "\U0001f600" * 2000},
    {"message": "\U0001f600" * 2001}, {"message": 5}, {"message": None}, {"url": None}, {"url": " "}, {"url": False}, {"line": None},
    {"line": "0"}, {"line": "00"}, {"line": " 7 "}, {"line": "9" * 18}, {"line": "9" * 30}, {"line": 7.0}, {"column": 1e20},
    {"column": "\u0663"}, {"breadcrumbs": None}, {"breadcrumbs": []}, {"breadcrumbs": {}}, {"breadcrumbs": {"a": {"timestamp": "t"}}},
    {"breadcrumbs": [None, {"timestamp": "t", "category": "c", "message": "m", "data": []}]},
    {"breadcrumbs": [{"timestamp": "t", "category": "c", "message": "m", "data": None, "more": 1}]},
    {"context": []}, {"context": None}, {"context": {}}, {"browser_info": None}, {"browser_info": []}, {"browser_info": {}},
    {"browser_info": {"connection_type": " ", "device_memory": "1.5", "screen_width": None, "viewport_width": True}},
]


@pytest.mark.parametrize("referer", [None, " ", "https://r.test/", "r" * 2001])
def test_parts_let_through_have_no_problem_field_by_field(spark, referer):
    import json

    reports = [json.dumps(report(**changed)) for changed in [*ODD_REPORTS, *[c for c, _ in REPORTS]]]
    reports += ["5", "null", "[]", "{}", '"x"', None]
    rows = spark.createDataFrame([(i, j) for i, j in enumerate(reports)], "i int, j string").withColumn("v", F.parse_json("j"))
    given = F.lit(referer).cast("string")
    judged = F.struct(validate._members(F.col("v")).alias("m"), given.alias("r"))
    each = [part(judged) for part in (validate._top_problems, validate._crumb_problems, validate._info_problems)]
    found = rows.select("j", validate.report_problems(F.col("v"), given).alias("p"), F.array_compact(F.concat(*each)).alias("q"))
    for row in found.collect():
        assert row.p == row.q, row.j


def test_rejected_reports_are_judged_once(spark):
    raw = spark.sql("""SELECT 1 AS report_id, true AS enabled, true AS feature_enabled,
        map('HTTP_HOST', 'a.test', 'HTTP_ORIGIN', 'https://a.test') AS request, parse_json('{"line":"x"}') AS payload FROM range(3)""")
    rejected = flows.rejected_reports(raw)
    assert [p.field for p in rejected.first().problems] == ["message", "line", "url"]
    assert rejected._jdf.queryExecution().optimizedPlan().toString().count("breadcrumbs.,") == 1


def test_blank_url_takes_the_referer(spark):
    rows = spark.sql("""SELECT parse_json('{"message":"m","url":" "}') AS payload, map('HTTP_REFERER', 'https://r.test/') AS request""")
    assert validate.validate_browser_report(rows).select(F.size("problems")).first()[0] == 0
    assert validate.fill_report_url(rows).select(F.to_json("payload")).first()[0] == '{"message":"m","url":"https://r.test/"}'


MINIMAL = {
    "errors": {"message": "m", "file": "f", "line": 1, "type": "t", "environment": "e", "timestamp": "2026-08-19T09:30:45+00:00"},
    "events": {"event_name": "cart_viewed", "timestamp": "2026-08-19T09:30:45+00:00"},
    "logs": {"level": "notice", "message": "m", "channel": "app", "timestamp": "2026-08-19T02:15:00+00:00"},
    "javascript_errors": {"message": "m", "timestamp": "2026-08-19T09:30:45+00:00", "url": "https://a.test"},
}


@pytest.mark.parametrize("record_type", C.TYPES)
def test_minimal_records_pass_and_each_required_field_counts(spark, record_type):
    import json

    minimal = MINIMAL[record_type]
    required = [f for f, r in C.RULES[record_type].items() if r.get("required") and "." not in f]
    records = [minimal] + [{k: v for k, v in minimal.items() if k != f} for f in required]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, j string")
    checked = validate.validate(rows.select("i", F.parse_json("j").alias("record")), record_type, record="record")
    got = [r.violations for r in checked.orderBy("i").collect()]
    assert got == [[]] + [[f"{f}: missing"] for f in required]


def test_known_gaps_between_shaper_and_contract_surface(spark):
    """A command line is not cut, though the contract limits it; so is a shaped method any word."""
    rows = spark.createDataFrame(
        [("m", "f", 1, "t", "e", "x", ["run", "a" * 1200], True)],
        "message string, file string, line bigint, type string, environment string, trace string, argv array<string>, is_console boolean",
    ).withColumns({"ts": F.lit("2024-01-01").cast("timestamp"), "request": F.create_map(F.lit("REQUEST_METHOD"), F.lit("fetch"))})
    console = validate.validate(shape.shape_errors(rows), "errors").first().violations
    assert console == ["console_command: max 1000 characters, found 1204"]
    web = validate.validate(shape.shape_errors(rows.withColumn("is_console", F.lit(False))), "errors").first().violations
    assert web == ["method: not in {GET,POST,PUT,PATCH,DELETE,HEAD,OPTIONS}"]
    assert shape.shape_errors(rows).columns == [f.name for f in __import__("tracewell.schemas", fromlist=["x"]).ITEMS["errors"].fields]


def test_abuse_checks(spark):
    import json

    cases = [
        ("ok_name", {"a": 1, "b": 2}, []),
        ("debug", {}, ["forbidden_event_name"]),
        ("ok_name", {"a": "x" * 501}, ["max_property_value_chars", "max_consecutive_character_repetition"]),
        ("ok_name", {"a": "\n" * 51}, ["max_consecutive_character_repetition"]),
        ("ok_name", {"a": "y" * 50}, []),
        ("ok_name", {f"k{i}": 1 for i in range(5)}, ["max_property_repetition_ratio"]),
        ("ok_name", {**{f"k{i}": 1 for i in range(4)}, "z": 2}, []),
        ("ok_name", {"only": 1}, []),
    ]
    rows = spark.createDataFrame([(i, n, json.dumps(p)) for i, (n, p, _) in enumerate(cases)], "i int, event_name string, j string")
    checked = validate.event_abuse_checks(rows.withColumn("properties", F.parse_json("j")))
    assert [r.abuse for r in checked.orderBy("i").collect()] == [wanted for _, _, wanted in cases]


def test_routes_by_shape_equal_routes_by_first_segments(spark, monkeypatch):
    rng = random.Random(12)
    words = ["a", "b", "reset", "x.y", "{id}", "{token}", "{q}", "{id}"]
    patterns = ["/" + "/".join(rng.choice(words) for _ in range(rng.randint(1, 5))) + rng.choice(["", "/"]) for _ in range(80)] + ["/", "/{token}"]
    routes = spark.createDataFrame([(p, rng.choice([["token"], ["token", "q"], [], ["id"]])) for p in patterns], "pattern string, secret_params array<string>")
    parts = ["a", "b", "reset", "x.y", "s1", "s2", "", "{id}"]
    urls = [None, "", "/", "//h", "https://h.x/a/s1?x=/b#y", "?q", "/a//b"]
    urls += [rng.choice(["https://h.x", "", "//h"]) + "/" + "/".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) + rng.choice(["", "?a=b", "/"]) for _ in range(300)]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls + urls[:20])], "i int, url string")
    few = {r.i: sorted(r.path_secrets) for r in shape.attach_path_secrets(rows, routes).collect() if r.path_secrets is not None}
    monkeypatch.setattr(shape, "MOST_ROUTES", 3)
    many = {r.i: sorted(r.path_secrets) for r in shape.attach_path_secrets(rows, routes).collect()}
    assert len(many) == len(rows.collect()) and sum(map(bool, many.values())) > 50
    assert {i: many[i] for i in few} == few


def test_a_hundred_thousand_routes_have_no_hot_key(spark):
    """Half begin with two parameters; a URL is looked up in as many rows as there are shapes of its length."""
    literal = F.concat(F.lit("r"), F.col("id").cast("string"))
    pattern = F.when(F.col("id") % 2 == 0, F.concat(F.lit("/{a}/{token}/"), literal)).otherwise(F.concat(F.lit("/"), literal, F.lit("/{token}/end")))
    routes = spark.range(100_000).select(pattern.alias("pattern"), F.array(F.lit("token")).alias("secret_params"))
    urls = spark.range(2000).select("id", F.concat(F.lit("https://h/x/s"), F.col("id").cast("string"), F.lit("/r"), (F.col("id") * 2).cast("string")).alias("url"))
    found = shape.attach_path_secrets(urls, routes)
    assert found.where(F.col("path_secrets") == F.array(F.concat(F.lit("s"), F.col("id").cast("string")))).count() == 2000


def test_dimensions_with_repeated_keys_double_nothing(spark):
    users = spark.createDataFrame([("k", 2, "b@x"), ("k", 1, "a@x"), ("k", 1, "a@x")], "key string, id bigint, email string")
    rows = spark.createDataFrame([(1, "k"), (2, "z"), (3, None)], "n int, key string")
    got = {r.n: r.user for r in shape.attach_user(rows, users, on="key", explicit=None).collect()}
    assert len(got) == 3 == shape.attach_user(rows, users, on="key", explicit=None).count() and got[1].id == "1" and got[2] is None
    files = spark.createDataFrame([("f", "a\nb\n"), ("f", "x\ny\n"), ("g", "q")], "path string, text string")
    errors = spark.createDataFrame([(1, "f", 1), (2, "f", 2), (3, "g", 1)], "n int, file string, line int")
    assert shape.source_preview(errors, files).count() == 3


def test_sketches_of_days_count_a_range(spark):
    df = spark.range(40_000).select((F.col("id") % 7).cast("string").alias("day"), F.pmod(F.xxhash64("id"), F.lit(9000)).alias("v"))
    df = df.unionByName(spark.createDataFrame([("7", None)], "day string, v bigint"))
    sketches = sessions.daily_visitor_sketches(df, F.col("day"), "v")
    whole = sessions.visitors_over(sketches).first()
    exact = df.agg(F.count_distinct("v")).first()[0]
    assert abs(whole.visitors - exact) < 0.06 * exact and whole.events == 40_001 and whole.days == 8
    assert sessions.visitors_over(sketches.where("day = '7'")).first().visitors == 0
