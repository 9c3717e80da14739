"""The spool and its batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.operators import batching, spool
from tracewell.plans import inputs
from tracewell.plans.registry import ORACLES, query

_B = inputs.BACKLOG_SQL


@query(
    "spool_stats",
    f"""WITH {_B} SELECT type, count(*) AS items, arg_min("timestamp", seq) AS oldest_at FROM backlog GROUP BY type""",
)
def spool_stats(spark, folder):
    return spool.spool_stats(inputs.backlog(spark, folder))


@query(
    "keep_newest",
    f"""WITH {_B} SELECT type, id, seq FROM backlog QUALIFY row_number() OVER (PARTITION BY type ORDER BY seq DESC) <= 5000""",
)
def keep_newest(spark, folder):
    """The newest records of each type, as many as a spool holds."""
    return spool.keep_newest(inputs.backlog(spark, folder)).select("type", "id", "seq")


@query(
    "keep_newest_few",
    f"""WITH {_B} SELECT type, id, seq FROM backlog QUALIFY row_number() OVER (PARTITION BY type ORDER BY seq DESC) <= 77""",
)
def keep_newest_few(spark, folder):
    """A capacity that every type exceeds, found across buckets of a few numbers."""
    return spool.keep_newest(inputs.backlog(spark, folder), 77, width=64).select("type", "id", "seq")


@query(
    "overflow_report",
    f"""WITH {_B} SELECT type, least(count(*), 2000) AS kept, greatest(count(*) - 2000, 0) AS dropped FROM backlog GROUP BY type""",
)
def overflow_report(spark, folder):
    return spool.overflow_report(inputs.backlog(spark, folder), 2000)


@query(
    "take_fifo",
    f"""WITH {_B} SELECT type, id, seq FROM backlog QUALIFY row_number() OVER (PARTITION BY type ORDER BY seq) <= 1000""",
)
def take_fifo(spark, folder):
    return spool.take_fifo(inputs.backlog(spark, folder)).select("type", "id", "seq")


@query(
    "spool_remainder",
    f"""WITH {_B}, r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY seq) AS n FROM backlog)
        SELECT type, count(*) AS items, min(seq) AS first_seq FROM r WHERE n > 1000 GROUP BY type""",
)
def spool_remainder(spark, folder):
    backlog = inputs.backlog(spark, folder)
    left = spool.remainder(backlog, spool.take_fifo(backlog))
    return left.groupBy("type").agg(F.count(F.lit(1)).alias("items"), F.min("seq").alias("first_seq"))


@query(
    "empty_takes",
    f"""WITH {_B}, mixed AS (SELECT CASE WHEN seq % 3 = 0 THEN 'page_visits' ELSE type END AS type, seq FROM backlog),
          taken AS (SELECT type, seq FROM mixed WHERE type <> 'page_visits' QUALIFY row_number() OVER (PARTITION BY type ORDER BY seq) <= 10)
        SELECT type, count(*) AS items, 0 AS taken_of_none, count(t.seq) AS taken_of_ten FROM mixed LEFT JOIN taken t USING (type, seq) GROUP BY type""",
)
def empty_takes(spark, folder):
    """Of a backlog with known and unknown types: what a limit of none and one of ten take of each."""
    kind = F.when(F.col("seq") % 3 == 0, "page_visits").otherwise(F.col("type"))
    backlog = inputs.backlog(spark, folder).withColumn("type", kind)
    takes = [
        spool.take_fifo(backlog, n).groupBy("type").agg(F.count(F.lit(1)).alias(name)) for n, name in ((0, "taken_of_none"), (10, "taken_of_ten"))
    ]
    found = backlog.groupBy("type").agg(F.count(F.lit(1)).alias("items"))
    for taken in takes:
        found = found.join(taken, "type", "left")
    return found.fillna(0, ["taken_of_none", "taken_of_ten"])


@query(
    "batch_trim",
    """WITH t AS (SELECT doc_id, lang, strlen(text) AS bytes, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents),
         c AS (SELECT doc_id, lang, (n - 1) // 100 AS chunk, n, sum(bytes) OVER (PARTITION BY lang, (n - 1) // 100 ORDER BY n) AS running,
             row_number() OVER (PARTITION BY lang, (n - 1) // 100 ORDER BY n) AS pos FROM t)
       SELECT doc_id, lang, chunk, pos = 1 OR running <= 200000 AS kept FROM c""",
)
def batch_trim(spark, folder):
    """The prefix rule on chunks of a hundred documents per language."""
    docs = inputs.load(spark, folder, "documents").select(
        "doc_id", "lang", F.octet_length("text").alias("bytes")
    )
    from tracewell.operators import ordered

    chunked = ordered.add_position(docs, ["lang"], "doc_id").withColumn("chunk", F.expr("position div 100"))
    trimmed = batching.trim_to_bytes(chunked, 200_000, keys=("lang", "chunk"), order="doc_id")
    return trimmed.select("doc_id", "lang", "chunk", "kept")


_PACKED = """
WITH RECURSIVE t AS (SELECT doc_id, 'logs' AS type, strlen(text) AS bytes, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents),
  c AS (SELECT *, p // 200 AS chunk, p % 200 AS i FROM t),
  walk AS (
    SELECT doc_id, chunk, i, bytes AS filled, 0 AS split, 0 AS pos FROM c WHERE i = 0
    UNION ALL
    SELECT c.doc_id, c.chunk, c.i, CASE WHEN w.filled + c.bytes > 100000 THEN c.bytes ELSE w.filled + c.bytes END,
      CASE WHEN w.filled + c.bytes > 100000 THEN w.split + 1 ELSE w.split END,
      CASE WHEN w.filled + c.bytes > 100000 THEN 0 ELSE w.pos + 1 END
    FROM walk w JOIN c ON c.chunk = w.chunk AND c.i = w.i + 1
  )"""


@query(
    "packed_batches",
    f"""{_PACKED} SELECT doc_id, 'logs' AS type, chunk * 200 + split AS batch_no, pos AS batch_pos FROM walk""",
)
def packed_batches(spark, folder):
    """The whole backlog of documents in batches of at most 200 items and 100 000 bytes."""
    docs = inputs.load(spark, folder, "documents").select(
        F.lit("logs").alias("type"), F.col("doc_id").alias("seq"), F.octet_length("text").cast("bigint").alias("bytes")
    )
    packed = batching.pack_batches(docs, max_items=200, max_bytes=100_000)
    return packed.select(F.col("seq").alias("doc_id"), "type", "batch_no", "batch_pos")


_ROTATED = """
WITH RECURSIVE backlog AS (SELECT lang AS type, doc_id AS seq, strlen(text) AS bytes FROM documents),
  queues AS (
    SELECT type, CAST(-1 AS BIGINT) AS batch_no, list({'seq': seq, 'bytes': bytes} ORDER BY seq) AS waiting, CAST([] AS BIGINT[]) AS sent
    FROM backlog WHERE type IS NOT NULL AND seq IS NOT NULL GROUP BY type
    UNION ALL
    SELECT type, batch_no + 1, list_concat(waiting[41:], waiting[fit + 1:40]), list_transform(waiting[1:fit], lambda i: CAST(i.seq AS BIGINT))
    FROM (SELECT *, greatest(1, len(list_filter(range(1, least(len(waiting), 40) + 1),
            lambda k: list_sum(list_transform(waiting[1:k], lambda i: i.bytes)) <= 60000))) AS fit
          FROM queues WHERE len(waiting) > 0)
  )"""


@query(
    "rotated_batches",
    f"""{_ROTATED} SELECT type, unnest(sent) AS doc_id, batch_no, unnest(range(len(sent))) AS batch_pos FROM queues""",
)
def rotated_batches(spark, folder):
    """Batches of a backlog whose deferred records go behind newer ones, run by run."""
    docs = inputs.load(spark, folder, "documents").select(
        F.col("lang").alias("type"), F.col("doc_id").alias("seq"), F.octet_length("text").cast("bigint").alias("bytes")
    )
    packed = batching.pack_batches(docs, max_items=40, max_bytes=60_000, fifo=False)
    return packed.select("type", F.col("seq").alias("doc_id"), "batch_no", "batch_pos")


@query(
    "numberless_records",
    f"""WITH {_B}, b AS (SELECT type, id, CASE WHEN seq % 9 <> 4 THEN seq END AS seq FROM backlog),
          r AS (SELECT *, row_number() OVER (PARTITION BY type, seq IS NULL ORDER BY seq) AS n FROM b)
        SELECT type, CASE WHEN seq IS NULL THEN 'unplaced' WHEN n <= 30 THEN 'taken' ELSE 'left' END AS goes, count(*) AS records,
          min(id) AS least_id, max(id) AS greatest_id
        FROM r GROUP BY ALL""",
)
def numberless_records(spark, folder):
    """Every record is taken, left or unplaced: some have no number."""
    seq = F.when(F.col("seq") % 9 != 4, F.col("seq"))
    backlog = inputs.backlog(spark, folder).withColumn("seq", seq)
    taken = spool.take_fifo(backlog, 30, width=256)
    parts = {"taken": taken, "left": spool.remainder(backlog, taken), "unplaced": spool.unplaced(backlog)}
    rows = [part.select("type", "id", F.lit(goes).alias("goes")) for goes, part in parts.items()]
    both = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return both.groupBy("type", "goes").agg(
        F.count(F.lit(1)).alias("records"), F.min("id").alias("least_id"), F.max("id").alias("greatest_id")
    )


@query(
    "batch_sizes",
    f"""WITH {_B}, p AS (SELECT *, (row_number() OVER (PARTITION BY type ORDER BY seq) - 1) // 1000 AS chunk FROM backlog)
        SELECT type, chunk * 1000 AS batch_no, count(*) AS items, CAST(sum(bytes) AS BIGINT) AS bytes,
          length('{{"' || type || '":[' || string_agg(data, ',' ORDER BY seq) || ']}}') AS body_chars,
          md5('{{"' || type || '":[' || string_agg(data, ',' ORDER BY seq) || ']}}') AS body_md5
        FROM p GROUP BY type, chunk""",
)
def batch_sizes(spark, folder):
    """Batch bodies: one wrapper key, the items in FIFO order, nothing of the envelope; made of packed records."""
    bodies = batching.batch_bodies(batching.pack_batches(inputs.backlog(spark, folder)))
    return bodies.select(
        "type", "batch_no", "items", "bytes", F.length("body").cast("bigint").alias("body_chars"), F.md5("body").alias("body_md5")
    )


@query("packed_bodies", ORACLES["batch_sizes"])
def packed_bodies(spark, folder):
    """The same bodies, made without spreading the records between packing and writing."""
    bodies = batching.packed_bodies(inputs.backlog(spark, folder))
    return bodies.select(
        "type", "batch_no", "items", "bytes", F.length("body").cast("bigint").alias("body_chars"), F.md5("body").alias("body_md5")
    )


@query(
    "idle_lives",
    f"""WITH {_B}, s AS (SELECT type, "timestamp" AS t, "timestamp" - lag("timestamp") OVER (PARTITION BY type ORDER BY "timestamp") > 1800 AS gap FROM backlog),
          l AS (SELECT type, t, sum(CASE WHEN gap IS NULL OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY type ORDER BY t) AS life FROM s)
        SELECT type, CAST(life AS BIGINT) AS life, min(t) AS started_at, max(t) AS last_write_at, count(*) AS writes FROM l GROUP BY ALL""",
)
def idle_lives(spark, folder):
    return spool.idle_lives(inputs.backlog(spark, folder), ttl=1800)


@query(
    "idle_expiry",
    f"""WITH {_B}, e AS (SELECT max("timestamp") + 600 AS now FROM backlog),
          s AS (SELECT type, id, "timestamp" AS t, "timestamp" - lag("timestamp") OVER (PARTITION BY type ORDER BY "timestamp") > 1800 AS gap FROM backlog),
          l AS (SELECT type, id, t, sum(CASE WHEN gap IS NULL OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY type ORDER BY t) AS life FROM s),
          x AS (SELECT type, life, max(t) AS last_t, max(life) OVER (PARTITION BY type) AS last_life FROM l GROUP BY type, life)
        SELECT l.type, id, CASE WHEN x.life < x.last_life THEN TRUE ELSE (SELECT now FROM e) - last_t > 1800 END AS expired
        FROM l JOIN x ON l.type = x.type AND l.life = x.life""",
)
def idle_expiry(spark, folder):
    """The read happens ten minutes after the last record of the table."""
    backlog = inputs.backlog(spark, folder)
    now = backlog.agg(F.max("timestamp") + 600).first()[0]
    return spool.idle_expiry(backlog, now, ttl=1800).select("type", "id", "expired")


@query(
    "overflow_cycles",
    f"""WITH o AS (SELECT event_id AS seq, {inputs.TYPE_SQL} AS type, CASE WHEN user_id % 3 = 0 THEN 'take' ELSE 'add' END AS op,
            CAST(replace(replace(props, '{{"k": ', ''), '}}', '') AS BIGINT) * 60 AS size_after FROM events),
          d AS (SELECT *, CASE WHEN op = 'add' THEN greatest(size_after - 5000, 0) ELSE 0 END AS dropped FROM o),
          st AS (SELECT *, CASE WHEN op = 'add' AND dropped > 0 THEN 1 WHEN op = 'take' AND size_after < 5000 THEN 0 END AS state FROM d),
          ch AS (SELECT *, lag(state) OVER (PARTITION BY type ORDER BY seq) AS prev FROM st WHERE state IS NOT NULL),
          cy AS (SELECT *, sum(CASE WHEN state = 1 AND coalesce(prev, 0) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY type ORDER BY seq) AS cycle FROM ch)
        SELECT type, CAST(cycle AS BIGINT) AS cycle, min(seq) AS opened_at, max(seq) AS last_overflow_at, count(*) AS overflows, CAST(sum(dropped) AS BIGINT) AS dropped
        FROM cy WHERE state = 1 GROUP BY type, cycle""",
)
def overflow_cycles(spark, folder):
    e = inputs.load(spark, folder, "events")
    size = F.get_json_object("props", "$.k").cast("bigint") * 60
    op = F.when(F.col("user_id") % 3 == 0, "take").otherwise("add")
    operations = e.select(
        F.col("event_id").alias("seq"), inputs.type_of_event(F.col("event_type")).alias("type"), op.alias("op"), size.alias("size_after")
    ).withColumn("dropped", F.when(F.col("op") == "add", F.greatest(F.col("size_after") - 5000, F.lit(0))).otherwise(0))
    return spool.overflow_cycles(operations, width=1 << 10)


@query(
    "discarded_backlog",
    f"""WITH {_B} SELECT type, count(*) AS items FROM backlog WHERE type <> 'logs' GROUP BY type""",
)
def discarded_backlog(spark, folder):
    left = spool.discard_backlog(inputs.backlog(spark, folder), "logs")
    return left.groupBy("type").agg(F.count(F.lit(1)).alias("items"))


@query(
    "fifo_order",
    f"""WITH {_B}, r AS (SELECT type, seq, row_number() OVER (ORDER BY CASE type WHEN 'errors' THEN 1 WHEN 'events' THEN 2 WHEN 'logs' THEN 3 ELSE 4 END, seq) AS n FROM backlog)
        SELECT type, count(*) AS items, min(n) - 1 AS first_place, max(n) - 1 AS last_place FROM r GROUP BY type""",
)
def fifo_order(spark, folder):
    """Read order of the whole spool: the id that Spark gives rows in order rises with it."""
    placed = spool.fifo_order(inputs.backlog(spark, folder)).withColumn("_place", F.monotonically_increasing_id())
    ranked = placed.groupBy("type").agg(
        F.count(F.lit(1)).alias("items"), F.min("_place").alias("_first"), F.max("_place").alias("_last")
    )
    from pyspark.sql import Window

    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("items").over(before), F.lit(0))
    return ranked.select(
        "type", "items", start.alias("first_place"), (start + F.col("items") - 1).alias("last_place")
    )


@query(
    "all_errors",
    """SELECT 'err_' || doc_id AS id, 'errors' AS source, lang AS message, NULL AS page FROM documents
       UNION ALL SELECT 'jserr_' || event_id, 'javascript_errors', event_type, CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'error'""",
)
def all_errors(spark, folder):
    php = inputs.load(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("message"))
    js = inputs.load(spark, folder, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("message"), F.col("user_id").cast("string").alias("page")
    )
    return spool.all_errors(php, js)
