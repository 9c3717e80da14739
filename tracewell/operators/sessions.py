"""Per-session rules: duplicate reports, breadcrumb trails, daily visitors."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell import session as settings
from tracewell.operators import ordered

SEGMENT = 1 << 17
SKETCH_PRECISION = 12  # 2^12 registers a sketch


def report_key(message: str = "message", filename: str = "filename", line: str = "line", column: str = "column") -> Column:
    return F.concat_ws(
        "|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (message, filename, line, column)]
    )


def dedupe_reports(
    df: DataFrame,
    key: Column,
    session: str = "session_id",
    order: str = "seq",
    cache: int = C.DEDUPE_CACHE,
    segment: int = SEGMENT,
) -> DataFrame:
    """Reports that are not in the session's cache of the last `cache` keys it sent.

    A hit does not refresh its key: keys leave in the order they came.  While a session has no
    more distinct keys than the cache holds, nothing ever leaves it, so the first report of each
    key is what is sent: an aggregation that combines before it shuffles.  Only sessions with
    more keys need their reports in order; those longer than `segment` are cut, see `_replay`.
    `order` is a unique integer.  A null key equals other null keys of its session.
    """
    slim, firsts, within, short, long = _by_size(df, key, session, order, cache, segment)
    sent = firsts.join(within, "_session", "left_semi").select("_session", "_seq")
    sent = sent.unionByName(_sent(_pass(_one_segment(slim, short), cache)))
    if not long.isEmpty():
        sent = sent.unionByName(_replay(slim.join(long, "_session", "left_semi"), cache, segment))
    marked = df.withColumn("_session", F.coalesce(F.col(session).cast("string"), F.lit(""))).withColumn(
        "_seq", F.col(order).cast("bigint")
    )
    return marked.join(sent, ["_session", "_seq"], "left_semi").drop("_session", "_seq")


def _by_size(df: DataFrame, key: Column, session: str, order: str, cache: int, segment: int) -> tuple[DataFrame, ...]:
    """Slim reports, the first of each key, and the sessions by what they need."""
    slim = df.select(
        F.coalesce(F.col(session).cast("string"), F.lit("")).alias("_session"),
        cache_key(key).alias("_key"),
        F.col(order).cast("bigint").alias("_seq"),
    )
    firsts = slim.groupBy("_session", "_key").agg(F.min("_seq").alias("_seq"), F.count(F.lit(1)).alias("_n"))
    sizes = firsts.groupBy("_session").agg(F.count(F.lit(1)).alias("_keys"), F.sum("_n").alias("_rows"))
    within = sizes.where(F.col("_keys") <= cache)
    outgrown = sizes.where(F.col("_keys") > cache)
    return slim, firsts, within, outgrown.where(F.col("_rows") <= segment), outgrown.where(F.col("_rows") > segment)


def cache_key(key: Column) -> Column:
    """A key as caches hold it; a null key is a key like any other."""
    return F.coalesce(F.sha2(key.cast("string"), 256), F.lit(""))


def _one_segment(slim: DataFrame, short: DataFrame) -> DataFrame:
    return slim.join(short, "_session", "left_semi").withColumn("_segment", F.lit(0).cast("bigint"))


def session_caches(
    df: DataFrame,
    key: Column,
    session: str = "session_id",
    order: str = "seq",
    cache: int = C.DEDUPE_CACHE,
    segment: int = SEGMENT,
) -> DataFrame:
    """`session, keys`: what each session's cache holds after these reports, the oldest key first.

    A stream of later reports starts from it (`stateful.dedupe_reports_stream`).
    """
    slim, firsts, within, short, long = _by_size(df, key, session, order, cache, segment)
    keys = F.transform(F.array_sort(F.collect_list(F.struct("_seq", "_key"))), lambda f: f["_key"])  # at most `cache`
    held = firsts.join(within, "_session", "left_semi").groupBy("_session").agg(keys.alias("keys"))
    held = held.unionByName(_pass(_one_segment(slim, short), cache, ends=True).select("_session", F.col("_end").alias("keys")))
    if not long.isEmpty():
        states = _settled(slim.join(long, "_session", "left_semi"), cache, segment)[1]
        held = held.unionByName(states.groupBy("_session").agg(F.max_by("_end", "_segment").alias("keys")))
    return held.select(F.col("_session").alias("session"), "keys")


def _run_cache(keys, held: OrderedDict, cache: int) -> list[bool]:
    """Pass keys through a first-in first-out cache; True where a key was not in it."""
    sent = []
    for key in keys:
        fresh = key not in held
        if fresh:
            held[key] = None
            if len(held) > cache:
                held.popitem(last=False)
        sent.append(fresh)
    return sent


_PASSED = "_session string, _segment bigint, _seq bigint, _start array<string>, _end array<string>"


def _pass(rows: DataFrame, cache: int, starts: DataFrame | None = None, ends: bool = False) -> DataFrame:
    """Run segments of reports through their caches, in order.

    Reads `_session, _segment, _seq, _key`.  A segment starts with an empty cache, or with the
    one `starts` names for it.  Gives the reports that are sent, or with `ends` one row per
    segment with the caches it started and ended with.  The rows stream through in batches: a
    task holds one batch and one cache, however long a segment is.
    """
    none = F.lit(None)
    stream = rows.select("_session", "_segment", "_seq", "_key", none.cast("array<string>").alias("_start"))
    if starts is not None:
        opening = starts.select("_session", "_segment", none.cast("bigint").alias("_seq"), none.cast("string").alias("_key"), "_start")
        stream = stream.unionByName(opening)
    # The opening row of a segment has no number and sorts before its reports.
    stream = stream.repartition("_session", "_segment").sortWithinPartitions("_session", "_segment", F.col("_seq").asc_nulls_first())

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, start, held = None, [], OrderedDict()
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("_session", "_segment", "_seq", "_key", "_start"))
            for session, segment, seq, key, given in zip(*columns):
                if (session, segment) != place:
                    if ends and place is not None:
                        out.append((*place, None, start, list(held)))
                    place = (session, segment)
                    start = [] if given is None else list(given)
                    held = OrderedDict.fromkeys(start)
                if key is None or not _run_cache((key,), held, cache)[0]:
                    continue
                if not ends:
                    out.append((session, segment, int(seq), None, None))
            yield pd.DataFrame(out, columns=["_session", "_segment", "_seq", "_start", "_end"], dtype=object)
        if ends and place is not None:
            last = [(*place, None, start, list(held))]
            yield pd.DataFrame(last, columns=["_session", "_segment", "_seq", "_start", "_end"], dtype=object)

    return stream.mapInPandas(replay, _PASSED)


def _sent(passed: DataFrame) -> DataFrame:
    return passed.select("_session", "_seq")


def _replay(rows: DataFrame, cache: int, segment: int) -> DataFrame:
    """Exact cache replay of long sessions, cut into segments of `segment` reports."""
    cut, states = _settled(rows, cache, segment)
    return _sent(_pass(cut, cache, states.select("_session", "_segment", "_start")))


def _settled(rows: DataFrame, cache: int, segment: int) -> tuple[DataFrame, DataFrame]:
    """The reports with their segments, and `_session, _segment, _start, _end`: the caches each segment has in truth.

    Every segment first runs from an empty cache, all at once.  Then those whose predecessor ended with
    another cache than they started from run again, until there are none.  Every round settles at
    least one more segment of a session, and since a cache only reflects the last few keys, nearly
    all settle in the second round.  A round stores the segments that ran in it and touches no others:
    the caches of a segment are those of the last round it ran in.
    """
    settings.use_checkpoints(rows.sparkSession)
    placed = ordered.add_position(rows, ["_session"], "_seq", "_position")
    cut = placed.withColumn("_segment", F.expr(f"_position div {int(segment)}")).drop("_position").checkpoint()
    place = ["_session", "_segment"]
    ran = _pass(cut, cache, ends=True).select(*place, "_start", "_end").checkpoint()
    rounds = [ran]
    empty = F.array().cast("array<string>")
    changed = ran.select(*place, "_end", empty.alias("_before"))
    last = ran.groupBy("_session").agg(F.max("_segment").alias("_last"))
    while True:
        following = changed.where(F.col("_end") != F.col("_before")).select(
            "_session", (F.col("_segment") + 1).alias("_segment"), F.col("_end").alias("_start")
        )
        stale = following.join(last, "_session").where(F.col("_segment") <= F.col("_last")).drop("_last").checkpoint()
        if stale.isEmpty():
            return cut, _latest(rounds)
        again = cut.join(stale.select(*place), place, "left_semi")
        ran = _pass(again, cache, stale, ends=True).select(*place, "_start", "_end").checkpoint()
        earlier = _latest([r.join(ran.select(*place), place, "left_semi") for r in rounds])
        changed = ran.select(*place, "_end").join(earlier.select(*place, F.col("_end").alias("_before")), place)
        rounds.append(ran)


def _latest(rounds: list[DataFrame]) -> DataFrame:
    """Of each segment the caches of the last round that it ran in."""
    both = None
    for n, r in enumerate(rounds):
        numbered = r.withColumn("_round", F.lit(n))
        both = numbered if both is None else both.unionByName(numbered)
    state = F.max_by(F.struct("_start", "_end"), "_round").alias("_s")
    return both.groupBy("_session", "_segment").agg(state).select("_session", "_segment", "_s._start", "_s._end")


def breadcrumb_trail(
    df: DataFrame,
    is_error: Column,
    crumb: Column,
    session: str = "session_id",
    order: str = "seq",
    n: int = C.MAX_BREADCRUMBS,
    width: int = ordered.WIDTH,
) -> DataFrame:
    """Errors with `breadcrumbs`, the last `n` other records of their session before them.

    Records are numbered within their session; an error names the numbers of the crumbs it wants
    and meets them in an equality join on (session, number).  No window collects a session and a
    long session's crumbs are spread over all tasks.
    """
    rows = df.withColumns(
        {"_session": F.coalesce(F.col(session).cast("string"), F.lit("")), "_error": is_error}
    )
    numbered = ordered.running_count(
        rows, ["_session"], F.col(order), ~F.col("_error"), ordered.bucket_start(F.col(order), width), "_crumbs"
    )
    errors = rows.where("_error")
    crumbs = numbered.where(~F.col("_error")).select("_session", F.col("_crumbs").alias("_no"), crumb.alias("_crumb"))
    wanted = numbered.where(F.col("_error") & (F.col("_crumbs") > 0) & F.lit(n > 0)).select(
        "_session",
        F.col(order).alias("_at"),
        F.explode(F.sequence(F.greatest(F.col("_crumbs") - n + 1, F.lit(1)), F.col("_crumbs"))).alias("_no"),
    )
    trails = (
        wanted.join(crumbs, ["_session", "_no"])
        .groupBy("_session", "_at")
        .agg(F.array_sort(F.collect_list(F.struct("_no", "_crumb"))).alias("_found"))
        .select("_session", "_at", F.transform("_found", lambda f: f["_crumb"]).alias("_trail"))
    )
    none = F.array().cast(trails.schema["_trail"].dataType)
    named = trails.select(F.col("_session").alias("_of"), "_at", "_trail")
    joined = errors.join(named, (F.col("_session") == F.col("_of")) & (F.col(order) == F.col("_at")), "left")
    return joined.select(*[F.col(c) for c in df.columns], F.coalesce("_trail", none).alias("breadcrumbs"))


def last_crumbs(
    df: DataFrame, is_error: Column, crumb: Column, session: str = "session_id", order: str = "seq", n: int = C.MAX_BREADCRUMBS, width: int = ordered.WIDTH
) -> DataFrame:
    """`session, crumbs`: the last `n` crumbs of each session, the oldest first.

    A stream of later records starts from it (`stateful.breadcrumb_stream`).
    """
    named = F.coalesce(F.col(session).cast("string"), F.lit("")).alias("_session")
    crumbs = df.where(~is_error).select(named, F.col(order).cast("bigint").alias("_at"), crumb.cast("string").alias("_crumb"))
    cut = ordered.cut_off(crumbs, ["_session"], n, "_at", newest=True, width=width)
    newest = crumbs.join(cut, "_session", "left").where(F.col("_cut").isNull() | (F.col("_at") >= F.col("_cut")))
    ring = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_crumb"))), lambda c: c["_crumb"])  # at most `n`
    return newest.groupBy("_session").agg(ring.alias("crumbs")).withColumnRenamed("_session", "session")


def daily_visitor_activity(
    df: DataFrame, day: Column, visitor: str = "session_id_hash", at: str = "timestamp", approximate: bool = False
) -> DataFrame:
    """Activity per day and visitor; or, approximately, visitors per day."""
    if approximate:
        return df.groupBy(day.alias("day")).agg(F.approx_count_distinct(visitor).alias("visitors"))
    return df.groupBy(day.alias("day"), visitor).agg(
        F.count(F.lit(1)).alias("events"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )


def daily_visitor_sketches(df: DataFrame, day: Column, visitor: str = "session_id_hash", precision: int = SKETCH_PRECISION) -> DataFrame:
    """`day, sketch, events`: what a day needs to be counted together with other days, a few kilobytes whatever its size.

    Stored per day, so that a range of days is counted without reading a visit again.  Null visitors are not counted.
    """
    return df.groupBy(day.alias("day")).agg(
        F.hll_sketch_agg(F.col(visitor).cast("string"), precision).alias("sketch"), F.count(F.lit(1)).alias("events")
    )


def visitors_over(sketches: DataFrame, *by: Column) -> DataFrame:
    """Distinct visitors of the days that share `by` (all days without), from their sketches; and their events.

    The error is 1.04 / sqrt(2^precision), 1.6 % at 12 and less than 5 % in nearly all cases.
    """
    union = F.hll_union_agg("sketch", False)
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(union).alias("visitors"), F.sum("events").alias("events"), F.count("day").alias("days"))
