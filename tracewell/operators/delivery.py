"""What a response means: requeue, drop, pause; and the tables that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.operators import ordered


def endpoints(spark: SparkSession, extra: dict[str, tuple[str, str, str, str]] | None = None) -> DataFrame:
    """The endpoint table; an extra entry replaces one of the same type."""
    rows = [(t, *values) for t, values in {**C.ENDPOINTS, **(extra or {})}.items()]
    return spark.createDataFrame(rows, "type string, path string, wrapper string, feature string, timeout_key string")


def route(batches: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Adds path, wrapper, feature and timeout key.

    Without a table of its own the four known endpoints are constants of the plan, not a join.
    """
    if table is not None:
        return batches.join(table, "type", "left")
    names = ("path", "wrapper", "feature", "timeout_key")
    return batches.withColumns(
        {name: _lookup(F.col("type"), {t: v[i] for t, v in C.ENDPOINTS.items()}) for i, name in enumerate(names)}
    )


def _lookup(key: Column, values: dict, default=None) -> Column:
    chain = None
    for k, v in values.items():
        chain = F.when(key == k, F.lit(v)) if chain is None else chain.when(key == k, F.lit(v))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def retry_after_seconds(header: Column) -> Column:
    """The leading integer of the header; less than one, absent or text means the substitute.

    An integer too long for any pause (over 15 digits) counts as the longest one of 15 digits.
    """
    sign, digits = (F.regexp_extract(header, r"^[ \t\n\r\x0B\f]*([+-]?)0*(\d*)", i) for i in (1, 2))
    seconds = F.when(sign != "-", F.when(F.length(digits) > 15, F.lit(10**15 - 1)).otherwise(digits.try_cast("bigint")))
    return F.when(F.coalesce(seconds, F.lit(0)) < 1, C.RATE_LIMIT_SUBSTITUTE_SECONDS).otherwise(seconds).cast("bigint")


def decide(responses: DataFrame) -> DataFrame:
    """Adds the action for each response: requeue, drop, pause scope and seconds, reason."""
    status = F.coalesce("status", F.lit(0))
    known = list(C.DECISIONS)

    def column(i: int, default) -> Column:
        return _lookup(status, {s: C.DECISIONS[s][i] for s in known}, default)

    seconds = F.when(status == 429, retry_after_seconds(F.col("retry_after"))).otherwise(
        column(3, C.PAUSE_SECONDS).cast("bigint")
    )
    indexes = (
        F.col("unprocessed_indexes") if "unprocessed_indexes" in responses.columns else F.array().cast("array<int>")
    )
    unprocessed = F.coalesce("unprocessed", F.lit(0)) if "unprocessed" in responses.columns else F.lit(0)
    return responses.withColumns(
        {
            "requeue": column(0, True),
            "drop": column(1, False),
            "pause_scope": column(2, "feature"),
            "pause_seconds": seconds,
            "reason": column(4, status.cast("string")),
            "transient": column(5, True),
            "requeue_indexes": F.when((status == 200) & (unprocessed > 0), indexes).otherwise(
                F.array().cast("array<int>")
            ),
        }
    )


def classify_outcomes(responses: DataFrame) -> DataFrame:
    """One row per diagnostic a response gives rise to: severity, text and detail."""
    status = F.coalesce("status", F.lit(0))
    named = [s for s in C.DECISIONS if s != 200]
    severity = _lookup(status, {s: C.DECISIONS[s][6] for s in named}, "error")
    title = _lookup(
        status,
        {**{s: C.DECISIONS[s][7] for s in named}, 500: C.SERVER_ERROR_DIAGNOSTIC},
        C.UNEXPECTED_STATUS_DIAGNOSTIC,
    )
    # Without an answer the transport's own words count.
    said = F.when(status == 0, F.col("error")) if "error" in responses.columns else F.lit(None).cast("string")
    detail = F.when(
        status.isin(*C.FALLBACK_MESSAGES),
        F.coalesce(said, F.nullif(F.col("error_message"), F.lit("")), _lookup(status, C.FALLBACK_MESSAGES)),
    )

    def note(s, t, d) -> Column:
        return F.struct(s.alias("severity"), t.alias("diagnostic"), d.alias("detail"))

    nothing = F.lit(None).cast("string")
    on_success = F.array_compact(
        F.array(
            F.when(F.col("failed") > 0, note(F.lit("warning"), F.lit(C.FAILED_ITEMS_DIAGNOSTIC), nothing)),
            F.when(F.col("unprocessed") > 0, note(F.lit("info"), F.lit(C.UNPROCESSED_ITEMS_DIAGNOSTIC), nothing)),
        )
    )
    notes = F.when(status == 200, on_success).otherwise(F.array(note(severity, title, detail)))
    kept = [c for c in ("type", "batch_no", "status", "at") if c in responses.columns]
    return responses.select(*kept, F.explode(notes).alias("n")).select(*kept, "n.*")


def requeue_unprocessed(decided: DataFrame, batches: DataFrame) -> DataFrame:
    """Items the server names as unprocessed, in its order, duplicates kept.

    Positions outside the batch find no item.  `ordinal` is the place in the server's list.
    """
    named = decided.where(F.size("requeue_indexes") > 0).select(
        "type", "batch_no", F.posexplode("requeue_indexes").alias("ordinal", "_index")
    )
    named = named.withColumn("batch_pos", F.col("_index").cast("bigint")).drop("_index")
    return named.join(batches, ["type", "batch_no", "batch_pos"])


def requeue_batches(decided: DataFrame, batches: DataFrame) -> DataFrame:
    """All items of batches that go back whole; `ordinal` is the item's place in its batch."""
    whole = decided.where("requeue").select("type", "batch_no")
    return batches.join(whole, ["type", "batch_no"], "left_semi").withColumn("ordinal", F.col("batch_pos").cast("int"))


def with_slot(requeued: DataFrame) -> DataFrame:
    """Adds `slot`, which puts a requeued item in order among all requeued ones of its type.

    Batch numbers are about as dense as the items (chunk times items per batch), so a run of 2^20
    of them, 2^40 slots, holds about as many items: `spool.next_spool` numbers by such runs.
    """
    return requeued.withColumn("slot", F.col("batch_no") * F.lit(1 << 20) + F.col("ordinal"))


def pending(items: DataFrame, acknowledged: DataFrame, on: str = "id") -> DataFrame:
    return items.join(acknowledged.select(on), on, "left_anti")


def item_dispositions(decided: DataFrame, batches: DataFrame) -> DataFrame:
    """Adds `disposition` to the items of answered batches: sent, requeued or dropped.

    Items counted as failed are named only by number, so they appear in `delivery_summary`.
    """
    verdict = decided.select("type", "batch_no", "requeue", "drop", "requeue_indexes")
    back = F.col("requeue") | F.array_contains("requeue_indexes", F.col("batch_pos").cast("int"))
    disposition = F.when(F.col("drop"), "dropped").when(back, "requeued").otherwise("sent")
    return (
        batches.join(verdict, ["type", "batch_no"])
        .withColumn("disposition", disposition)
        .drop("requeue", "drop", "requeue_indexes")
    )


def delivery_summary(decided: DataFrame, batch_sizes: DataFrame, totals: bool = False) -> DataFrame:
    """Items per type and disposition, from one row per batch (`items`); optionally with totals."""
    joined = decided.join(batch_sizes.select("type", "batch_no", "items"), ["type", "batch_no"])
    valid = F.filter("requeue_indexes", lambda i: (i >= 0) & (i < F.col("items")))
    requeued = F.when(F.col("requeue"), F.col("items")).otherwise(F.size(F.array_distinct(valid)))
    failed = F.when(F.col("status") == 200, F.coalesce("failed", F.lit(0))).otherwise(0)
    dropped = F.when(F.col("drop"), F.col("items")).otherwise(0)
    counts = joined.select(
        "type",
        F.explode(
            F.array(
                F.struct(F.lit("requeued").alias("disposition"), requeued.cast("bigint").alias("n")),
                F.struct(F.lit("dropped").alias("disposition"), dropped.cast("bigint").alias("n")),
                F.struct(F.lit("failed").alias("disposition"), failed.cast("bigint").alias("n")),
                F.struct(
                    F.lit("sent").alias("disposition"),
                    (F.col("items") - requeued - dropped - failed).cast("bigint").alias("n"),
                ),
            )
        ).alias("d"),
    ).select("type", "d.*")
    grouped = counts.rollup("type", "disposition") if totals else counts.groupBy("type", "disposition")
    return grouped.agg(F.sum("n").alias("items"))


def response_rollup(responses: DataFrame) -> DataFrame:
    """Counters per type, and how many responses break `processed + ignored + failed + unprocessed = received`."""
    names = ("received", "processed", "ignored", "failed", "unprocessed")
    accounted = F.col("processed") + F.col("ignored") + F.col("failed") + F.col("unprocessed")
    return responses.groupBy("type").agg(
        F.count(F.lit(1)).alias("responses"),
        *[F.sum(n).cast("bigint").alias(n) for n in names],
        F.count_if((F.col("status") == 200) & (accounted != F.col("received"))).alias("unbalanced"),
    )


def last_success(responses: DataFrame) -> DataFrame:
    return responses.where(F.col("status") == 200).groupBy("type").agg(F.max("at").alias("last_success_at"))


def pauses_of(decided: DataFrame) -> DataFrame:
    """Pauses that follow from responses: `scope` is `global` or a type."""
    return decided.where(F.col("pause_scope") != "none").select(
        F.when(F.col("pause_scope") == "global", F.lit("global")).otherwise(F.col("type")).alias("scope"),
        F.col("at").alias("started_at"),
        (F.col("at") + F.greatest(F.lit(1), F.col("pause_seconds"))).alias("paused_until"),
        "reason",
    )


def paused_at(runs: DataFrame, pauses: DataFrame, bucket_seconds: int = 3_600) -> DataFrame:
    """Adds to runs (`type, at` and any others) whether they were paused, by what scope and why.

    The newest entry of a scope replaces older ones, even longer ones; an entry without an end
    (`paused_until` null) is a cleared or unreadable one.  A pause is active while `paused_until`
    is later than the run; the global scope outranks the type's own.  Of entries that start in the
    same second the one that ends later counts as newer.

    Only the distinct moments of the runs are looked up, so many runs at one time cost one lookup.
    A run without a type can be paused by the global scope alone; one without a time is not paused.
    """
    no_type = F.lit(None).cast("string")
    no_entry = F.lit(None).cast("struct<paused_until:bigint,reason:string>")
    marks = pauses.select(
        "scope",
        F.col("started_at").alias("at"),
        F.lit(0).alias("kind"),
        F.coalesce("paused_until", F.lit(-1)).alias("tie"),
        F.struct("paused_until", "reason").alias("entry"),
        no_type.alias("type"),
    )
    moments = runs.select("type", "at").distinct()
    asked = moments.select(F.explode(F.array(F.lit("global"), F.col("type"))).alias("scope"), "at", "type").where(
        F.col("scope").isNotNull() & F.col("at").isNotNull()
    ).select(
        "scope", "at", F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("tie"), no_entry.alias("entry"), "type"
    )
    known = ordered.carry_last(
        marks.unionByName(asked),
        ["scope"],
        F.struct("at", "kind", "tie"),
        F.when(F.col("kind") == 0, F.col("entry")),
        ordered.bucket_start(F.col("at"), bucket_seconds),
        "latest",
    ).where("kind = 1")
    active = F.col("latest.paused_until") > F.col("at")
    hit = F.when(active, F.struct(F.col("scope"), F.col("latest.reason").alias("reason")))
    is_global = F.col("scope") == "global"
    found = known.groupBy("type", "at").agg(
        F.max(F.when(is_global, hit)).alias("_global"), F.max(F.when(~is_global, hit)).alias("_own")
    )
    blocking = F.coalesce("_global", "_own")
    looked_up = found.select(F.col("type").alias("_type"), F.col("at").alias("_at"), "_global", "_own")
    same = F.col("type").eqNullSafe(F.col("_type")) & (F.col("at") == F.col("_at"))
    return runs.join(looked_up, same, "left").select(
        *[F.col(c) for c in runs.columns],
        blocking.isNotNull().alias("paused"),
        blocking["scope"].alias("pause_scope"),
        blocking["reason"].alias("reason"),
    )


def blocked_types(run_results: DataFrame, types=C.TYPES) -> DataFrame:
    """Types a run never reaches: those after the first one answered 401, in processing order."""
    rank = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("type"))
    rejected = run_results.where(F.col("status") == 401).groupBy("run_id").agg(F.min(rank).alias("_first"))
    later = F.filter(
        F.transform(F.array(*[F.lit(t) for t in types]), lambda t, i: F.struct(t.alias("type"), (i + 1).alias("rank"))),
        lambda x: x["rank"] > F.col("_first"),
    )
    return rejected.select("run_id", F.explode(later).alias("x")).select("run_id", F.col("x.type").alias("type"))


def rate_flags(
    requests: DataFrame, keys=("key",), at: str = "ts", limit: int = C.REQUESTS_PER_MINUTE, window: str = "1 minute"
) -> DataFrame:
    """Requests per key and minute, flagged where they exceed the limit."""
    return (
        requests.groupBy(F.window(at, window).alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(F.col("_w.start").alias("minute"), *keys, "requests", (F.col("requests") > limit).alias("over_limit"))
    )
