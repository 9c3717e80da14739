"""Deletion in stored tables: partitions that go, and partitions that are written anew.

What goes whole (a day of diagnostics, the backlog of a type) is a folder that is removed.  Where part of a partition goes, Spark writes
the rest and puts it in the partition's place when all tasks are done (dynamic partition overwrite), so a job that dies leaves
the table as it was.  Repeating any of this changes nothing more.
"""

from __future__ import annotations

import urllib.parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell import schemas
from tracewell.operators import spool as spools
from tracewell.sources.items import read_spool_table


def partitions(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Folder by value, of a table partitioned by `column` at the top."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return {}
    folders = [s.getPath() for s in system.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith(f"{column}=")]
    return {urllib.parse.unquote(f.getName().partition("=")[2]): f.toString() for f in folders}


def drop_partitions(spark: SparkSession, path: str, column: str, values) -> list[str]:
    """Remove the partitions of these values; gives the values that were there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    found, gone = partitions(spark, path, column), []
    for value in values:
        if value in found:
            folder = hadoop.Path(found[value])
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
            gone.append(value)
    return gone


def discard_stored_backlog(spark: SparkSession, path: str, record_type: str) -> bool:
    """Drop all that waits for a type in a stored spool; whether there was anything.  Unknown types are left alone."""
    return record_type in C.TYPES and bool(drop_partitions(spark, path, "type", [record_type]))


def prune_stored_diagnostics(spark: SparkSession, path: str, today: str, days: int = C.DIAGNOSTICS_DAYS) -> list[str]:
    """Drop the days that are over retention; gives them.  `today` is an ISO date; folders whose name is no date stay."""
    if days < 1:
        return []
    named = spark.createDataFrame([(d,) for d in partitions(spark, path, "day")], "day string")
    old = named.where(F.try_to_date("day", "yyyy-MM-dd") < F.date_sub(F.lit(today).cast("date"), days))
    return sorted(drop_partitions(spark, path, "day", [r.day for r in old.collect()]))


def rewrite_partitions(spark: SparkSession, path: str, kept: DataFrame, touched: list[str], column: str = "type") -> None:
    """Put `kept`, read from the table itself, in the place of the partitions `touched`; those without a row go."""
    rows = kept.where(F.col(column).isin(*touched))
    left = {r[0] for r in rows.select(column).distinct().collect()}  # at most the touched ones
    rows.write.partitionBy(column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    drop_partitions(spark, path, column, [v for v in touched if v not in left])


def discard_where(spark: SparkSession, path: str, gone: Column) -> list[str]:
    """Remove the records of a stored spool for which `gone` is true; gives the types that were touched.

    Types without such a record are not written again.
    """
    table = read_spool_table(spark, path)
    sure = F.coalesce(gone, F.lit(False))
    touched = [r.type for r in table.where(sure & F.col("type").isNotNull()).select("type").distinct().collect()]
    if touched:
        rewrite_partitions(spark, path, table.where(~sure), touched)
    return sorted(touched)


def expire_stored_spool(
    spark: SparkSession, path: str, now: int, at: str = "timestamp", ttl: int = C.SPOOL_TTL_SECONDS, types=C.TYPES
) -> list[str]:
    """Remove from a stored spool what `spool.idle_expiry` calls expired; gives the types that were touched.

    A type whose whole backlog has expired is a folder that goes; one whose earlier lives have is written anew.
    """
    if ttl < 1 or not partitions(spark, path, "type"):
        return []
    judged = spools.idle_expiry(read_spool_table(spark, path), now, at, ttl, types)
    counts = judged.where(F.col("type").isin(*types)).groupBy("type").agg(
        F.count(F.when(F.col("expired"), 1)).alias("gone"), F.count(F.lit(1)).alias("all")
    )
    found = {r["type"]: (r["gone"], r["all"]) for r in counts.collect()}  # one row per known type
    whole = [t for t, (gone, all_) in found.items() if gone == all_]
    partly = [t for t, (gone, all_) in found.items() if 0 < gone < all_]
    drop_partitions(spark, path, "type", whole)
    if partly:
        # A rewritten table is not read through what was judged before the folders went.
        again = spools.idle_expiry(read_spool_table(spark, path), now, at, ttl, types)
        kept = again.where(~F.col("expired")).select(*schemas.SPOOL.names)
        rewrite_partitions(spark, path, kept, partly)
    return sorted(whole + partly)


def discard_lives(spark: SparkSession, path: str, lives: DataFrame, at: str = "timestamp", ttl: int = C.SPOOL_TTL_SECONDS) -> list[str]:
    """Remove from a stored spool the records of lives that a stream has ended (`stateful.expired_lives_stream`)."""
    if not partitions(spark, path, "type"):
        return []
    table = read_spool_table(spark, path)
    gone = spools.expired_records(table, lives, at, ttl)
    touched = [r.type for r in gone.select("type").distinct().collect()]
    if touched:
        rewrite_partitions(spark, path, spools.expired_records(table, lives, at, ttl, others=True), touched)
    return sorted(touched)
