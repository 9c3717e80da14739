"""Order-dependent steps over keys of any size.

A key may hold a third of all rows, so no window here spans a whole key.  Rows are cut into
buckets of their order column; a bucket is summed up by a map-side combined aggregation, a window
over the short bucket table gives each bucket what comes before it, and the row-level window runs
within (key, bucket), which is also how the join has already partitioned the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1 << 20


def bucket_start(order: Column, width: int) -> Column:
    """First value of the bucket; with unique integers a bucket holds at most `width` rows."""
    return order - F.pmod(order, F.lit(width))


def add_position(df: DataFrame, keys, order: str, out: str = "position", width: int = WIDTH) -> DataFrame:
    """Zero-based position of each row within its key, by a unique integer column.

    The keys must not be null.
    """
    keys = list(keys)
    rows = df.withColumn("_bucket", bucket_start(F.col(order), width))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(order)
    return (
        rows.join(offsets, [*keys, "_bucket"])
        .withColumn(out, F.col("_offset") + F.row_number().over(within) - 1)
        .drop("_bucket", "_offset")
    )


def carry_last(
    df: DataFrame,
    keys,
    order: Column,
    value: Column,
    bucket: Column,
    out: str,
) -> DataFrame:
    """The last non-null `value` before each row of its key, in `order`.

    `bucket` must never decrease along `order`.
    """
    keys = list(keys)
    rows = df.withColumns({"_bucket": bucket, "_order": order, "_value": value})
    last_of_bucket = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_order")))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys, "_bucket")
        .agg(last_of_bucket.alias("_last"))
        .select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    )
    within = (
        Window.partitionBy(*keys, "_bucket").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.join(carried, [*keys, "_bucket"])
        .withColumn(out, F.coalesce(F.last("_value", ignorenulls=True).over(within), F.col("_carried")))
        .drop("_bucket", "_order", "_value", "_carried")
    )


def running_count(df: DataFrame, keys, order: Column, flag: Column, bucket: Column, out: str) -> DataFrame:
    """How many rows of the key up to and including this one have `flag` set."""
    keys = list(keys)
    rows = df.withColumns({"_bucket": bucket, "_order": order, "_flag": F.coalesce(flag, F.lit(False)).cast("int")})
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.sum("_flag").alias("_sum"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(offsets, [*keys, "_bucket"])
        .withColumn(out, F.col("_offset") + F.sum("_flag").over(within))
        .drop("_bucket", "_order", "_flag", "_offset")
    )


def add_offset(df: DataFrame, keys, order: str, size: str, out: str = "offset", width: int = WIDTH) -> DataFrame:
    """Sum of `size` over the rows before each one of its key, by a unique integer column."""
    keys = list(keys)
    rows = df.withColumn("_bucket", bucket_start(F.col(order), width))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.sum(size).alias("_sum"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(starts, [*keys, "_bucket"])
        .withColumn(out, F.col("_before") + F.coalesce(F.sum(size).over(within), F.lit(0)))
        .drop("_bucket", "_before")
    )


def cut_off(df: DataFrame, keys, n: int, order: str, newest: bool = False, out: str = "_cut", width: int = WIDTH) -> DataFrame:
    """keys and `out`: where the first `n` rows of each key end, by a unique integer column.

    Keys of `n` rows or fewer have no row.  Only the keys and the order column are read.  Buckets
    are counted, a window over the short bucket table finds the one in which the n-th row lies,
    and only that bucket's numbers (at most `width`) are put in order.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(order).alias("_at"), bucket_start(F.col(order), width).alias("_bucket")).where("_at IS NOT NULL")
    along = F.col("_bucket").desc() if newest else F.col("_bucket").asc()
    w = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    placed = counts.withColumns({"_up_to": F.sum("_rows").over(w), "_all": F.sum("_rows").over(Window.partitionBy(*keys))})
    before = F.col("_up_to") - F.col("_rows")
    reached = placed.where((F.col("_all") > n) & (before < n) & (F.col("_up_to") >= n)).select(*keys, "_bucket", (F.lit(n) - before).alias("_need"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_at").desc() if newest else F.col("_at").asc())
    ranked = rows.join(reached, [*keys, "_bucket"]).withColumn("_rank", F.row_number().over(within))
    return ranked.where(F.col("_rank") == F.col("_need")).select(*keys, F.col("_at").alias(out))
