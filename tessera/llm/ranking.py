"""Ranks and running sums over whole tables without a window that one task must hold.

Rows fall into buckets by a value that is spread evenly; each bucket's count or sum is prefix-summed over
the small table of buckets, and a window inside a bucket supplies the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a bucket holds on average.
ROWS_PER_BUCKET = 20_000
KEY_BITS = 60


def buckets_for(spark: SparkSession, n_rows: int) -> int:
    """Enough buckets that each holds its share and every partition of an exchange gets some."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // ROWS_PER_BUCKET))


def key_bucket(key: Column, n: int) -> Column:
    """Bucket 0..n-1 of a 60-bit key; grows with the key."""
    return F.floor((F.shiftrightunsigned(key, KEY_BITS - 30) * F.lit(n)) / F.lit(float(1 << 30))).cast("int")


def running(df: DataFrame, bucket: str, order: list[Column], value: Column, out: str, group: str | None = None) -> DataFrame:
    """Adds out: value summed over all rows of the group up to this one, by (bucket, order); out_total: over the group.

    Rows with equal order columns get their sums in any order among themselves. A null value counts as zero.
    """
    keys = [group, bucket] if group else [bucket]
    amount = F.coalesce(value, F.lit(0)).cast("long")
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("_in_bucket"))
    over = Window.partitionBy(group) if group else Window.partitionBy()
    before = over.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_before"),
        F.sum("_in_bucket").over(over).alias(f"{out}_total"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = df.join(offsets, [df[k].eqNullSafe(offsets[f"_o_{k}"]) for k in keys])
    return joined.withColumn(out, F.sum(amount).over(inside) + F.col("_before")).drop("_before", *[f"_o_{k}" for k in keys])
