"""Running sums over whole tables without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.shared import stored


def running_sum(df: DataFrame, value: str, order: list[str], out: str, groups: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Adds out: value summed over the rows of the group before this one, by the order columns (unique within it).

    Rows are dealt to ranges of the order; a range's total is prefix-summed over the small table of ranges, and a window
    inside each range adds the rest. No range holds more than its share of the rows, however large its group. The dealt rows
    are written once: two evaluations could draw the bounds of the ranges from different samples.
    """
    groups = groups or []
    parts = parts or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(df.repartitionByRange(parts, *groups, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy(*groups, "_range").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*groups, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    # One row a group and range: as many as there are partitions, times the groups that meet in one.
    on = [within[g].eqNullSafe(base[g]) for g in groups] + [within["_range"] == base["_range"]]
    joined = within.join(base, on) if groups else within.join(base, "_range")
    return joined.select(*[within[c] for c in df.columns], (F.col("_within") + F.col("_base")).alias(out))


def least_per_key(df: DataFrame, key: list[str], k: int, order: list[Column]) -> DataFrame:
    """The k first rows of each key; Spark limits each partition before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
