"""Audits, accounts and verification."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.shared import stored

PREFIX = 3


def accounts(df: DataFrame, reason: str, text_bytes: str, levels: list[str] | None = None) -> DataFrame:
    """(levels, reason, documents, bytes); null reasons are ``kept``."""
    return df.groupBy(*(levels or []), F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("documents"), F.sum(text_bytes).alias("bytes"))


def floor_percentiles(df: DataFrame, group: str, value: str, points: Mapping[str, float]) -> DataFrame:
    """(group, point columns): the sorted values' element number floor(q * n), from 0; the last if q is 1.

    Counts of each different value come first, so the sort is over values, not rows.
    """
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(group).orderBy(value))
    counts = counts.withColumns({"upto": upto, "all": F.sum("n").over(Window.partitionBy(group))})
    at = {k: F.least(F.floor(F.lit(q) * F.col("all")), F.col("all") - 1) for k, q in points.items()}
    return counts.groupBy(group).agg(*[F.min(F.when(F.col("upto") > at[k], F.col(value))).alias(k) for k in points])


def corpus_audit(df: DataFrame, digest: str, ratio: str, flags: Mapping[str, Column]) -> DataFrame:
    """One row: sizes, short and odd-script shares, exact-duplicate shares and flagged shares, rounded to four places."""
    n_bytes = F.octet_length("text").cast("long")
    n, total = F.count("*"), F.sum(n_bytes)
    share = lambda x, of: F.round(x / of, 4)
    first = df.groupBy(digest).agg(F.count("*").alias("n"), F.max(n_bytes).alias("b"))
    copies = first.agg(F.sum(F.col("n") - 1).alias("copies"), F.sum((F.col("n") - 1) * F.col("b")).alias("copy_bytes"))
    aggs = [n.alias("documents"), total.alias("bytes"), F.round(F.avg(F.length("text"))).cast("long").alias("mean_chars"), share(F.count_if(F.length("text") < 500), n).alias("short_rate")]
    aggs += [F.round(F.avg(ratio), 4).alias("script_mean"), share(F.count_if(F.col(ratio) < 0.5), n).alias("script_under_half")]
    for name, test in flags.items():
        aggs += [share(F.count_if(test), n).alias(f"{name}_docs"), share(F.coalesce(F.sum(F.when(test, n_bytes)), F.lit(0)), total).alias(f"{name}_bytes")]
    # Two one-row tables.
    both = df.agg(*aggs).crossJoin(F.broadcast(copies))
    both = both.withColumns({"duplicate_rate": share(F.col("copies"), F.col("documents")), "duplicate_bytes": share(F.col("copy_bytes"), F.col("bytes"))})
    return both.drop("copies", "copy_bytes")


def flat_fingerprint(df: DataFrame, digest: str, groups: list[str], most: int = 100_000) -> DataFrame:
    """(groups, documents, fingerprint): SHA-256 of the sorted digests in one string, for sets of a known size.

    A set of more than ``most`` documents is refused; ``streamed_fingerprint`` and ``tree_fingerprint`` have no bound.
    """
    sized = df.groupBy(*groups).agg(F.count("*").alias("documents"), F.collect_list(digest).alias("_all"))
    checked = F.when(F.col("documents") > most, F.raise_error(F.lit("too many documents for a flat fingerprint"))).otherwise(F.sha2(F.array_join(F.array_sort("_all"), ""), 256))
    return sized.select(*groups, "documents", checked.alias("fingerprint"))


def streamed_fingerprint(df: DataFrame, digest: str, groups: list[str]) -> DataFrame:
    """(groups, documents, fingerprint): as flat_fingerprint, for sets of any size.

    Digests are counted and sorted in ranges; the driver feeds them to a SHA-256 of each group, range after range, so
    neither it nor a task holds more than a range or two.
    """
    lines = df.groupBy(*groups, F.col(digest).alias("_d")).agg(F.count("*").alias("_n")).orderBy(*groups, "_d")
    found = [] if groups else [[(), 0, hashlib.sha256()]]
    for line in lines.toLocalIterator(prefetchPartitions=True):
        *key, one, left = line
        if not found or tuple(key) != found[-1][0]:
            found.append([tuple(key), 0, hashlib.sha256()])
        found[-1][1] += left
        while one is not None and left > 0:
            found[-1][2].update(one.encode() * min(left, 10_000))
            left -= 10_000
    schema = T.StructType([*[df.schema[g] for g in groups], T.StructField("documents", T.LongType()), T.StructField("fingerprint", T.StringType())])
    return df.sparkSession.createDataFrame([(*key, n, sha.hexdigest()) for key, n, sha in found], schema)


def tree_fingerprint(df: DataFrame, digest: str, groups: list[str], prefix: int = PREFIX) -> DataFrame:
    """(groups, documents, fingerprint): digests are hashed by their first hex digits, and these hashes in order.

    Equal digests are counted into their own line first, so copies of one document do not gather.
    """
    lines = df.groupBy(*groups, F.col(digest).alias("_d")).agg(F.count("*").alias("_n"))
    lines = lines.withColumns({"_p": F.substring("_d", 1, prefix), "_line": F.concat_ws(":", "_d", F.col("_n").cast("string"))})
    leaves = lines.groupBy(*groups, "_p").agg(F.sum("_n").alias("_n"), F.sha2(F.array_join(F.array_sort(F.collect_list("_line")), "\n"), 256).alias("_h"))
    tops = leaves.groupBy(*groups).agg(F.sum("_n").alias("documents"), F.array_sort(F.collect_list(F.concat_ws(":", "_p", "_h"))).alias("_all"))
    return tops.select(*groups, "documents", F.sha2(F.array_join("_all", "\n"), 256).alias("fingerprint"))


def reconcile(claimed: DataFrame, observed: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(key, <value>_claimed, <value>_observed, agrees) of every key of either side."""
    a = claimed.select(key, *[F.col(v).alias(f"{v}_claimed") for v in values])
    b = observed.select(key, *[F.col(v).alias(f"{v}_observed") for v in values])
    agrees = None
    for v in values:
        same = F.col(f"{v}_claimed").eqNullSafe(F.col(f"{v}_observed"))
        agrees = same if agrees is None else agrees & same
    return a.join(b, key, "full").withColumn("agrees", agrees)


def verify(df: DataFrame, digest: str, checks: Mapping[str, Column]) -> DataFrame:
    """One row: documents, duplicates (all of them looked at), failures of each check, and PASS if none failed."""
    copies = df.groupBy(digest).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    counts = df.agg(F.count("*").alias("documents"), *[F.count_if(test).alias(name) for name, test in checks.items()])
    bad = sum((F.col(name) for name in checks), F.col("duplicates"))
    return counts.crossJoin(F.broadcast(copies)).withColumn("verdict", F.when(bad == 0, "PASS").otherwise("FAIL"))


def verify_shards(df: DataFrame, shard: list[str], digest: str, checks: Mapping[str, Column], order: str, totals: Mapping[str, Column], claimed: DataFrame) -> DataFrame:
    """A row for each shard of either side: its failures of each check, later copies of rows anywhere, totals that differ, verdict.

    A copy counts in the shard of every row but the first of its digest, by order. claimed has the shard columns and one
    for each total. What is checked of a row is reduced to numbers before the copies are looked for, so no text moves.
    """
    rows = df.select(*shard, order, F.col(digest).alias("_d"), *[test.cast("int").alias(k) for k, test in checks.items()], *[v.alias(k) for k, v in totals.items()])
    rows = stored(rows, "checked-rows")
    first = rows.groupBy("_d").agg(F.min(order).alias("_first"))
    rows = rows.join(first, "_d").withColumn("copies", (F.col(order) > F.col("_first")).cast("int"))
    seen = rows.groupBy(*shard).agg(*[F.sum(k).alias(k) for k in (*checks, "copies", *totals)])
    both = seen.join(claimed.select(*shard, *[F.col(k).alias(f"{k}_claimed") for k in totals]), shard, "full")
    off = sum(((~F.col(k).eqNullSafe(F.col(f"{k}_claimed"))).cast("int") for k in totals), F.lit(0))
    counts = [F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in (*checks, "copies")]
    out = both.select(*shard, *counts, off.cast("long").alias("totals_off"))
    bad = sum((F.col(k) for k in (*checks, "copies", "totals_off")), F.lit(0))
    return out.withColumn("verdict", F.when(bad == 0, "PASS").otherwise("FAIL"))


def recount(sample: DataFrame, group: str, recorded: str, counted: Column) -> DataFrame:
    """(group, sampled, mismatches): recorded token counts of a sample against a fresh count."""
    return sample.groupBy(group).agg(F.count("*").alias("sampled"), F.count_if(~F.col(recorded).eqNullSafe(counted)).alias("mismatches"))
