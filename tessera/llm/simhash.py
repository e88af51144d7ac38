"""Near duplicates by SimHash, with tables of distances to reference fingerprints (pivots).

Every distinct fingerprint's Hamming distances to 16 seeded pivots are computed once and stored with it. A pair that
shares a block is discarded if any of its 16 coordinates differs by more than the limit (triangle inequality), and survivors
are verified bit by bit. ``pair_report`` counts the pairs of each step.

Pivots cannot say which pairs to look at: distances to random pivots lie within a few of 32 for almost all fingerprints, so
cells of them hold a large share of all rows (README has the figures). That is left to blocks: of six runs of bits at least
three agree between fingerprints at three or fewer differing bits, so fingerprints with three equal runs are looked at.

Where more than MAX_BUCKET fingerprints share a block, pairs are not listed. Their members meet instead at
fingerprints within one bit of the one and two bits of the other: whatever reaches a point at two bits is linked to
the least that reaches it at one. That is exact too, and linear in the number of fingerprints.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import small_batches, stored
from tessera.llm.components import components

HASH_SEED = 42
SHINGLE = 3
MAX_DISTANCE = 3
MAX_BUCKET = 128
PIVOT_SEED = 20_240_611
N_PIVOTS = 16
RUNS = 6
_PART = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits as a signed long; bit i is set if set in over half the hashes. No words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
    starts = [0, *(e + 1 for e in ends)]
    ends.append(len(line))
    digest = xxhash.xxh64_intdigest
    last = max(len(words) - shingle, 0)
    counts = np.zeros(64, np.int64)
    for at in range(0, last + 1, _PART):
        upto = min(at + _PART, last + 1)
        spans = zip(starts[at:upto], ends[min(at + shingle, len(words)) - 1 :], strict=False)
        hashes = np.fromiter((digest(line[s:e], HASH_SEED) for s, e in spans), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > last + 1, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _runs() -> list[tuple[int, int]]:
    """(shift, width) of the six runs of bits."""
    edges = [round(64 * i / RUNS) for i in range(RUNS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _pivots(n: int = N_PIVOTS) -> list[int]:
    return np.random.default_rng(PIVOT_SEED).integers(-(2**63), 2**63, n, dtype=np.int64).tolist()


def pivot_table(fingerprints: DataFrame) -> DataFrame:
    """Adds pivots: 16 distances, a byte each, in two longs near and far."""

    def packed(some: list[int]):
        total = F.lit(0).cast("long")
        for i, p in enumerate(some):
            total = total.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long"), 8 * i))
        return total

    pivots = _pivots()
    return fingerprints.withColumns({"d0": packed(pivots[:8]), "d1": packed(pivots[8:])})


def _coordinate_gap(limit: int):
    """The pivot test of a candidate pair: no coordinate differs by more than limit."""
    test = F.lit(True)
    for column in ("d0", "d1"):
        for i in range(8):
            left, right = (F.shiftrightunsigned(F.col(f"{side}.{column}"), 8 * i).bitwiseAND(F.lit(255)) for side in "xy")
            test = test & (F.abs(left - right) <= limit)
    return test


def _blocks(fingerprints: DataFrame, limit: int) -> DataFrame:
    """(run, key, fp, d0, d1, n) of every block of more than one fingerprint, n of them, with their pivot distances."""
    if limit > RUNS // 2:
        raise ValueError(f"the runs bring together pairs up to {RUNS // 2} differing bits")
    table = pivot_table(fingerprints)
    keys = []
    for number, chosen in enumerate(combinations(_runs(), RUNS - limit)):
        mask = sum(((1 << width) - 1) << shift for shift, width in chosen)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(number).alias("run"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")))
    placed = table.select("fp", "d0", "d1", F.inline(F.array(*keys)))
    sizes = placed.groupBy("run", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stored(sizes, "pivot-keys")
    return stored(placed.join(sizes, ["run", "key"]), "pivot-places")


def _pairs(cold: DataFrame) -> DataFrame:
    """The pairs within each block, both sides with their pivot distances, as x and y."""
    x, y = cold.alias("x"), cold.alias("y")
    return x.join(y, (F.col("x.run") == F.col("y.run")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")))


def _apart():
    return F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))


def pair_report(fingerprints: DataFrame, limit: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row: pairs looked at (once for each block that they share), those that the pivots discard, those verified, and the
    fingerprints in blocks above max_bucket, which meet without pairs."""
    shared = _blocks(fingerprints, limit)
    near = _coordinate_gap(limit)
    pairs = _pairs(shared.where(F.col("n") <= max_bucket))
    counts = pairs.agg(F.count("*").alias("looked_at"), F.count_if(~near).alias("discarded"), F.count_if(near & (_apart() <= limit)).alias("verified"))
    # Two one-row tables.
    return counts.crossJoin(shared.where(F.col("n") > max_bucket).agg(F.countDistinct("fp").alias("meeting")))


def near_links(fingerprints: DataFrame, limit: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b): links whose components are those of all pairs of distinct fingerprints at most 3 bits apart.

    fingerprints has one distinct long ``fp`` a row. Every listed link holds two fingerprints of one component.
    """
    shared = _blocks(fingerprints, limit)
    cold, hot = shared.where(F.col("n") <= max_bucket), shared.where(F.col("n") > max_bucket)
    links = _pairs(cold).where(_coordinate_gap(limit)).where(_apart() <= limit).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()
    return links.unionByName(_meeting_links(hot.select("fp").distinct(), limit))


def _within(fingerprints: DataFrame, bits: int) -> DataFrame:
    """(fp, point): every point at most ``bits`` bits from each fingerprint, once; 65 for one bit, 2,081 for two."""
    points = fingerprints.select("fp", F.col("fp").alias("point"), F.lit(-1).alias("last"))
    for _ in range(bits):
        # Bits in rising order; 64 stands for none, after which only none follows.
        chosen = points.select("fp", "point", F.explode(F.sequence(F.least(F.col("last") + 1, F.lit(64)), F.lit(64))).alias("last"))
        flip = F.when(F.col("last") < 64, F.expr("shiftleft(1L, last)")).otherwise(F.lit(0).cast("long"))
        points = chosen.select("fp", F.col("point").bitwiseXOR(flip).alias("point"), "last")
    return points.select("fp", "point")


def _meeting_links(fingerprints: DataFrame, limit: int) -> DataFrame:
    hubs = _within(fingerprints, limit // 2).groupBy("point").agg(F.min("fp").alias("hub"))
    spread = _within(fingerprints, limit - limit // 2)
    return spread.join(hubs, "point").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, limit: int = MAX_DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash, root, component_id) of every row: component_id is the least id reachable over linked fingerprints,
    root the least fingerprint, which names the component even where ids repeat or lack; text_hash is xxhash64 of the text.

    Null and empty texts, and texts without words, have fingerprint zero and are linked like any other. Rows with a null
    id are given the component of what they link to, null if nothing with an id. Repeated rows get equal results;
    an empty table gives no rows. Only the two named columns are read.
    """
    small_batches(docs.sparkSession)
    marks = stored(docs.select(F.col(id_col).alias("doc_id"), fingerprint_udf(F.col(text_col)).alias("fp"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")), "fingerprints")
    classes = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(near_links(classes.select("fp"), limit))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marks.join(named, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
