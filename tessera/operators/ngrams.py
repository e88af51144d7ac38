"""Character n-grams: an index of benchmark texts, and documents that share windows with it.

Windows are compared by a 64-bit polynomial hash over code points, made for a whole text at once in numpy, so a text costs time in
proportion to its length. An index of a checked size travels to the executors as sorted longs; of a larger one a Bloom
filter does, whose size is fixed, and only the windows that pass it are joined with the index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import search_text
from tessera.sources.shared import stored

N = 64
STRIDE = 8
CAP_CHARS = 40_000
MIN_HITS = 2
#: Bytes of an index up to which it is sent to every executor whole, 8 a gram.
SENT_BYTES = 256 << 20
#: Bits of the Bloom filter of a larger one, in 256 slices by a gram's first byte: 256 MB.
BLOOM_BITS = 1 << 31
_SLICES = 256
_U = np.uint64
_BASE = 0x2545F4914F6CDD1D


@lru_cache(maxsize=4)
def _powers(n: int, inverse: bool) -> np.ndarray:
    out = np.ones(n, _U)
    out[1:] = _U(pow(_BASE, -1, 2**64) if inverse else _BASE)
    return np.multiply.accumulate(out)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _gathered(x: np.ndarray) -> np.ndarray:
    """What _spread made x of."""
    x = (x ^ (x >> _U(33))) * _U(pow(0xC4CEB9FE1A85EC53, -1, 2**64))
    x = (x ^ (x >> _U(33))) * _U(pow(0xFF51AFD7ED558CCD, -1, 2**64))
    return x ^ (x >> _U(33))


def point_sums(text: str | None) -> np.ndarray:
    """Sums over a text's code points up to each place, from which the windows of any size follow."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
    size = 1 << max(10, len(points).bit_length())
    sums = np.zeros(len(points) + 1, _U)
    np.cumsum(_spread(points + _U(1)) * _powers(size, False)[: len(points)], out=sums[1:])
    return sums


def _windows(sums: np.ndarray, n: int, stride: int) -> np.ndarray:
    """Of point_sums, the hashes of windows of n code points at multiples of stride before they are spread."""
    points = len(sums) - 1
    if points < n:
        return np.zeros(0, _U)
    at, size = slice(0, points - n + 1, stride), 1 << max(10, points.bit_length())
    return (sums[n:][at] - sums[:-n][at]) * _powers(size, True)[at]


def gram_hashes(text: str | None, n: int = N, stride: int = 1) -> np.ndarray:
    """The hashes of all windows of n code points at multiples of stride; none for a shorter text."""
    return _spread(_windows(point_sums(text), n, stride)).view(np.int64)


def _form(text: str | None, cap: int | None) -> str | None:
    """A raw text's first cap characters (all without a cap) in search form."""
    return search_text(text[:cap] if text and cap else text)


def search_grams(text: str | None, n: int, stride: int, cap: int | None = None) -> np.ndarray:
    """The hashes of a raw text's first cap characters (all without a cap) in search form."""
    return gram_hashes(_form(text, cap), n, stride)


def hashes(text: Column, n: int = N, stride: int = STRIDE, cap: int | None = CAP_CHARS, distinct: bool = False) -> Column:
    """An array column of all windows' hashes of a raw text; each once with ``distinct``."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def made(texts: pd.Series) -> pd.Series:
        found = (search_grams(t, n, stride, cap) for t in texts)
        return pd.Series([np.unique(h) if distinct else h for h in found], dtype=object)

    return made.asNondeterministic()(text)


def gram_index(items: DataFrame, text: Column, name: Column, n: int = N) -> DataFrame:
    """(benchmark, gram): every distinct window of every item, stride 1."""
    rows = items.select(name.alias("benchmark"), hashes(text, n, 1, None, True).alias("grams"))
    return rows.select("benchmark", F.explode("grams").alias("gram")).distinct()


def index_summary(items: DataFrame, text: Column, name: Column, n: int = N) -> DataFrame:
    """(benchmark, items, grams): items with a window at least, and distinct windows; the last row is of all benchmarks."""
    rows = stored(items.select(name.alias("benchmark"), hashes(text, n, 1, None, True).alias("grams")), "item-grams")
    index = rows.select("benchmark", F.explode("grams").alias("gram"))
    counts = rows.groupBy("benchmark").agg(F.sum((F.size("grams") > 0).cast("long")).alias("items"))
    each = index.groupBy("benchmark").agg(F.countDistinct("gram").alias("grams")).join(counts, "benchmark", "right")
    # Two one-row tables.
    every = index.agg(F.countDistinct("gram").alias("grams")).crossJoin(counts.agg(F.coalesce(F.sum("items"), F.lit(0)).alias("items")))
    return each.select("benchmark", "items", F.coalesce("grams", F.lit(0)).alias("grams")).unionByName(every.select(F.lit("all").alias("benchmark"), "items", "grams"))


def _places(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each gram in the slice of its first byte."""
    x, per = grams.view(_U), _U(bits // _SLICES)
    return ((x << _U(8)) >> _U(20)) % per, _spread(x) % per


def bloom(grams: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """A filter of ``bits`` bits over a column gram, made slice by slice on the executors; bits / 8 bytes reach the driver."""
    per = bits // _SLICES

    def slice_(table: pa.Table) -> pa.Table:
        values = table["gram"].to_numpy()
        mask = np.zeros(per, bool)
        for place in _places(values, bits):
            mask[place.astype(np.int64)] = True
        packed = np.packbits(mask, bitorder="little").tobytes()
        return pa.table({"slot": pa.array([int(values.view(_U)[0] >> _U(56))], pa.int32()), "bits": pa.array([packed], pa.binary())})

    slot = F.shiftrightunsigned("gram", 56).cast("int")
    out = np.zeros(bits // 8, np.uint8)
    for row in grams.withColumn("slot", slot).groupBy("slot").applyInArrow(slice_, "slot int, bits binary").toLocalIterator():
        out[row.slot * (per // 8) : (row.slot + 1) * (per // 8)] = np.frombuffer(row.bits, np.uint8)
    return out


def passes(table: np.ndarray, grams: np.ndarray) -> np.ndarray:
    bits = len(table) * 8
    base = (grams.view(_U) >> _U(56)) * _U(bits // _SLICES)
    out = np.ones(len(grams), bool)
    for place in _places(grams, bits):
        at = base + place
        out &= (table[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1
    return out


class SentIndex:
    """Hashes sorted as they are before they are spread, and which of their first bits occur."""

    def __init__(self, grams: np.ndarray) -> None:
        self.grams = np.sort(_gathered(grams.view(_U)))
        self.shift = _U(64 - min(25, max(10, (len(grams) * 16).bit_length())))
        self.firsts = np.zeros(1 << (64 - int(self.shift)), bool)
        self.firsts[(self.grams >> self.shift).view(np.int64)] = True

    def places(self, sums: np.ndarray, n: int, stride: int) -> np.ndarray:
        """Which windows of n code points at multiples of stride are in the index: their numbers, from 0."""
        h = _windows(sums, n, stride)
        likely = np.flatnonzero(self.firsts[(h >> self.shift).view(np.int64)])
        if not len(likely):
            return likely
        h = h[likely]
        return likely[self.grams[np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)] == h]


def sent_index(index: DataFrame, sent_bytes: int = SENT_BYTES) -> Broadcast | None:
    """An index that is sent whole to every executor; None for one above sent_bytes."""
    grams = stored(index.select("gram").distinct(), "grams")
    if grams.count() * 8 > sent_bytes:
        return None
    return index.sparkSession.sparkContext.broadcast(SentIndex(grams.toArrow()["gram"].to_numpy()))


def hit_counter(index: DataFrame, n: int = N, stride: int = STRIDE, sent_bytes: int = SENT_BYTES) -> Callable[[str | None], int] | None:
    """A function that counts the windows of a text in search form in an index that is sent whole; None for an index above sent_bytes."""
    sent = sent_index(index, sent_bytes)
    return None if sent is None else lambda form: len(sent.value.places(point_sums(form), n, stride))


def window_hits(docs: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = N, stride: int = STRIDE, cap: int | None = CAP_CHARS, sent_bytes: int = SENT_BYTES, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """(id, hits): how many windows of each document (occurrences, not different ones) are in the index; 0 included."""
    count = hit_counter(index, n, stride, sent_bytes)
    if count is not None:
        hits = F.pandas_udf(lambda texts: pd.Series([count(_form(t, cap)) for t in texts], dtype="int64"), T.LongType()).asNondeterministic()
        return docs.select(F.col(id_col), hits(text).alias("hits"))
    grams = stored(index.select("gram").distinct(), "grams")
    sent = docs.sparkSession.sparkContext.broadcast(bloom(grams, bloom_bits))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def likely(texts: pd.Series) -> pd.Series:
        found = (search_grams(t, n, stride, cap) for t in texts)
        return pd.Series([h[passes(sent.value, h)] for h in found], dtype=object)

    # Rows are written once: the windows that passed are few, and every row is needed again for its zero.
    rows = stored(docs.select(F.col(id_col).alias("_id"), likely.asNondeterministic()(text).alias("grams")), "likely")
    found = rows.select("_id", F.explode("grams").alias("gram")).groupBy("_id", "gram").agg(F.count("*").alias("times")).join(grams, "gram").groupBy("_id").agg(F.sum("times").alias("hits"))
    return rows.select("_id").join(found, "_id", "left").select(F.col("_id").alias(id_col), F.coalesce("hits", F.lit(0)).alias("hits"))


def attribution(flagged: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = N, stride: int = 1, cap: int | None = CAP_CHARS) -> DataFrame:
    """(id, benchmark, hits) of documents flagged before: the windows of each benchmark that they hold."""
    rows = flagged.select(F.col(id_col), F.explode(hashes(text, n, stride, cap)).alias("gram"))
    counted = rows.groupBy(id_col, "gram").agg(F.count("*").alias("times"))
    return counted.join(index, "gram").groupBy(id_col, "benchmark").agg(F.sum("times").alias("hits"))


def sensitivity(docs: DataFrame, items: DataFrame, id_col: str, text: Column, item_text: Column, sizes=(32, 50, 64), strides=(1, 8), thresholds=(1, 2, 5, 10, 20, 50), cap: int | None = CAP_CHARS) -> DataFrame:
    """(gram, stride, docs, at_least_k...) for each size and stride: how many documents reach each number of hits.

    Each text is put in search form and summed once, while all indexes can be sent; a size's windows are looked up once, at
    the strides' common divisor, for those of a stride are among them.
    """
    grid = [(n, stride) for n in sizes for stride in strides]
    indexes = {n: gram_index(items, item_text, F.lit("all"), n) for n in sizes}
    sent = {n: sent_index(indexes[n], SENT_BYTES // len(sizes)) for n in sizes}
    if None not in sent.values():
        step = gcd(*strides)

        def hits(text: str | None) -> list[int]:
            sums = point_sums(_form(text, cap))
            places = {n: sent[n].value.places(sums, n, step) * step for n in sizes}
            return [np.count_nonzero(places[n] % stride == 0) for n, stride in grid]

        def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([hits(t) for t in texts], dtype=object)

        rows = docs.select(F.pandas_udf(count, T.ArrayType(T.LongType())).asNondeterministic()(text).alias("hits"))
        cells = rows.select(F.posexplode("hits").alias("cell", "hits"))
    else:
        parts = [window_hits(docs, indexes[n], id_col, text, n, stride, cap).select(F.lit(i).alias("cell"), "hits") for i, (n, stride) in enumerate(grid)]
        cells = parts[0]
        for part in parts[1:]:
            cells = cells.unionByName(part)
    sums = cells.groupBy("cell").agg(F.count("*").alias("docs"), *[F.count_if(F.col("hits") >= k).alias(f"at_least_{k}") for k in thresholds])
    named = [F.element_at(F.array(*[F.lit(g[i]) for g in grid]), F.col("cell") + 1).alias(name) for i, name in enumerate(("gram", "stride"))]
    return sums.select(*named, "docs", *[f"at_least_{k}" for k in thresholds])
