"""Exact and near duplicates, first seen wins."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import search_text
from tessera.operators.ngrams import CAP_CHARS, N
from tessera.sources.shared import stored

#: Of near duplicates; at a larger stride an insertion of another length than its multiples changes every later window.
STRIDE = 1
HASHES = 32
BANDS = 8
PRIME = 2**31 - 1
#: A window's hash is that of its code points as a polynomial in this base modulo PRIME.
BASE = 1_203_946_529
#: a and b of each permutation h -> (a * h + b) mod PRIME.
_RNG = np.random.default_rng(20_260_821)
A = _RNG.integers(1, PRIME, HASHES, dtype=np.int64).tolist()
B = _RNG.integers(0, PRIME, HASHES, dtype=np.int64).tolist()


def exact_survivors(docs: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, in the order of a unique column: one aggregate, which combines before it shuffles."""
    row = F.struct(order, *[c for c in docs.columns if c != order])
    return docs.groupBy(F.col(key).alias("_k")).agg(F.min_by(row, order).alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in docs.columns])


_U = np.uint64
#: How far a permuted hash over PRIME, in double precision, can be off (31 bits before the point leave 22 behind it).
_OFF = 2.0**-20


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    """The first size (a power of two) powers of base modulo PRIME."""
    out = np.ones(1, np.int64)
    while len(out) < size:
        out = np.concatenate([out, out * pow(base, len(out), PRIME) % PRIME])
    return out.astype(_U)


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for unsigned x below PRIME ** 2; x is overwritten."""
    folded = x >> _U(31)
    x &= _U(PRIME)
    x += folded
    np.subtract(x, _U(PRIME), out=folded)  # wraps round where x is below
    return np.minimum(x, folded, out=x)


def window_hashes(text: str, n: int, stride: int) -> np.ndarray:
    """31-bit hashes of all windows of n code points at multiples of stride."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < n:
        return np.zeros(0, np.int64)
    size = 1 << max(10, len(points).bit_length())
    sums = np.zeros(len(points) + 1, _U)
    np.cumsum(_reduced(points * _powers(BASE, size)[: len(points)]), out=sums[1:])
    at = slice(0, len(points) - n + 1, stride)
    out = _reduced(sums[n:][at] - sums[:-n][at])
    out *= _powers(pow(BASE, -1, PRIME), size)[at]
    return _reduced(out).view(np.int64)


def minima(h: np.ndarray) -> np.ndarray:
    """The least (a * h + b) mod PRIME of each permutation over hashes below PRIME, one at least.

    Fractions in double precision, raised so that none falls below 0, tell which hash is least, or which few can be where they
    are too close; those are taken exactly, and all of them where the least fraction is one of nearly 1 that went round.
    """
    values, out = h.astype(np.float64), []
    x, whole = np.empty_like(values), np.empty_like(values)
    for a, b in zip(A, B, strict=True):
        np.multiply(values, a / PRIME, out=x)
        x += b / PRIME + _OFF
        np.floor(x, out=whole)
        x -= whole
        at = int(x.argmin())
        least, x[at] = float(x[at]), 2.0
        best = (a * int(h[at]) + b) % PRIME
        if x[x.argmin()] <= least + 2 * _OFF:
            best = min(best, int(((h[x <= least + 4 * _OFF] * a + b) % PRIME).min(initial=best)))
        if best > (least + 2 * _OFF) * PRIME:
            best = int(((h * a + b) % PRIME).min())
        out.append(best)
    return np.array(out)


def signature_of(form: str, n: int = N, stride: int = STRIDE) -> list[int] | None:
    """signature() of a text that is in search form."""
    return None if len(form) < n else minima(window_hashes(form, n, stride)).tolist()


def signature(text: str | None, n: int = N, stride: int = STRIDE, cap: int | None = CAP_CHARS) -> list[int] | None:
    """32 minima of permuted window hashes of a raw text in search form; null for a text without a window."""
    return signature_of(search_text(text[:cap] if text and cap else text) or "", n, stride)


def signatures(text: Column, n: int = N, stride: int = STRIDE, cap: int | None = CAP_CHARS) -> Column:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([signature(t, n, stride, cap) for t in texts], dtype=object)

    return made.asNondeterministic()(text)


def near_duplicates(docs: DataFrame, order: str, text: Column, n: int = N, stride: int = STRIDE, cap: int | None = CAP_CHARS) -> DataFrame:
    """(order, duplicate_of) of rows that share a band with an earlier row: the first row of the first such band.

    All rows put all their bands down, so the result does not depend on how a scan meets them; a scan that stops at a row's
    first match finds a subset of these.
    """
    # Written once: both sides of the join read it, and each text is hashed once.
    return shared_bands(stored(docs.select(F.col(order), signatures(text, n, stride, cap).alias("signature")), "signatures"), order)


def shared_bands(signed: DataFrame, order: str) -> DataFrame:
    """near_duplicates of rows whose signature is a column already."""
    rows = HASHES // BANDS
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.slice("signature", b * rows + 1, rows).alias("key")) for b in range(BANDS)])
    placed = signed.where("signature is not null").select(F.col(order).alias("_id"), F.inline(bands))
    first = placed.groupBy("band", "key").agg(F.min("_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    hits = placed.join(first, ["band", "key"]).where("_id > first")
    return hits.groupBy("_id").agg(F.min_by("first", "band").alias("duplicate_of")).withColumnRenamed("_id", order)
