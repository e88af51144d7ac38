"""Quality rules: boosted trees over document statistics, with fixed base rules before them."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import boosting
from tessera.llm.common import WORD, map_slices, seeded_key, stored

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The classifier is fitted on at most so many labelled documents, those of the least seeded keys.
MAX_LABELLED = 20_000
SEED = 41
THRESHOLD = 0.5

#: Each feature and how the score may move as it grows: -1 never up, 0 freely.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "bar_share": -1,
    "bang_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "other_share": 0,
    "same_word_share": -1,
    "distinct_share": 0,
    "line_words": 0,
    "stop_share": 0,
}


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """([n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words], features) of one text; null: an empty one."""
    text = text or ""
    words = text.translate(_TO_SPACE).split(" ") if text else []
    words = [w for w in words if w]
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    dup_lines = len(lines) - len(set(lines))
    repeat = 0
    if n >= 3:
        number: dict[str, int] = {}
        codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        distinct = len(number)
        pairs = codes[:-1] * distinct + codes[1:]
        if distinct > 1:
            pairs = np.unique(pairs, return_inverse=True)[1]
        _, inverse, counts = np.unique(pairs[:-1] * distinct + codes[2:], return_inverse=True, return_counts=True)
        again = counts[inverse] >= 2
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= again
        repeat = int(covered.sum())
        same = int((codes[1:] == codes[:-1]).sum())
    else:
        distinct = len(set(words))
        same = int(n == 2 and distinct == 1)
    lower = text.lower()
    upper = int(np.count_nonzero(_code_points(text) != _code_points(lower))) if len(lower) == len(text) else 0
    per = max(n, 1)
    size = max(chars, 1)
    digits = sum(map(text.count, "0123456789"))
    other = sum(map(text.count, "#*$%&<>=_~^@/\\{}[]"))
    features = [
        math.log1p(n),
        chars / per,
        symbols / size,
        dup_lines / max(len(lines), 1),
        repeat / per,
        text.count("|") / per,
        text.count("!") / per,
        upper / size,
        digits / size,
        other / size,
        same / per,
        distinct / per,
        n / max(len(lines), 1),
        (text.count(".") + text.count(",")) / per,
    ]
    return [n, chars, symbols, dup_lines, repeat], features


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_TO_SPACE = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def _features(texts) -> tuple[np.ndarray, np.ndarray]:
    both = [statistics(t) for t in texts]
    return np.array([b for b, _ in both], dtype=np.int64).reshape(-1, 5), np.array([f for _, f in both], dtype=float).reshape(-1, len(FEATURES))


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        _, x = _features(batch["text"])
        yield pd.DataFrame({"_id": batch["_id"], "y": batch["y"].to_numpy(), "hash": batch["hash"], "x": list(x)})


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> boosting.FlatTrees:
    """Trees fitted to the labelled documents, max_labelled at most (the bound of all that reaches the driver).

    Labels with a null id or a null label are passed over, as are ids without a document. An id with several labels
    counts once for each; of the documents that repeat an id the one of the least text hash counts. No labels, or labels of one class, give a model that answers that class (kept if none).
    """
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("y"))
    chosen = chosen.distinct().orderBy(seeded_key(seed, F.col("_id")), "_id", "y").limit(max_labelled)
    chosen = stored(chosen, "labelled")
    # max_labelled rows of two numbers: their size is bounded.
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    found = map_slices(rows.select("text", "y", "_id", F.xxhash64("text").alias("hash")), _measure, "_id long, y double, hash long, x array<double>")
    # One row a chosen label, combined before the shuffle however many documents repeat its id: max_labelled rows at most.
    frame = stored(found.groupBy("_id", "y").agg(F.min_by("x", "hash").alias("x")), "measured").select("y", "x").toPandas()
    x = np.array(frame["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    y = (frame["y"].to_numpy(dtype=float) > 0.5).astype(float)
    # Rows come in no fixed order; sums are made in a fixed one.
    order = np.lexsort((y, *x.T))
    return boosting.fit(x[order], y[order], list(FEATURES.values()))


def score(docs: DataFrame, model: boosting.FlatTrees, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept) of every row.

    A null text is an empty one and fails the base rules, as does every text of fewer than MIN_WORDS words. Null
    ids and repeated rows are scored like all others. An empty table gives no rows. ``keep`` names columns carried
    along as kept_<name>, ``with_text`` carries the text; all others are not read.
    """

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, x = _features(batch["text"])
            failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
            p = model.probability(x)
            out = pd.DataFrame(base, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
            out = out.assign(base_failed=failed, probability=p, kept=~failed & (p >= threshold))
            yield pd.concat([(batch if with_text else batch.drop(columns="text")).reset_index(drop=True), out], axis=1)

    carried = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c).alias(f"kept_{c}") for c in keep], F.col(text_col).alias("text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields[: None if with_text else -1])
    tail = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"
    return map_slices(carried, judged, f"{head}, {tail}")


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model)


BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def quality_base(spark, sf_dir: str) -> DataFrame:
    """What op10_quality says before its trees: a model without trees keeps all that the base rules keep."""
    every = boosting.fit(np.zeros((0, len(FEATURES))), np.zeros(0), list(FEATURES.values()))
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), every).select(*BASE)


def base_oracle() -> str:
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
threes AS (SELECT doc_id, i, w[i:i + 2] AS three FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM threes QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
repeats AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS k FROM again) GROUP BY doc_id),
counts AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d)
SELECT c.doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * coalesce(n, 0) > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts c LEFT JOIN repeats USING (doc_id)
"""
