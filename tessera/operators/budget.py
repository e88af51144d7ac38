"""Selection under token budgets, quotas, offsets and packing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.prefix import least_per_key, running_sum


def take_until(df: DataFrame, tokens: str, target: Column, order: list[str], groups: list[str]) -> DataFrame:
    """Whole rows in order until the group's tokens reach its target; the row that crosses it is in. Adds tokens_before."""
    return running_sum(df, tokens, order, "tokens_before", groups).where(F.col("tokens_before") < target)


def round_robin(df: DataFrame, group: str, file: str, order: str, out: str = "turn") -> DataFrame:
    """Adds a row's turn within its (group, file): ordered by (turn, file), rows alternate between a group's files."""
    turns = running_sum(df.withColumn("_one", F.lit(1)), "_one", [order], out, [group, file])
    return turns.drop("_one")


def file_quotas(files: DataFrame, file: str, total: int) -> DataFrame:
    """(file, quota): the total dealt evenly, the remainder to the first files by name."""
    every = Window.partitionBy()
    place = F.row_number().over(every.orderBy(file)) - 1
    n = F.count("*").over(every)
    return files.select(file, (F.floor(F.lit(total) / n) + F.when(place < F.lit(total) % n, 1).otherwise(0)).cast("long").alias("quota"))


def within_quota(df: DataFrame, quotas: DataFrame, file: str, order: str) -> DataFrame:
    """The first rows of each file up to its quota."""
    placed = running_sum(df.withColumn("_one", F.lit(1)), "_one", [order], "_place", [file]).drop("_one")
    return placed.join(quotas, file).where("_place < quota").drop("_place", "quota")


def deficits(have: DataFrame, targets: DataFrame, group: str) -> DataFrame:
    """(group, target, have, deficit, met) of every target."""
    joined = targets.join(have, group, "left").withColumn("have", F.coalesce("have", F.lit(0)))
    return joined.select(group, "target", "have", F.greatest(F.col("target") - F.col("have"), F.lit(0)).alias("deficit"), (F.col("have") >= F.col("target")).alias("met"))


def mixture_targets(ratios: dict[str, float], budget: int) -> dict[str, int]:
    """Tokens for each part; the ratios must sum to one."""
    if abs(sum(ratios.values()) - 1) > 1e-6:
        raise ValueError(f"ratios sum to {sum(ratios.values())}")
    return {k: int(round(budget * v)) for k, v in ratios.items()}


def shares(df: DataFrame, group: str, tokens: str) -> DataFrame:
    """(group, documents, tokens, percent) with the percentage of all tokens, to six places."""
    sums = df.groupBy(group).agg(F.count("*").alias("documents"), F.sum(tokens).alias("tokens"))
    return sums.withColumn("percent", F.round(F.col("tokens") / F.sum("tokens").over(Window.partitionBy()) * 100, 6))


def packed(df: DataFrame, tokens: str, order: list[str], length: int) -> DataFrame:
    """(seq_id, start_in_seq, n, from_token, *columns): each document's part in each full sequence.

    Documents follow each other without padding; the tail that fills no sequence is left out.
    """
    placed = running_sum(df, tokens, order, "_start")
    total = df.agg(F.coalesce(F.sum(tokens), F.lit(0))).first()[0]
    end = F.col("_start") + F.col(tokens)
    first, last = F.floor(F.col("_start") / length), F.floor((end - 1) / length)
    parts = placed.where(F.col(tokens) > 0).withColumn("seq_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("_start"), F.col("seq_id") * length)
    stop = F.least(F.col("_start") + F.col(tokens), (F.col("seq_id") + 1) * length)
    parts = parts.where(F.col("seq_id") < total // length)
    return parts.select("seq_id", (begin - F.col("seq_id") * length).alias("start_in_seq"), (stop - begin).alias("n"), (begin - F.col("_start")).alias("from_token"), *df.columns)


def stratified_order(n: int, anchors: int = 8) -> list[int]:
    """All shard numbers once: first the anchors, at even distances from the first shard to the last (halves round to
    even), then the others from low to high."""
    count = min(n, anchors)
    if count < 2:
        return list(range(n))
    gap = n - 1
    picks = [round(step * gap / (count - 1)) for step in range(count)]
    chosen = set(picks)
    return sorted(chosen, key=picks.index) + [shard for shard in range(n) if shard not in chosen]


def farthest_first(used: list[int], total: int) -> list[int]:
    """The shards not used yet, each the farthest from all before it; of equals the least."""
    gap = [min((abs(i - u) for u in used), default=total) for i in range(total)]
    left, out = set(range(total)) - set(used), []
    while left:
        pick = min(left, key=lambda i: (-gap[i], i)) if used or out else 0
        out.append(pick)
        left.remove(pick)
        gap = [min(g, abs(i - pick)) for i, g in enumerate(gap)]
    return out


def parse_targets(entries: list[str]) -> dict[str, int]:
    """{group: tokens} of entries such as ``math=123``; a malformed, repeated or non-positive one is an error."""
    out: dict[str, int] = {}
    for entry in entries:
        name, mark, value = entry.partition("=")
        if not (name and mark and value.isascii() and value.isdecimal() and int(value) > 0) or name in out:
            raise ValueError(f"not a target: {entry}")
        out[name] = int(value)
    return out


def require_met(df: DataFrame, tokens: str, targets: DataFrame, group: str) -> DataFrame:
    """df, unless a group has fewer tokens than its target: then an error, for candidates that run out may not pass as a pool."""
    short = deficits(df.groupBy(group).agg(F.sum(tokens).alias("have")), targets, group).where(~F.col("met")).orderBy(group).limit(5).collect()
    if short:
        raise ValueError("candidates exhausted: " + ", ".join(f"{r[group]} lacks {r['deficit']}" for r in short))
    return df


def require_count(df: DataFrame, n: int) -> DataFrame:
    """df, unless it has another number of rows than n."""
    found = df.count()
    if found != n:
        raise ValueError(f"{found} rows in place of {n}")
    return df


def shards_until(totals: DataFrame, tokens: str, target: int, order: list[str]) -> DataFrame:
    """Whole shards in order until their tokens reach the target; the one that crosses it is in. A row a shard, so one window."""
    before = F.coalesce(F.sum(tokens).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return totals.withColumn("tokens_before", before).where(F.col("tokens_before") < target)


def scan_cap(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first rows of the whole table in order; adds place, from 0."""
    return running_sum(df.withColumn("_one", F.lit(1)), "_one", order, "place").drop("_one").where(F.col("place") < most)


def in_order(parts: Mapping[str, DataFrame], name: str = "pool") -> DataFrame:
    """The parts in one table, each with its name and its number in ``<name>_ord``: their fixed order survives the union."""
    out = None
    for i, (key, part) in enumerate(parts.items()):
        part = part.withColumns({name: F.lit(key), f"{name}_ord": F.lit(i)})
        out = part if out is None else out.unionByName(part)
    return out


def merged_bottom(state: DataFrame, batch: DataFrame, key: list[str], k: int, order: list[Column]) -> DataFrame:
    """The k first rows of each key of state and batch together: samples of parts merge to the sample of the whole."""
    return least_per_key(state.unionByName(batch), key, k, order)


def spread_sample(items: list[str], n: int) -> list[str]:
    """Up to n items at even steps, the first included."""
    return sorted(items)[:: max(1, len(items) // n)][:n] if n > 0 else []
