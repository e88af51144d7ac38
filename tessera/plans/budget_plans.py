"""Queries of budgets, quotas, mixtures, offsets and packing. A document's tokens are its UTF-8 bytes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import budget
from tessera.operators.prefix import least_per_key
from tessera.sources.tables import table

TARGET = 100_000
GROUP_TARGET = 60_000
QUOTA_TOTAL = 130
SEQ = 8192
RATIOS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
MIX_BUDGET = 600_000
SAMPLE = 25
SEED = 20260821


def _tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.octet_length("text").cast("long").alias("tokens"))


def _shuffled(spark, sf_dir):
    return _tokens(spark, sf_dir).withColumn("key", F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("doc_id").cast("string")), 256))


def token_budget_select(spark, sf_dir):
    return budget.take_until(_tokens(spark, sf_dir), "tokens", F.lit(TARGET), ["doc_id"], ["lang"]).select("lang", "doc_id", "tokens", "tokens_before")


def round_robin_select(spark, sf_dir):
    turns = budget.round_robin(_tokens(spark, sf_dir), "lang", "source", "doc_id")
    return budget.take_until(turns, "tokens", F.lit(GROUP_TARGET), ["turn", "source"], ["lang"]).select("lang", "source", "doc_id", "turn", "tokens_before")


def balanced_quota(spark, sf_dir):
    docs = _tokens(spark, sf_dir)
    quotas = budget.file_quotas(docs.select("source").distinct(), "source", QUOTA_TOTAL)
    return budget.within_quota(docs, quotas, "source", "doc_id").select("source", "doc_id")


def group_token_share(spark, sf_dir):
    return budget.shares(_tokens(spark, sf_dir), "lang", "tokens")


def quota_deficits(spark, sf_dir):
    have = _tokens(spark, sf_dir).groupBy("lang").agg(F.sum("tokens").alias("have"))
    targets = spark.createDataFrame([("de", 400_000), ("en", 10_000_000), ("fr", 1), ("th", 5)], "lang string, target long")
    return budget.deficits(have, targets, "lang")


def mixture_plan(spark, sf_dir):
    """Of each language its target, what whole documents in shuffled order come to, epochs and shortfall, and its share of all."""
    targets = budget.mixture_targets(RATIOS, MIX_BUDGET)
    wanted = spark.createDataFrame(list(targets.items()), "lang string, target long")
    docs = _shuffled(spark, sf_dir).join(F.broadcast(wanted), "lang")
    used = budget.take_until(docs, "tokens", F.col("target"), ["key"], ["lang"]).groupBy("lang").agg(F.count("*").alias("documents"), F.sum("tokens").alias("used"))
    pools = docs.groupBy("lang", "target").agg(F.sum("tokens").alias("pool"))
    plan = pools.join(used, "lang", "left").withColumns({"used": F.coalesce("used", F.lit(0)), "documents": F.coalesce("documents", F.lit(0))})
    share = F.round(F.col("used") / F.sum("used").over(Window.partitionBy()), 6)
    return plan.select("lang", "target", "used", "documents", F.round(F.col("used") / F.col("pool"), 4).alias("epochs"), F.greatest(F.col("target") - F.col("used"), F.lit(0)).alias("shortfall"), share.alias("share"))


def token_offsets(spark, sf_dir):
    from tessera.operators.prefix import running_sum

    return running_sum(_tokens(spark, sf_dir).withColumn("tokens", F.col("tokens") + 1), "tokens", ["doc_id"], "offset", ["lang"]).select("lang", "doc_id", "offset", "tokens")


def sequence_packing(spark, sf_dir):
    parts = budget.packed(_shuffled(spark, sf_dir), "tokens", ["key"], SEQ)
    return parts.select("seq_id", "start_in_seq", "n", "from_token", "doc_id")


def hash_bottom_k(spark, sf_dir):
    """A fixed-size sample of each language that does not depend on how rows arrive."""
    return least_per_key(_shuffled(spark, sf_dir), ["lang"], SAMPLE, [F.col("key")]).select("lang", "doc_id")


def shard_order(spark, sf_dir):
    rows = [("spread", i, s) for i, s in enumerate(budget.stratified_order(14, 5))] + [("farthest", i, s) for i, s in enumerate(budget.farthest_first([0, 9], 10))]
    return spark.createDataFrame(rows, "method string, place int, shard int")


QUERIES = {
    f.__name__: f
    for f in (token_budget_select, round_robin_select, balanced_quota, group_token_share, quota_deficits, mixture_plan, token_offsets, sequence_packing, hash_bottom_k, shard_order)
}

_T = "t AS (SELECT doc_id, lang, source, strlen(text)::BIGINT AS tokens FROM documents)"
_K = f"k AS (SELECT *, sha256('{SEED}:' || doc_id) AS key FROM t)"
_BEFORE = "coalesce(sum(tokens) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT"
ORACLE = {
    "token_budget_select": f"WITH {_T}, r AS (SELECT lang, doc_id, tokens, {_BEFORE.format(w='PARTITION BY lang ORDER BY doc_id')} AS tokens_before FROM t) SELECT * FROM r WHERE tokens_before < {TARGET}",
    "round_robin_select": f"""WITH {_T}, u AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1 AS turn FROM t),
r AS (SELECT lang, source, doc_id, turn, {_BEFORE.format(w='PARTITION BY lang ORDER BY turn, source')} AS tokens_before FROM u) SELECT * FROM r WHERE tokens_before < {GROUP_TARGET}""",
    "balanced_quota": f"""WITH f AS (SELECT source, {QUOTA_TOTAL} // count(*) OVER () + CASE WHEN row_number() OVER (ORDER BY source) <= {QUOTA_TOTAL} % count(*) OVER () THEN 1 ELSE 0 END AS quota FROM (SELECT DISTINCT source FROM documents))
SELECT source, doc_id FROM documents JOIN f USING (source) QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= quota""",
    "group_token_share": f"WITH {_T} SELECT lang, count(*) AS documents, sum(tokens)::BIGINT AS tokens, round(sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM t) * 100, 6) AS percent FROM t GROUP BY lang",
    "quota_deficits": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('de', 400000::BIGINT), ('en', 10000000), ('fr', 1), ('th', 5)) AS v(lang, target))
SELECT lang, target, coalesce(sum(tokens), 0)::BIGINT AS have, greatest(target - coalesce(sum(tokens), 0), 0)::BIGINT AS deficit, coalesce(sum(tokens), 0) >= target AS met FROM v LEFT JOIN t USING (lang) GROUP BY lang, target""",
    "mixture_plan": f"""WITH {_T}, {_K}, v AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {n}::BIGINT)" for k, n in budget.mixture_targets(RATIOS, MIX_BUDGET).items())}) AS v(lang, target)),
r AS (SELECT *, {_BEFORE.format(w='PARTITION BY lang ORDER BY key')} AS before FROM k JOIN v USING (lang)),
u AS (SELECT lang, target, coalesce(sum(tokens) FILTER (before < target), 0) AS used, count(*) FILTER (before < target) AS documents, sum(tokens) AS pool FROM r GROUP BY lang, target)
SELECT lang, target, used::BIGINT AS used, documents, round(used::DOUBLE / pool, 4) AS epochs, greatest(target - used, 0)::BIGINT AS shortfall, round(used::DOUBLE / sum(used) OVER (), 6) AS share FROM u""",
    "token_offsets": f"WITH t AS (SELECT doc_id, lang, strlen(text)::BIGINT + 1 AS tokens FROM documents) SELECT lang, doc_id, {_BEFORE.format(w='PARTITION BY lang ORDER BY doc_id')} AS \"offset\", tokens FROM t",
    "sequence_packing": f"""WITH {_T}, {_K}, p AS (SELECT doc_id, tokens, {_BEFORE.format(w='ORDER BY key')} AS s, (sum(tokens) OVER ())::BIGINT // {SEQ} AS full_seqs FROM k),
e AS (SELECT *, unnest(range(s // {SEQ}, (s + tokens - 1) // {SEQ} + 1)) AS seq_id FROM p WHERE tokens > 0)
SELECT seq_id, greatest(s, seq_id * {SEQ}) - seq_id * {SEQ} AS start_in_seq, least(s + tokens, (seq_id + 1) * {SEQ}) - greatest(s, seq_id * {SEQ}) AS n, greatest(s, seq_id * {SEQ}) - s AS from_token, doc_id FROM e WHERE seq_id < full_seqs""",
    # Worked out by hand: anchors at i * 13 / 4; then the least of the shards farthest from 0 and 9.
    "shard_order": "SELECT method, (place - 1)::INTEGER AS place, shard FROM (SELECT 'spread' AS method, unnest([0, 3, 6, 10, 13, 1, 2, 4, 5, 7, 8, 9, 11, 12]) AS shard, generate_subscripts([0, 3, 6, 10, 13, 1, 2, 4, 5, 7, 8, 9, 11, 12], 1) AS place UNION ALL SELECT 'farthest', unnest([4, 2, 6, 1, 3, 5, 7, 8]), generate_subscripts([4, 2, 6, 1, 3, 5, 7, 8], 1))",
    "hash_bottom_k": f"WITH {_T}, {_K} SELECT lang, doc_id FROM k QUALIFY row_number() OVER (PARTITION BY lang ORDER BY key) <= {SAMPLE}",
}
